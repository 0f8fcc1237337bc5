"""Substring removal by column-wise construction of a collection's BWT.

Every byte covered by a ``WINDOW``-byte string that starts elsewhere too (the
same text included) is removed; strings are judged on the input.

Strings that may repeat are found by their anchors (``anchors.py``).  Segments
whose whole content repeats are settled by counting.  The other contents, cut
out around their anchors, are the documents of collections.  A collection is
built column by column, from the last to the first: each round inserts one
symbol per document in front of its suffix.  Read in the order of the suffixes,
the new symbols are the column's segment of the transform; its stable sort is the
order of the longer suffixes, and the common prefix of two neighbours is one more
than the least between them where their symbols are the same.  Documents are
aligned at their anchors, and equal windows always stand in the same column, so
the suffixes of a column form one sorted segment that need not be merged with
those of other columns.  Columns of symbols go through a sequential file, written
and read one at a time, and repeats are kept as runs, so beside the documents
themselves a task holds a few columns, however many there are.  A window whose
common prefix with a neighbour reaches ``WINDOW`` occurs again.

A null text is empty; texts shorter than a window are kept whole; repeated rows
are copies of each other, so both lose their repeated bytes.  Rows are named by
64 bits of id and text, contents by 128 bits.  No rows give no rows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm import anchors as A
from sessionlens.llm.anchors import merged, runs
from sessionlens.llm.common import empty_if_null, materialise
from sessionlens.llm.hashing import BYTE_VALUE, run_hashes, signed
from sessionlens.operators.joins import join_per_key

WINDOW = 200
GRAM = 40
SPAN = "key long, start long, stop long"


def byte_units(text: str) -> np.ndarray:
    return BYTE_VALUE[np.frombuffer(text.encode("utf-8"), dtype=np.uint8)]


class ColumnFile:
    """Columns of equal height, written and read one after the other."""

    def __init__(self, height: int, dtype: str):
        self.height, self.dtype = height, np.dtype(dtype)
        self.file = tempfile.TemporaryFile()

    def append(self, column: np.ndarray) -> None:
        self.file.write(column.astype(self.dtype).tobytes())

    def rewind(self) -> None:
        self.file.seek(0)

    def next(self) -> np.ndarray:
        return np.frombuffer(self.file.read(self.height * self.dtype.itemsize), dtype=self.dtype)

    def close(self) -> None:
        self.file.close()


def write_columns(documents: list[bytes], anchor_at: np.ndarray) -> tuple[ColumnFile, int, int]:
    """The aligned symbols, last column first (-1: none), the number of columns and the anchors' column."""
    lengths = np.array([len(d) for d in documents])
    left, right = int(anchor_at.max()), int((lengths - anchor_at).max())
    data = np.frombuffer(b"".join(documents), dtype=np.uint8)
    begins = np.cumsum(lengths) - lengths
    out = ColumnFile(len(documents), "int16")
    for column in range(left + right - 1, -1, -1):
        at = column - left + anchor_at
        inside = (at >= 0) & (at < lengths)
        symbols = np.full(len(documents), -1, dtype=np.int16)
        symbols[inside] = data[(begins + at)[inside]]
        out.append(symbols)
    out.rewind()
    return out, left + right, left


def least_between(levels: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least values over low..high inclusive, from minima over runs of 1, 2, 4, ..."""
    power = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(low), dtype=np.uint8)
    for k, level in enumerate(levels):
        at = power == k
        if at.any():
            out[at] = np.minimum(level[low[at]], level[high[at] - (1 << k) + 1])
    return out


def insert_column(order: np.ndarray, common: np.ndarray, symbols: np.ndarray,
                  window: int) -> tuple[np.ndarray, np.ndarray]:
    """One round: documents in the order of their longer suffixes, and each one's common prefix with the one before.

    ``common`` is capped at ``window``; documents whose first symbol comes now stand before the others.
    """
    started = np.zeros(len(symbols), dtype=bool)
    started[order] = True
    new = np.flatnonzero(~started & (symbols >= 0))
    order = np.concatenate([new, order])
    common = np.concatenate([np.zeros(len(new), np.uint8), common])
    if len(new) and len(common) > len(new):
        common[len(new)] = 0
    alive = symbols[order] >= 0      # a document whose first symbol has passed leaves
    if not alive.all():
        kept = np.flatnonzero(alive)
        if len(kept):
            levels = minima(common)
            low = np.concatenate([[0], kept[:-1] + 1])
            common = least_between(levels, low, kept)
        order = order[kept]
        common = common[:len(kept)]
    transform = symbols[order]
    by_symbol = np.argsort(transform, kind="stable")
    new_order = order[by_symbol]
    symbol = transform[by_symbol]
    out = np.zeros(len(new_order), dtype=np.uint8)
    same = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
    if len(same):
        least = least_between(minima(common), by_symbol[same - 1] + 1, by_symbol[same])
        out[same] = np.minimum(least, window - 1) + 1
    return new_order, out


def minima(values: np.ndarray) -> list[np.ndarray]:
    levels, step = [values], 1
    while step * 2 <= len(values):
        levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
        step *= 2
    return levels


def repeated_runs(documents: list[bytes], anchor_at: np.ndarray,
                  window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first window, end) of the runs of window starts that stand in another document of the collection."""
    columns, width, left = write_columns(documents, anchor_at)
    order, common = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint8)
    ends = np.full(len(documents), -1, dtype=np.int64)      # where the open run of a document ends
    found = []
    for column in range(width - 1, -2, -1):
        repeats = np.zeros(len(documents), dtype=bool)
        if column >= 0:
            order, common = insert_column(order, common, columns.next(), window)
            reaches = common >= window
            repeats[order[reaches]] = True
            repeats[order[np.flatnonzero(reaches) - 1]] = True
        closed = np.flatnonzero((ends >= 0) & ~repeats)
        shift = anchor_at[closed] - left
        found.append((closed, column + 1 + shift, ends[closed] + shift))
        ends[closed] = -1
        ends[repeats & (ends < 0)] = column + 1
    columns.close()
    document, first, end = (np.concatenate(part) for part in zip(*found, strict=True))
    return document, first, end


def repeated_windows(documents: list[bytes], anchor_at: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each document, which of its window starts stand in another document of the collection."""
    out = [np.zeros(max(0, len(d) - window + 1), dtype=bool) for d in documents]
    for document, first, end in zip(*repeated_runs(documents, anchor_at, window), strict=True):
        out[document][first:end] = True
    return out


def _cut(text: str, places: list) -> Iterator[tuple]:
    data = text.encode("utf-8")
    grams = None
    for p in places:
        first, number = p["first"], p["number"]
        if grams is None:
            grams = signed(run_hashes(byte_units(text), GRAM))
        at = int(np.flatnonzero(grams[first:first + WINDOW - GRAM + number] == p["anchor"])[0])
        yield p["anchor"], first, at, p["c_count"], data[first:first + number + WINDOW - 1]


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    document, first, end = repeated_runs(list(group["content"]), group["at"].to_numpy("int64"))
    alone = group["c_count"].to_numpy()[document] == 1
    document, first, end = document[alone], first[alone], end[alone]
    begin = group["first"].to_numpy("int64")[document]
    return pd.DataFrame({"key": group["key"].to_numpy("int64")[document], "start": begin + first,
                         "stop": begin + end - 1 + WINDOW})


def _windows_one_by_one(cuttings: DataFrame) -> DataFrame:
    """The same answer for anchors with very many contents: every window is hashed, counted and joined back."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, anchor, first, count, content in zip(batch["key"], batch["anchor"], batch["first"],
                                                          batch["c_count"], batch["content"], strict=True):
                values = BYTE_VALUE[np.frombuffer(content, dtype=np.uint8)]
                hashes = signed(run_hashes(values, WINDOW, seed=2))
                yield pd.DataFrame({"key": key, "anchor": anchor, "at": first + np.arange(len(hashes)),
                                    "n": count, "hash": hashes})

    windows = materialise(cuttings.mapInPandas(rows, "key long, anchor long, at long, n long, hash long"))
    again = windows.groupBy("anchor", "hash").agg(F.sum("n").alias("total")).filter("total > 1").drop("total")
    return (join_per_key(windows.filter("n = 1"), again, ["anchor", "hash"], "inner")
            .select("key", F.col("at").alias("start"), (F.col("at") + WINDOW).alias("stop")))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """key, start, stop: byte spans that repeat (they may overlap); ``texts`` has key, ord, text."""
    found = A.repeated_segments(texts, byte_units, WINDOW, GRAM, ordered=False)
    whole = found.filter("NOT several")
    several = found.filter("several")
    contents = A.contents_of(several, ordered=False)
    contents = materialise(contents.select("anchor", "digest", "c_count", "place.*", F.lit(0).alias("ord")))
    copied = join_per_key(several, contents.filter("c_count > 1").select("anchor", "digest"),
                          ["anchor", "digest"], "inner")
    settled = whole.select("key", "first", "number").unionByName(copied.select("key", "first", "number"))
    spans = settled.select("key", F.col("first").alias("start"), (F.col("first") + F.col("number") + WINDOW - 1).alias("stop"))
    sizes = contents.groupBy("anchor").agg(F.count("*").alias("size")).filter(F.col("size") > A.MOST_CONTENTS)
    cuttings = materialise(A.cut_out(
        texts, contents, _cut, "key long, anchor long, first long, at int, c_count long, content binary"))
    usual = cuttings.join(sizes, "anchor", "left_anti")
    spans = spans.unionByName(A.by_collection(usual, _compare, SPAN))
    return spans.unionByName(_windows_one_by_one(cuttings.join(sizes, "anchor", "left_semi")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes), removed (array of start, stop)."""
    texts = docs.select(A.text_key(id_col, text_col).alias("key"), F.lit(0).cast("long").alias("ord"),
                        F.col(id_col).alias("doc_id"), empty_if_null(text_col).alias("text"))
    spans = A.covered_spans(repeated_spans(texts.select("key", "ord", "text")))
    kind = docs.schema[id_col].dataType
    joined = join_per_key(texts.withColumn("doc_id", F.col("doc_id").cast("string")), spans, "key", "left")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, places in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
                data = text.encode("utf-8")
                gone = merged(places, len(data))
                kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                cut = runs(gone)
                out.append((doc, len(data), int(gone.sum()), len(cut), hashlib.sha256(kept).hexdigest(), kept,
                            [{"start": a, "stop": b} for a, b in cut]))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "removed"])

    return joined.select("doc_id", "text", "spans").mapInPandas(
        rows, "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, "
              "removed array<struct<start:long,stop:long>>").withColumn("doc_id", F.col("doc_id").cast(kind))
