"""Finding where windows of a text occur again, without shuffling every window.

A text is a sequence of units (bytes, or hashes of words).  Every window of
``window`` units is filed under its anchor: of the ``gram``-unit runs in it,
the leftmost one with the smallest hash.  Equal windows have equal anchors at
equal places, so only windows with the same anchor need comparing.
Neighbouring windows mostly share an anchor; a maximal run of them is one
segment, and about one unit in (window - gram) / 2 starts one.

Segments with the same anchor and the same content are counted by an
aggregate.  Texts that repeat without a change thus never meet in one place,
however often they do.  What is left are anchors with several contents; one
copy of each content is cut from its text and given to the operator's own
comparison.  Anchors with more than ``MOST_CONTENTS`` of them go another exact
way: their windows are hashed and grouped one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.common import empty_if_null, materialise
from sessionlens.llm.hashing import U, mix, run_hashes, signed
from sessionlens.operators.joins import join_per_key

#: Contents of one anchor that are compared in one task.
MOST_CONTENTS = 32_768
#: Windows whose anchors are found at once in a long text (positions take 24 bits).
STRETCH = 1 << 20
#: Contents that are compared together; anchors are never divided.
COLLECTION = 8192

Units = Callable[[str], np.ndarray]


def text_key(id_col: str, text_col: str) -> Column:
    """64 bits that name a row by id and text; rows equal in both share all results."""
    return F.xxhash64(F.col(id_col), empty_if_null(text_col))


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    done, out = 1, keys
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    if done < width:
        out = np.minimum(out[:len(keys) - width + 1], out[width - done:])
    return out


def segments(units: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, anchor, content digest, anchor's place in the first window) of each segment."""
    count = len(units) - window + 1
    if count <= 0:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty, empty, empty
    grams, windows = run_hashes(units, gram), run_hashes(units, window, seed=1)
    width = window - gram + 1
    firsts, places = [], []
    for low in range(0, count, STRETCH):
        high = min(count, low + STRETCH)
        part = grams[low:high + width - 1]
        keys = (part >> U(24) << U(24)) | np.arange(len(part), dtype=U)
        place = (_sliding_least(keys, width) & U((1 << 24) - 1)).astype(np.int64) + low
        first = np.flatnonzero(np.diff(place, prepend=-1))
        firsts.append(first + low)
        places.append(place[first])
    first, place = np.concatenate(firsts), np.concatenate(places)
    number = np.diff(first, append=count)
    digest = mix(windows[first] * U(0x9E3779B97F4A7C15) + windows[first + number - 1] * U(3) + number.astype(U))
    return first, number, signed(grams[place]), signed(digest), place - first


def segment_rows(texts: DataFrame, units: Units, window: int, gram: int) -> DataFrame:
    """key, ord, first, number, anchor, digest; ``texts`` has key, ord, text."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [segments(units(t), window, gram) for t in batch["text"]]
            each = np.array([len(f[0]) for f in found], dtype=np.int64)
            if each.sum():
                column = [np.concatenate([f[i] for f in found]) for i in range(4)]
                yield pd.DataFrame({"key": np.repeat(batch["key"].to_numpy("int64"), each),
                                    "ord": np.repeat(batch["ord"].to_numpy("int64"), each),
                                    "first": column[0], "number": column[1].astype("int32"),
                                    "anchor": column[2], "digest": column[3]})

    return texts.mapInPandas(rows, "key long, ord long, first long, number int, anchor long, digest long")


def repeated_segments(texts: DataFrame, units: Units, window: int, gram: int, ordered: bool) -> DataFrame:
    """Segments whose anchor occurs again (``ordered``: with another ord), with the anchor's summary."""
    rows = segment_rows(texts, units, window, gram)
    if not ordered:
        rows = rows.drop("ord")
    summary = [F.count("*").alias("a_count"), (F.min("digest") != F.max("digest")).alias("several")]
    if ordered:
        summary.append(F.min("ord").alias("a_least"))
    anchors = rows.groupBy("anchor").agg(*summary, *([F.max("ord").alias("a_most")] if ordered else []))
    anchors = anchors.filter("a_least < a_most").drop("a_most") if ordered else anchors.filter("a_count > 1")
    return materialise(join_per_key(rows, anchors.drop("a_count"), "anchor", "inner"))


def contents_of(several: DataFrame, ordered: bool) -> DataFrame:
    """One row per anchor and content: how often, the smallest ord, and one place where it stands."""
    place = F.struct(*(["ord"] if ordered else []), "key", "first", "number")
    return several.groupBy("anchor", "digest").agg(F.count("*").alias("c_count"), F.min(place).alias("place"))


def cut_out(texts: DataFrame, contents: DataFrame, cut: Callable[[str, list], Iterator[tuple]],
            schema: str) -> DataFrame:
    """``cut(text, places)`` of every text with contents; a text is read once for all its places."""
    wanted = contents.groupBy("key").agg(F.collect_list(F.struct("first", "number", "anchor", "digest", "c_count",
                                                                 "ord")).alias("places"))
    joined = join_per_key(texts.select("key", "text"), wanted, "key", "inner")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in schema.split(", ")]
        for batch in batches:
            out: list[tuple] = []
            for key, text, places in zip(batch["key"], batch["text"], batch["places"], strict=True):
                out.extend((key, *row) for row in cut(text, places))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    return joined.select("key", "text", "places").mapInPandas(rows, schema)


def by_collection(cuttings: DataFrame, compare: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``compare`` of collections of contents; all contents of an anchor are in one collection."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            # All but the last anchor of the batch are complete.
            last = batch["anchor"].iloc[-1]
            split = int(batch["anchor"].searchsorted(last))
            if held and split == 0 and held[-1]["anchor"].iloc[-1] != last:
                if size >= COLLECTION:
                    yield compare(pd.concat(held, ignore_index=True))
                    held, size = [], 0
            if split:
                held.append(batch.iloc[:split])
                size += split
                if size >= COLLECTION:
                    yield compare(pd.concat(held, ignore_index=True))
                    held, size = [], 0
            held.append(batch.iloc[split:])
            size += len(batch) - split
        if held:
            yield compare(pd.concat(held, ignore_index=True))

    return cuttings.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(rows, schema)


def runs(marked: np.ndarray) -> list[tuple[int, int]]:
    """(first, stop) of the runs of true values."""
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def covered_spans(spans: DataFrame) -> DataFrame:
    """key, spans: the covered (start, stop) of each text, as an array."""
    return spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def merged(spans: np.ndarray | list, length: int) -> np.ndarray:
    """True for every covered unit of a text."""
    change = np.zeros(length + 1, dtype=np.int64)
    for span in spans if spans is not None else []:
        change[span["start"]] += 1
        change[span["stop"]] -= 1
    return np.cumsum(change[:-1]) > 0
