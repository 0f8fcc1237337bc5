"""Substring removal by relative Lempel-Ziv parsing.

Words part at white space.  A word is removed when a window of ``WINDOW``
consecutive words that covers it also starts in a document with a smaller id;
windows are judged on the input.

Reference blocks are the distinct segments of all texts (``anchors.py``), each
labelled with the smallest id of a document that holds it.  They are indexed
by anchor.  A document's segment whose content stands in a smaller document is
one factor, found by counting.  Every other content is factored once against
all reference blocks of its anchor, and its factors hold at every place where
its smallest document has it: from left to right, the longest match of the rest
with a single reference block of a smaller document is the next factor, if it
has ``WINDOW`` words or more; else the next word is a literal.  Such a factor is a
duplicate span.  A window across a factor's end lies in no single factor, so the
windows at every factor boundary are looked up in the index too.  What begins at
a literal has been tried there, so no window is missed.

A match from a window is extended in the index by pairs: a run of at most twice
``WINDOW`` words is the pair of its first and its last window, so the longest match
is the farthest second window that some smaller block has with the first.

A null text has no words; texts shorter than a window are kept whole.  Rows
with the same id never remove each other's words; a null id counts as larger
than any other.  Rows are named by 64 bits of id and text, windows by 128 bits.
No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm import anchors as A
from sessionlens.llm.anchors import merged, runs
from sessionlens.llm.common import empty_if_null, materialise
from sessionlens.llm.hashing import run_hashes, signed, word_hashes, word_spans
from sessionlens.operators.joins import join_per_key

WINDOW = 50
GRAM = 16
SPAN = "anchor long, digest long, start long, stop long"
#: The rank of a row without an id.
LAST = (1 << 63) - 1


def word_units(text: str) -> np.ndarray:
    data = text.encode("utf-8")
    return word_hashes(data, *word_spans(data))


def _cut(text: str, places: list) -> Iterator[tuple]:
    windows = signed(run_hashes(word_units(text), WINDOW, seed=2))
    for p in places:
        yield p["anchor"], p["digest"], p["ord"], windows[p["first"]:p["first"] + p["number"]]


class ReferenceIndex:
    """Reference blocks of many anchors, given as runs of windows: which smaller document holds what."""

    def __init__(self, anchors: np.ndarray, windows: list[np.ndarray], documents: np.ndarray):
        sizes = np.array([len(w) for w in windows])
        self.ends = np.cumsum(sizes)
        block = np.repeat(np.arange(len(windows)), sizes)
        self.left = self.ends[block] - np.arange(len(block)) - 1     # windows after this one in its block
        self.document = documents[block]
        flat, anchor = np.concatenate(windows).astype("int64"), anchors[block]
        order = np.lexsort((flat, anchor))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(anchor[order]) != 0) | (np.diff(flat[order]) != 0)
        self.name = np.empty(len(order), dtype="int64")              # equal windows of one anchor
        self.name[order] = np.cumsum(new) - 1
        self.least = self._least(self.name, np.arange(len(order)))
        self.held = self.least < self.document

    def _least(self, names: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each name the smallest document among the places ``at`` that have it."""
        _, names = np.unique(names, return_inverse=True)
        least = np.full(names.max(initial=-1) + 1, np.iinfo("int64").max)
        np.minimum.at(least, names, self.document[at])
        return least[names]

    def longest_matches(self) -> tuple[np.ndarray, np.ndarray]:
        """From every window: how many windows the longest match with one smaller block has (0: none), and
        the smallest document with such a match."""
        length, reference = self.held.astype("int64"), np.where(self.held, self.least, -1)
        asked, step = np.flatnonzero(self.held), 1
        names = int(self.name.max(initial=0)) + 1
        while True:
            asked = asked[self.left[asked] >= step]
            if not len(asked):
                return length, reference
            wanted = np.zeros(names, dtype=bool)
            wanted[self.name[asked]] = True
            at = np.flatnonzero(wanted[self.name] & (self.left >= step))
            found = np.empty(len(self.name), dtype="int64")
            found[at] = self._least(self.name[at] * names + self.name[at + step], at)
            asked = asked[found[asked] < self.document[asked]]
            length[asked], reference[asked] = step + 1, found[asked]
            step += 1


def factors(length: np.ndarray, reference: np.ndarray, least: np.ndarray) -> list[tuple[int, int, int]]:
    """Greedy factors of one block (first word, end, document), and the boundary windows that hold, as
    spans of their own.

    ``length`` is the longest match from each window, in windows, ``reference`` the smallest document that has
    it, ``least`` the smallest that has the window.
    """
    out, at = [], 0
    starts = np.flatnonzero(length)
    while True:
        k = np.searchsorted(starts, at)
        if k == len(starts):
            return out
        at = int(starts[k])
        stop = at + int(length[at]) - 1 + WINDOW
        out.append((at, stop, int(reference[at])))
        # windows that begin in the factor's last words and end behind it
        for a in starts[np.searchsorted(starts, at + int(length[at])):np.searchsorted(starts, stop)]:
            out.append((int(a), int(a) + WINDOW, int(least[a])))
        at = stop


def _parse(group: pd.DataFrame) -> pd.DataFrame:
    """Every block of the group against all others: the group's index, then each block's factors."""
    index = ReferenceIndex(group["anchor"].to_numpy("int64"), list(group["windows"]), group["ord"].to_numpy("int64"))
    length, reference = index.longest_matches()
    out = [(anchor, digest, a, b) for anchor, digest, s, e in
           zip(group["anchor"], group["digest"], [0, *index.ends[:-1]], index.ends, strict=True)
           for a, b, _ in factors(length[s:e], reference[s:e], index.least[s:e])]
    return pd.DataFrame(out, columns=["anchor", "digest", "start", "stop"]).astype("int64")


def _windows_one_by_one(cuttings: DataFrame) -> DataFrame:
    """The same answer for anchors with very many contents, by a grouped minimum over single windows."""
    windows = cuttings.select("anchor", "digest", "ord", F.posexplode("windows").alias("at", "window"))
    least = windows.groupBy("anchor", "window").agg(F.min("ord").alias("least"))
    held = join_per_key(windows, least, ["anchor", "window"], "inner").filter("least < ord")
    return held.select("anchor", "digest", F.col("at").cast("long").alias("start"),
                       (F.col("at") + WINDOW).cast("long").alias("stop"))


def held_spans(texts: DataFrame) -> DataFrame:
    """key, start, stop: word spans that a smaller document holds (they may overlap)."""
    found = A.repeated_segments(texts, word_units, WINDOW, GRAM, ordered=True)
    whole = found.filter("NOT several AND a_least < ord")
    several = found.filter("several")
    contents = A.contents_of(several, ordered=True)
    contents = materialise(contents.select("anchor", "digest", "c_count", "place.*"))
    sizes = contents.groupBy("anchor").agg(F.count("*").alias("size")).filter(F.col("size") > A.MOST_CONTENTS)
    cuttings = materialise(A.cut_out(texts, contents, _cut,
                                     "key long, anchor long, digest long, ord long, windows array<long>"))
    parsed = A.by_collection(cuttings.join(sizes, "anchor", "left_anti"), _parse, SPAN).unionByName(
        _windows_one_by_one(cuttings.join(sizes, "anchor", "left_semi")))
    # A set, as rows equal in id and text are cut out once each; a segment has few windows.
    parsed = parsed.groupBy("anchor", "digest").agg(F.collect_set(F.struct("start", "stop")).alias("parts"))
    least = join_per_key(contents.select("anchor", "digest", F.col("ord").alias("least")), parsed, ["anchor", "digest"])
    # Every place of a content: whole where a smaller document has it, else the factors found in the content.
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("end").alias("stop")))
    end = (F.col("number") + WINDOW - 1).cast("long")
    places = join_per_key(several.select("key", "ord", "first", "number", "anchor", "digest"), least,
                          ["anchor", "digest"], "inner").withColumn("end", end)
    places = places.select("key", "first", F.explode(F.when(F.col("least") < F.col("ord"), everything)
                                                     .otherwise(F.col("parts"))).alias("part"))
    return whole.select("key", F.col("first").alias("start"), (F.col("first") + end).alias("stop")).unionByName(
        places.select("key", (F.col("first") + F.col("part.start")).alias("start"),
                      (F.col("first") + F.col("part.stop")).alias("stop")))


def remove_held_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (words joined by one space), removed (array of start, stop)."""
    texts = docs.select(A.text_key(id_col, text_col).alias("key"),
                        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("ord"),
                        F.col(id_col).alias("doc_id"), empty_if_null(text_col).alias("text"))
    spans = A.covered_spans(held_spans(texts.select("key", "ord", "text")))
    kind = docs.schema[id_col].dataType
    joined = join_per_key(texts.withColumn("doc_id", F.col("doc_id").cast("string")), spans, "key", "left")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, places in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
                words = text.encode("utf-8").split()
                gone = merged(places, len(words))
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                out.append((doc, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8"),
                            [{"start": a, "stop": b} for a, b in runs(gone)]))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "removed"])

    return joined.select("doc_id", "text", "spans").mapInPandas(
        rows, "doc_id string, n_words long, n_removed long, kept_sha256 string, kept string, "
              "removed array<struct<start:long,stop:long>>").withColumn("doc_id", F.col("doc_id").cast(kind))
