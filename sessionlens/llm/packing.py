"""Best-fit packing by large-item matching.

Texts become token ids plus a closing id 0; only those longer than a sequence
are cut, into pieces of ``CAPACITY`` tokens.  Two pieces above one third of the
capacity fill most of a sequence and three never fit, so:

1. the large pieces (longer than a third), longest first, are each matched with
   the longest unmatched large piece that still fits beside them, two to a
   sequence at most;
2. the small pieces, longest first, go where they leave the least gap, and open
   a new sequence where none has room.

Only lengths matter to that plan, and a length is one of ``CAPACITY`` values:
the plan is made from the histogram of lengths (its size does not grow with the
corpus) and says "pieces number a..b of length n go to sequences c.., at this
offset".  Spark tokenizes, counts, numbers the pieces of each length and looks
each piece up in the plan.  Numbers come from (task, length) counts, so no
length, however frequent, meets in one task.

A null text counts as empty; an empty text is the single id 0.  Rows with the
same id are packed each.  No rows give no rows.
"""

from __future__ import annotations

import gc
import re
import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.common import materialise, narrow_files

CAPACITY = 2048
#: Distinct words (and runs) whose ids a Python worker remembers; then it starts afresh.
REMEMBERED = 700_000
#: Characters of text that are parted into words at once.
STRETCH = 2_000_000
#: Runs that are encoded as one text.
TOGETHER = 256
#: Words that neither normalisation nor other letters and digits concern.
SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: The tokenizer's pattern on such words in lower case, and its vocabulary's mark of a run's last token (fixed values).
RUNS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
RUN_END = "</w>"
#: Longer runs without white space are not remembered.
LONG_WORD = 64
CLOSING = np.zeros(1, dtype="<u4")


class WordTokens:
    """Token ids of texts.  The tokenizer treats white space as a border that no token
    spans, so a text's ids are those of its words, and repeated words are encoded once.

    Words of ASCII signs and composed Latin letters are parted further, as the tokenizer
    parts them, into runs of letters, single digits and runs of other signs; new runs are
    encoded many at a time and told apart by the vocabulary's mark for a run's last token.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(RUN_END)]] = True

    def learn(self, words: list[bytes]) -> None:
        parted, whole = {}, []
        for word in words:
            text = word.decode("utf-8")
            if SIMPLE.fullmatch(text) and b"<|" not in word:
                parted[word] = RUNS.findall(text.lower())
            else:
                whole.append(word)
        new = list({run for parts in parted.values() for run in parts if run not in self.runs})
        if len(self.runs) + len(new) > REMEMBERED:
            self.runs.clear()
            new = list({run for parts in parted.values() for run in parts})
        groups = [new[at:at + TOGETHER] for at in range(0, len(new), TOGETHER)]
        found = self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
        for group, encoded in zip(groups, found, strict=True):
            ids = np.array(encoded.ids, dtype="<u4")
            data, ends = ids.tobytes(), ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
            for run, start, end in zip(group, [0, *ends[:-1]], ends, strict=True):
                self.runs[run] = data[start:end]
        runs = self.runs
        for word, parts in parted.items():
            self.known[word] = runs[parts[0]] if len(parts) == 1 else b"".join([runs[p] for p in parts])
        for run in new:
            if len(run) > LONG_WORD:
                del runs[run]
        found = self.tokenizer.encode_batch([w.decode("utf-8") for w in whole], add_special_tokens=False)
        for word, encoded in zip(whole, found, strict=True):
            self.known[word] = np.array(encoded.ids, dtype="<u4").tobytes()

    def stream(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and size < STRETCH:
                size += len(texts[stop])
                stop += 1
            yield from self.batch(texts[at:stop])
            at = stop

    def batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text; the words that are new to all of them are learned together."""
        parted = [text.encode("utf-8").split() for text in texts]
        seen = set().union(*parted)
        new = seen.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = seen
        if new:
            gc.disable()  # its many small objects hold no cycles
            try:
                self.learn(list(new))
            finally:
                gc.enable()
        ids_of = self.known.__getitem__
        for words in parted:
            yield np.frombuffer(b"".join(map(ids_of, words)), dtype="<u4")
        for word in new:
            if len(word) > LONG_WORD:
                del self.known[word]


def worker_tokens(path: str) -> WordTokens:
    """The words that this Python worker remembers, kept from task to task."""
    kept = sys.modules.setdefault("_sessionlens_word_tokens", SimpleNamespace(by_path={})).by_path
    if path not in kept:
        kept[path] = WordTokens(path)
    return kept[path]


def pieces_of(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
              capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, task, nth (number among the task's pieces of that length)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = worker_tokens(tokenizer_path)
        seen = np.zeros(capacity + 1, dtype="int64")
        task = TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for doc, found in zip(batch["id"], tokens.stream(list(batch["text"])), strict=True):
                ids = np.concatenate([found, CLOSING])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    rows.append((doc, piece, start, len(part), zlib.crc32(part.tobytes()), task, seen[len(part)]))
                    seen[len(part)] += 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])
            yield out.astype({"doc_id": batch["id"].dtype} if len(out) else {})

    kind = docs.schema[id_col].dataType.simpleString()
    # Ids travel as text where pandas has no integer with nulls.
    rows = docs.select(F.col(id_col).cast("string").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = rows.mapInPandas(cut, "doc_id string, piece int, start long, length long, ids_crc32 long, "
                                  "task int, nth long")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


@dataclass
class Placement:
    """Pieces number ``first``.. of ``length``: ``each`` to a sequence from ``sequence`` on, at ``offset``."""
    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


class Gaps:
    """Ranges of sequences by what room they have left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[int] = []
        self.ranges: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, start: int, count: int) -> None:
        if count and room:
            if room not in self.ranges:
                insort(self.rooms, room)
                self.ranges[room] = []
            self.ranges[room].append((start, count))

    def tightest(self, length: int) -> int | None:
        at = bisect_left(self.rooms, length)
        return self.rooms[at] if at < len(self.rooms) else None

    def take(self, room: int) -> tuple[int, int]:
        found = self.ranges[room].pop()
        if not self.ranges[room]:
            del self.ranges[room]
            self.rooms.remove(room)
        return found


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Placement]:
    """Where the pieces of each length go; its work is bounded by the number of lengths, not of pieces."""
    left = {n: c for n, c in histogram.items() if c}
    used = dict.fromkeys(left, 0)
    plan: list[Placement] = []
    gaps = Gaps(capacity)
    sequences = 0

    def place(length: int, count: int, sequence: int, each: int, offset: int) -> None:
        plan.append(Placement(length, used[length], count, sequence, each, offset))
        used[length] += count
        left[length] -= count

    large = sorted(n for n in left if n * 3 > capacity)
    while large:
        a = large[-1]
        b_at = bisect_left(large, capacity - a + 1) - 1
        if b_at >= 0 and large[b_at] == a and left[a] == 1:  # its own only one
            b_at -= 1
        b = large[b_at] if b_at >= 0 else None
        pairs = 0 if b is None else left[a] // 2 if a == b else min(left[a], left[b])
        if b is not None and pairs:
            place(a, pairs, sequences, 1, 0)
            place(b, pairs, sequences, 1, a)
            gaps.add(capacity - a - b, sequences, pairs)
            sequences += pairs
        else:  # nothing large fits beside it
            count = left[a]
            place(a, count, sequences, 1, 0)
            gaps.add(capacity - a, sequences, count)
            sequences += count
        large = [n for n in large if left[n]]
    for n in sorted((n for n in left if n * 3 <= capacity), reverse=True):
        while left[n]:
            room = gaps.tightest(n)
            if room is None:
                each = capacity // n
                count = -(-left[n] // each)
                gaps.add(capacity, sequences, count)
                sequences += count
                continue
            start, count = gaps.take(room)
            each = room // n
            whole = min(count, left[n] // each)
            if whole:
                place(n, whole * each, start, each, capacity - room)
                gaps.add(room - each * n, start, whole)
            rest = min(each, left[n]) if whole < count else 0
            if rest:
                place(n, rest, start + whole, rest, capacity - room)
                gaps.add(room - rest * n, start + whole, 1)
            gaps.add(room, start + whole + (rest > 0), count - whole - (rest > 0))
    return plan


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    pieces = materialise(pieces_of(docs, tokenizer_path, id_col, text_col, capacity))
    by_task = pieces.groupBy(F.col("task").alias("t_"), F.col("length").alias("l_")).agg(F.count("*").alias("n"))
    histogram = {r["l_"]: r["n"] for r in by_task.groupBy("l_").agg(F.sum("n").alias("n")).collect()}
    plan = sorted(plan_packing(histogram, capacity), key=lambda p: (p.length, p.first))
    table = np.array([[p.length, p.first, p.sequence, p.each, p.offset] for p in plan] or [[0] * 5], dtype="int64")
    starts = table[:, 0] << 48 | table[:, 1]

    earlier = Window.partitionBy("l_").orderBy("t_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("t_", "l_", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = (pieces.join(offsets, (F.col("task") == F.col("t_")) & (F.col("length") == F.col("l_")))
                .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("nth")))

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, nth: pd.Series) -> pd.DataFrame:
        length, nth = length.to_numpy("int64"), nth.to_numpy("int64")
        row = table[np.searchsorted(starts, length << 48 | nth, side="right") - 1]
        inside = nth - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 2] + inside // row[:, 3],
                             "offset": row[:, 4] + inside % row[:, 3] * length})

    files = narrow_files(docs.sparkSession, sum(histogram.values()))
    return (numbered.coalesce(files).withColumn("place", look_up("length", "nth"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset"))
