"""Alignment of two tokenizers over the same texts.

Side A is a byte-level BPE (a ``tokenizers`` JSON file), side B a BPE with
byte fallback (a ``sentencepiece`` model).  Both read a text with a space in
front.  Per batch, every token has a document and a byte range; ``merge_asof``,
keyed by document, finds for the start of each A token the B token that covers
it, and the other way round.  The union of both directions is every pair of
overlapping tokens; offsets at which both sides end cut the tokens into groups,
and the pairs that end together are the links.

How often a pair of ids is linked over the corpus is summed per task and then
over the tasks.  Ids of linked tokens are byte suffixes of one another, so the
two vocabularies bound the table of pairs (``suffix_pairs``), however large the
corpus; only that table goes through the driver and to every task.

A text that is null or empty, or whose tokens on either side do not give back
its bytes, has no tokens: zeros and an empty string.  Every row of the input
gives one row, repeated rows and rows without an id as well.  A very long text
is encoded in stretches, cut before a single space between two other
characters, where no token of either side can reach across; columns other than
the id and the text are not read.  Empty tables give empty tables.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.common import materialise

#: Characters of a text that are encoded at once, at least, where the text can be cut.
STRETCH = 1 << 20
#: Characters of a batch that are aligned at once; a longer text is aligned by itself.
TOGETHER = 1 << 20
CUT = re.compile(r"(?<=\S) (?=\S)")
SEPARATORS = np.frombuffer(b",|;", dtype="u1")


def byte_level_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 is itself,
    the others are numbered from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteLevelSide:
    """Ids and bytes of a byte-level BPE."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["id"] for t in spec["added_tokens"] if t["special"]}
        alphabet = byte_level_alphabet()
        self.tokens = {i: bytes(alphabet[c] for c in entry) for entry, i in spec["model"]["vocab"].items()
                       if i not in special}
        ranks = {token: i for i, token in self.tokens.items()}
        merged = [ranks[b"".join(bytes(alphabet[c] for c in part) for part in (m if isinstance(m, list) else m.split(" ")))]
                  for m in spec["model"]["merges"]]
        if not {bytes([b]) for b in range(256)} <= ranks.keys():
            raise ValueError(f"{path}: every byte must have an entry, so that the tokens give back any text")
        pre = spec["pre_tokenizer"]
        if merged != sorted(merged) or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
            raise ValueError(f"{path}: merges must be in the order of their ids, after a plain byte-level split")
        self._encoder = tiktoken.Encoding("side-a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encoder.encode_ordinary(t) for t in texts]


class PieceSide:
    """Ids and bytes of a sentencepiece BPE with byte fallback, which puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self._encoder = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = {}
        for i in range(self._encoder.get_piece_size()):
            piece = self._encoder.id_to_piece(i)
            if self._encoder.is_byte(i):
                self.tokens[i] = bytes([int(piece[3:5], 16)])
            elif not (self._encoder.is_control(i) or self._encoder.is_unknown(i)):
                self.tokens[i] = piece.replace("▁", " ").encode("utf-8")
                if b" " in self.tokens[i].lstrip(b" "):
                    raise ValueError(f"{path}: the piece {piece!r} has a space inside")
        if self._encoder.encode("a", out_type=str)[0][0] != "▁":
            raise ValueError(f"{path}: no space is put before the text")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """``texts`` begin with the space that the model adds."""
        return self._encoder.encode([t[1:] for t in texts], num_threads=1)


@cache
def sides(path_a: str, path_b: str) -> tuple[ByteLevelSide, PieceSide]:
    return ByteLevelSide(path_a), PieceSide(path_b)


@cache
def suffix_pairs(path_a: str, path_b: str) -> np.ndarray:
    """Every (a, b) of which one's bytes end with the other's, as sorted a << 32 | b: all that can be linked."""
    a, b = (side.tokens for side in sides(path_a, path_b))
    found = set()
    for shorts, longs, pair in ((b, a, lambda i, j: i << 32 | j), (a, b, lambda i, j: j << 32 | i)):
        by_bytes: dict[bytes, list[int]] = {}
        for i, token in shorts.items():
            by_bytes.setdefault(token, []).append(i)
        for i, token in longs.items():
            for k in range(len(token)):
                found.update(pair(i, j) for j in by_bytes.get(token[k:], ()))
    return np.array(sorted(found), dtype="i8")


def stretches(text: str) -> list[str]:
    """The text in pieces of ``STRETCH`` characters or more, each beginning with a space."""
    out, at = [], 0
    while len(text) - at > STRETCH:
        cut = CUT.search(text, at + STRETCH)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    return [*out, text[at:]]


def encode_all(side, texts: list[str]) -> list[list[int]]:
    if all(len(t) <= STRETCH for t in texts):
        return side.encode(texts)
    parts = [stretches(t) for t in texts]
    ids = iter(side.encode([p for own in parts for p in own]))
    return [[i for _ in own for i in next(ids)] for own in parts]


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (in a, in b) of every two tokens of one document that share a byte.

    ``a`` and ``b`` have doc and start, sorted by start, and each side covers its documents without a gap.
    The token of the other side that begins last, but not after a start, covers it.
    """
    in_b = pd.merge_asof(a, b.assign(row=np.arange(len(b))), on="start", by="doc")["row"].to_numpy("i8")
    in_a = pd.merge_asof(b, a.assign(row=np.arange(len(a))), on="start", by="doc")["row"].to_numpy("i8")
    later = np.flatnonzero(a["start"].to_numpy()[in_a] < b["start"].to_numpy())     # equal starts are found already
    return np.concatenate([np.arange(len(a)), in_a[later]]), np.concatenate([in_b, later])


@dataclass
class Side:
    """One side of a batch: per token its id, document, first byte and the byte after its last."""
    ids: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


def lay_out(ids: list[list[int]], lengths: np.ndarray) -> Side:
    flat = np.fromiter(chain.from_iterable(ids), dtype="i8", count=sum(map(len, ids)))
    size = lengths[flat]
    end = np.cumsum(size)
    return Side(flat, np.repeat(np.arange(len(ids)), [len(x) for x in ids]), end - size, end)


def decimal_table(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0..count-1, left-aligned, with room for one character more; and how many there are."""
    width = len(str(count))
    digits = np.char.ljust(np.arange(count).astype(f"S{width}"), width + 1, b"0")
    return digits.view("u1").reshape(count, width + 1).copy(), np.char.str_len(np.arange(count).astype(f"S{width}"))


def group_texts(a: Side, b: Side, group_a: np.ndarray, group_b: np.ndarray, docs: int,
                tables: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """Per document its groups as ``a1,a2|b1;a3|b2,b3``."""
    groups = int(group_a[-1]) + 1 if len(group_a) else 0
    many_a, many_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    place_a = np.arange(len(group_a)) + (np.cumsum(many_b) - many_b)[group_a]
    place_b = np.arange(len(group_b)) + np.cumsum(many_a)[group_b]
    last_a = np.append(group_a[1:] != group_a[:-1], True)[:len(group_a)]
    last_b = np.append(group_b[1:] != group_b[:-1], True)[:len(group_b)]
    n = len(group_a) + len(group_b)
    ids, mark, ending = np.empty(n, "i8"), np.empty(n, "u1"), np.zeros(n, bool)
    ids[place_a], ids[place_b] = a.ids, b.ids
    mark[place_a] = SEPARATORS[np.where(last_a, 1, 0)]
    mark[place_b] = SEPARATORS[np.where(last_b, 2, 0)]
    ending[place_b] = np.append(b.doc[1:] != b.doc[:-1], True)[:len(b.doc)]
    digits, count = tables
    out, length = digits[ids], count[ids]
    out[np.arange(n), length] = mark
    length = length + ~ending
    text = out[np.arange(out.shape[1]) < length[:, None]].tobytes()
    doc = np.empty(n, "i8")
    doc[place_a], doc[place_b] = a.doc, b.doc
    size = np.bincount(doc, weights=length, minlength=docs).astype("i8")
    ends = np.cumsum(size)
    return [text[s:e] for s, e in zip(ends - size, ends, strict=True)]


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = sides(path_a, path_b)
        self.pairs = suffix_pairs(path_a, path_b)
        bytes_a, self.bytes_b = ([s.tokens.get(i, b"") for i in range(max(s.tokens) + 1)] for s in (self.a, self.b))
        self.length_a, self.length_b = (np.array([len(t) for t in own], dtype="i8") for own in (bytes_a, self.bytes_b))
        self.digits = decimal_table(max(len(self.length_a), len(self.length_b)))

    def _tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none of either where side B does not give back the bytes (side A always does)."""
        spaced = [" " + t for t in texts]
        ids_a, ids_b = encode_all(self.a, spaced), encode_all(self.b, spaced)
        for k, text in enumerate(spaced):
            if b"".join(map(self.bytes_b.__getitem__, ids_b[k])) != text.encode("utf-8"):
                ids_a[k], ids_b[k] = [], []
        return ids_a, ids_b

    def align(self, texts: list[str]) -> pd.DataFrame:
        """Per text the number of tokens, groups and links, the groups as text, and each link's pair number."""
        ids_a, ids_b = self._tokens(texts)
        a, b = lay_out(ids_a, self.length_a), lay_out(ids_b, self.length_b)
        row_a, row_b = overlaps(pd.DataFrame({"doc": a.doc, "start": a.start}),
                                pd.DataFrame({"doc": b.doc, "start": b.start}))
        together = a.end[row_a] == b.end[row_b]
        row_a, row_b = row_a[together], row_b[together]
        order = np.lexsort((row_b, row_a))
        row_a, row_b = row_a[order], row_b[order]
        cuts = a.end[row_a]
        cuts = cuts[np.append(True, cuts[1:] != cuts[:-1])[:len(cuts)]]
        groups = group_texts(a, b, np.searchsorted(cuts, a.start, side="right"),
                             np.searchsorted(cuts, b.start, side="right"), len(texts), self.digits)
        links = np.searchsorted(self.pairs, a.ids[row_a] << 32 | b.ids[row_b]).astype("i4")
        n_links = np.bincount(a.doc[row_a], minlength=len(texts))
        at = np.cumsum(n_links)
        cut_doc = a.doc[np.searchsorted(a.end, cuts)] if len(cuts) else np.empty(0, "i8")
        return pd.DataFrame({
            "n_a": [len(x) for x in ids_a], "n_b": [len(x) for x in ids_b],
            "n_groups": np.bincount(cut_doc, minlength=len(texts)), "n_links": n_links,
            "groups": groups, "links": [links[s:e].tobytes() for s, e in zip(at - n_links, at, strict=True)]})


def in_runs(sizes: list[int]) -> Iterator[slice]:
    """Consecutive texts of at most ``TOGETHER`` characters, or one longer text."""
    start, total = 0, 0
    for k, size in enumerate(sizes):
        if k > start and total + size > TOGETHER:
            yield slice(start, k)
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          keep_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links (a 32-bit number in ``suffix_pairs`` per
    link), and with ``keep_groups`` the groups themselves."""

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            for run in in_runs([len(t) for t in texts]):
                own = [k for k in range(run.start, run.stop) if texts[k]]
                out = pd.DataFrame({"doc_id": batch["doc_id"].iloc[run].to_numpy()})
                found = aligner.align([texts[k] for k in own])
                found.index = np.array(own, dtype="i8") - run.start
                out = out.join(found)
                for name in ("n_a", "n_b", "n_groups", "n_links"):
                    out[name] = out[name].fillna(0).astype("i8")
                lists = {name: [x if isinstance(x, bytes) else b"" for x in out[name]] for name in ("groups", "links")}
                out["links"] = lists["links"]
                out["groups_sha256"] = [hashlib.sha256(x).hexdigest() if x else "" for x in lists["groups"]]
                out["groups"] = [x.decode("ascii") for x in lists["groups"]] if keep_groups else ""
                yield out[columns]

    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string",
             "links": "binary"} | ({"groups": "string"} if keep_groups else {})
    columns = ["doc_id", *kinds]
    schema = ", ".join([f"doc_id {read.schema['doc_id'].dataType.simpleString()}",
                        *(f"{name} {kind}" for name, kind in kinds.items())])
    return read.mapInPandas(aligned, schema)


def pair_counts(aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """How many links hold each pair of ids: pair (its number), a_id, b_id, n_links."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(suffix_pairs(path_a, path_b)), dtype="i8")
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch["links"]), dtype="i4"), minlength=len(total))
        seen = np.flatnonzero(total)
        pair = suffix_pairs(path_a, path_b)[seen]
        yield pd.DataFrame({"pair": seen, "a_id": pair >> 32, "b_id": pair & 0xFFFFFFFF, "n_links": total[seen]})

    return (aligned.select("links").mapInPandas(counted, "pair long, a_id long, b_id long, n_links long")
            .groupBy("pair", "a_id", "b_id").agg(F.sum("n_links").alias("n_links")))


def scored(aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``aligned`` with n_best and count_sum.  It is read twice and must be materialised."""
    counts = pair_counts(aligned, path_a, path_b).toPandas()     # bounded by suffix_pairs
    count, best = np.zeros(len(suffix_pairs(path_a, path_b)), "i8"), np.zeros(len(suffix_pairs(path_a, path_b)), bool)
    count[counts["pair"]] = counts["n_links"]
    best[counts["pair"]] = counts["n_links"] == counts.groupby("b_id")["n_links"].transform("max")
    shared = aligned.sparkSession.sparkContext.broadcast((count, best))

    def looked_up(links: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of, top = shared.value
        for batch in links:
            pairs = np.frombuffer(b"".join(batch), dtype="i4")
            ends = np.cumsum([len(x) // 4 for x in batch], dtype="i8")
            sums = [np.append(0, np.cumsum(x[pairs], dtype="i8")) for x in (top, of)]
            starts = np.append(0, ends[:-1])[:len(ends)]
            yield pd.DataFrame({"n_best": sums[0][ends] - sums[0][starts], "count_sum": sums[1][ends] - sums[1][starts]})

    both: Column = F.pandas_udf(looked_up, "n_best long, count_sum long")(F.col("links"))
    return (aligned.withColumn("_both", both).withColumns({"n_best": F.col("_both.n_best"),
                                                           "count_sum": F.col("_both.count_sum")}).drop("_both"))


def alignment_report(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per row of ``docs``."""
    out = scored(materialise(align(docs, path_a, path_b, id_col, text_col)), path_a, path_b)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
