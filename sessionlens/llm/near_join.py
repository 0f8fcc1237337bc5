"""N-gram Jaccard join: MinHash LSH forest with exact verification.

Texts are sets of five-word shingles (words part at white space); two texts
are linked when their sets' Jaccard similarity is ``THRESHOLD`` or more.

1. Texts with equal sets form one class, counted by a partial aggregate; from
   here on a class is one row, however many copies it has.
2. Each class has ``TREES`` signatures of ``DEPTH`` MinHash values: its paths
   in a forest of sorted prefix tries.  Classes that share the shortest prefix that
   is ever matched (``matched_depth``: a pair at the threshold meets below such a node
   of some trie with probability ``RECALL``) meet in one group per trie node,
   as signatures of one byte per value, without their texts.
3. In a group the paths are sorted and the matched prefix is shortened from
   ``DEPTH`` values on, value by value.  At each length, classes that agree on it
   and are not yet connected are compared by their whole signatures; from a
   share of ``PLAUSIBLE`` equal values on they are connected.  A pair at the
   threshold falls below with probability 1e-6; a pair at 0.5 gets above with 1e-4,
   so texts that merely share a passage are not chained.  Large nodes are dealt
   into blocks, each pair of blocks a group of its own.
4. The texts of each connected component are compared exactly, all with all.
   Components of more than ``BLOCK`` classes are dealt into blocks; each pair of blocks
   is a group of its own.  A group returns one count per text and a spanning
   forest of its links, never the pairs.
5. The links' connected components are the groups of near copies.

A text of one to four words is one shingle.  A text without words (empty,
null) is linked to nothing.  Repeated rows are copies.  Shingles are compared
by 64-bit hashes, classes by 128 bits.  No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.common import empty_if_null, files_for, free_name, materialise
from sessionlens.llm.components import connected_components
from sessionlens.llm.hashing import U, mix, shingles, signed
from sessionlens.operators.joins import join_per_key, row_hash

WORDS = 5
THRESHOLD = 0.8
TREES = 20
DEPTH = 8
#: Probability that a pair at the threshold is found.
RECALL = 0.9995
#: Share of equal values in two signatures from which their texts may be linked.
PLAUSIBLE = 0.65
#: Classes that are compared in one group at most (twice as many for two blocks).
BLOCK = 256
#: Signatures that are compared in one group at most (twice as many for two blocks).
NODE_BLOCK = 2048

_rng = np.random.default_rng(97)
MULTIPLY = _rng.integers(0, 1 << 63, TREES * DEPTH, dtype=U) * U(2) + U(1)
ADD = _rng.integers(0, 1 << 63, TREES * DEPTH, dtype=U)


def matched_depth(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The longest prefix that finds a pair at the threshold with the target recall."""
    depth = DEPTH
    while depth > 1 and 1 - (1 - threshold ** depth) ** TREES < recall:
        depth -= 1
    return depth


def record(id_col: str, text_col: str) -> Column:
    """16 bytes that name a row by its id and text."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"),
                                  F.md5(empty_if_null(text_col)))))


def signature(values: np.ndarray) -> np.ndarray:
    best = np.full(TREES * DEPTH, np.iinfo(U).max, dtype=U)
    for at in range(0, len(values), 2048):
        part = values[at:at + 2048, None] * MULTIPLY + ADD
        np.minimum(best, part.min(axis=0), out=best)
    return best.reshape(TREES, DEPTH)


def forest_paths(signs: np.ndarray, depth: int) -> np.ndarray:
    """One hash per tree of the path's first ``depth`` values."""
    paths = signs[:, :depth]
    out = np.zeros(TREES, dtype=U)
    for d in range(depth):
        out = out * U(0x9E3779B97F4A7C15) + (paths[:, d] >> U(17))
    return signed(out)


def short_signature(signs: np.ndarray) -> bytes:
    """One byte per value, tree by tree."""
    return (mix(signs) & U(255)).astype("u1").tobytes()


def _signed_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    depth = matched_depth()
    for batch in batches:
        rows = []
        for doc, rec, text in zip(batch["doc_id"], batch["rec"], batch["text"], strict=True):
            values = shingles(text.encode("utf-8"), WORDS)
            if not len(values):
                rows.append((doc, rec, None, 0, None, None))
                continue
            signs = signature(values)
            rows.append((doc, rec, hashlib.blake2b(values.tobytes(), digest_size=16).digest(), len(values),
                         forest_paths(signs, depth), short_signature(signs)))
        yield pd.DataFrame(rows, columns=["doc_id", "rec", "node", "n_shingles", "paths", "sign"])


def connected_in_node(signs: np.ndarray, tree: int, shortest: int) -> np.ndarray:
    """For the classes below one trie node (rows of ``signs``) the number of their cluster's first row.

    The matched prefix is shortened from ``DEPTH`` to ``shortest`` values; at each length, classes that agree on
    it, not on more, are compared unless they are connected already.
    """
    paths = signs[:, tree * DEPTH:(tree + 1) * DEPTH]
    order = np.lexsort(paths.T[::-1])
    signs, paths = signs[order], paths[order]
    label = np.arange(len(signs))
    least = PLAUSIBLE * signs.shape[1]
    for depth in range(DEPTH, shortest - 1, -1):
        # the node itself is one run, whatever its bytes
        cut = (paths[1:, :depth] != paths[:-1, :depth]).any(axis=1) if depth > shortest else np.zeros(len(paths) - 1, bool)
        starts = np.flatnonzero(np.append(True, cut))
        for s, e in zip(starts, [*starts[1:], len(paths)], strict=True):
            for k in range(s, e):
                if (label[s:e] == label[s]).all():
                    break
                rest = np.flatnonzero(label[k + 1:e] != label[k]) + k + 1
                if depth < DEPTH:
                    rest = rest[(paths[rest, :depth + 1] != paths[k, :depth + 1]).any(axis=1)]
                near = rest[(signs[rest] == signs[k]).sum(axis=1) >= least]
                if len(near):
                    joined = np.unique(np.append(label[near], label[k]))
                    label[np.isin(label, joined)] = joined[0]
    out = np.empty(len(label), dtype="int64")
    out[order] = order[label]
    return out


def _plausible(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (a, b) that connect what may be linked below each trie node; rows come sorted by node."""
    shortest = matched_depth()
    names = ["tree", "path", "i", "j"]

    def links(held: pd.DataFrame) -> pd.DataFrame:
        keys = held[names].to_numpy()
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        ends = np.append(starts[1:], len(held))
        signs = np.frombuffer(b"".join(held["sign"]), dtype="u1").reshape(len(held), -1)
        first = np.repeat(starts, ends - starts)
        # most nodes hold a pair, or copies that are all like the first
        near = (signs == signs[first]).sum(axis=1) >= PLAUSIBLE * signs.shape[1]
        to = np.where(near, first, -1)
        for s, e in zip(starts, ends, strict=True):
            if e - s > 2 and not near[s:e].all():
                to[s:e] = connected_in_node(signs[s:e], int(keys[s, 0]), shortest) + s
        tied = np.flatnonzero((to >= 0) & (to != np.arange(len(held))))
        node = held["node"].to_numpy()
        return pd.DataFrame({"a": node[tied], "b": node[to[tied]]})

    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(held):
            continue
        open_ = (held[names] == held[names].iloc[-1]).all(axis=1).to_numpy()
        if not open_.all():
            yield links(held[~open_])
            held = held[open_].reset_index(drop=True)
    if held is not None and len(held):
        yield links(held)


def _similar(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    lengths = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), lengths)
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[at] > 1
    owner, at = owner[shared], at[shared]
    names, at = np.unique(at, return_inverse=True)
    common = np.zeros((n, n), dtype="f4")
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    width = 4096
    for low in range(0, len(names), width):
        a, b = np.searchsorted(at, [low, low + width])
        part = np.zeros((n, min(width, len(names) - low)), dtype="f4")
        part[owner[a:b], at[a:b] - low] = 1
        common += part @ part.T
    return common


def _compare(nodes: list[bytes], blocks: np.ndarray, weights: np.ndarray, texts: list[str]) -> pd.DataFrame:
    """Linked rows of each node, and the smallest node that it reaches, within one group."""
    sets = [shingles(t.encode("utf-8"), WORDS) for t in texts]
    sizes = np.array([len(s) for s in sets], dtype="f8")
    common = _similar(sets).astype("f8")
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= THRESHOLD * union - 1e-9
    np.fill_diagonal(linked, False)
    if len(set(blocks.tolist())) > 1:  # pairs within a block are compared in that block's own group
        linked &= blocks[:, None] != blocks[None, :]
    counts = linked @ weights
    order = sorted(range(len(nodes)), key=lambda i: nodes[i])
    rank = np.empty(len(nodes), dtype=int)
    rank[order] = np.arange(len(nodes))
    label = rank.copy()
    while True:
        reach = np.where(linked, label[None, :], len(nodes)).min(axis=1)
        new = np.minimum(label, reach)
        if (new == label).all():
            break
        label = new
    return pd.DataFrame({"node": nodes, "linked": counts.astype("int64"), "least": [nodes[order[i]] for i in label]})


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by group; a group may span batches."""
    held: list[pd.DataFrame] = []
    key = None

    def done() -> pd.DataFrame:
        group = pd.concat(held, ignore_index=True).drop_duplicates("node")
        return _compare(list(group["node"]), group["own"].to_numpy(), group["n_docs"].to_numpy("f8"),
                        list(group["text"]))

    for batch in batches:
        out = []
        keys = list(zip(batch["component"], batch["i"], batch["j"], strict=True))
        at = 0
        while at < len(keys):
            stop = at
            while stop < len(keys) and keys[stop] == keys[at]:
                stop += 1
            if key is not None and key != keys[at]:
                out.append(done())
                held = []
            key = keys[at]
            held.append(batch.iloc[at:stop])
            at = stop
        if out:
            yield pd.concat(out, ignore_index=True)
    if held:
        yield done()


def may_be_linked(classes: DataFrame) -> DataFrame:
    """Links (a, b) that connect all classes (node, paths, sign) whose signatures are alike below a trie node."""
    paths = classes.select("node", F.posexplode("paths").alias("tree", "path"))
    nodes = paths.groupBy("tree", "path").agg(F.count("*").alias("n")).filter("n > 1")
    met = join_per_key(paths, nodes, ["tree", "path"], "inner")
    blocks = F.ceil(F.col("n") / NODE_BLOCK).cast("int")
    dealt = (met.join(classes.select("node", "sign"), "node").withColumn("blocks", blocks)
             .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("tree", "path", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "node", "sign"))
    grouped = dealt.repartition("tree", "path", "i", "j").sortWithinPartitions("tree", "path", "i", "j", "node")
    return grouped.mapInPandas(_plausible, "a binary, b binary")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                files: int | None = None) -> DataFrame:
    """doc_id, class_id, n_links, n_shingles, rec, class_rec: one row per document.

    ``class_id`` is the smallest id among the documents that links connect
    (its own for a document without links), ``n_links`` the number of other
    documents whose similarity is ``THRESHOLD`` or more.  ``files``: those that ``docs`` fills, if known.
    """
    files = files or files_for(docs.select(text_col))
    named = docs.select(F.col(id_col).alias("doc_id"), record(id_col, text_col).alias("rec"),
                        empty_if_null(text_col).alias("text"))
    kind = docs.schema[id_col].dataType
    marked = materialise(named.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        _signed_rows, "doc_id string, rec binary, node binary, n_shingles long, paths array<long>, sign binary")
        .withColumn("doc_id", F.col("doc_id").cast(kind)))
    rows = marked.drop("paths", "sign")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("id"),
                           F.col("rec").alias("rec"))).alias("first")
    classes = materialise(rows.filter("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("n_docs"), first), files)
    signed_classes = materialise(marked.filter("node IS NOT NULL").groupBy("node")
                                 .agg(F.first("paths").alias("paths"), F.first("sign").alias("sign")), files)
    candidates = connected_components(may_be_linked(signed_classes), files)
    sizes = candidates.groupBy("component").agg(F.count("*").alias("size"))
    placed = join_per_key(candidates, sizes, "component", "inner")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (placed.withColumn("blocks", blocks)
             .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .join(classes.select("node", "n_docs", F.col("first.rec").alias("rec")), "node"))
    # rows equal in id and text give their text once
    again = rows.groupBy("rec").agg(F.count("*").alias("n")).filter("n > 1").select("rec")
    own_texts = named.select("rec", "text")
    once = own_texts.join(again, "rec", "left_anti").unionByName(
        own_texts.join(again, "rec", "left_semi").groupBy("rec").agg(F.first("text").alias("text")))
    texts = (once.join(dealt, "rec")
             .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "own", "node", "n_docs", "text"))
    grouped = texts.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    verified = materialise(grouped.mapInPandas(_verified, "node binary, linked long, least binary"))
    links = verified.groupBy("node").agg(F.sum("linked").alias("linked"))
    final = connected_components(verified.select(F.col("node").alias("a"), F.col("least").alias("b")), files)
    known = (classes.join(links, "node", "left").join(final, "node", "left")
             .select("node", "n_docs", "first", F.coalesce("linked", F.lit(0)).alias("linked"),
                     F.coalesce("component", "node").alias("component")))
    known = materialise(known, files)
    heads = known.groupBy("component").agg(F.min("first").alias("head"))
    known = join_per_key(known, heads, "component", "inner").select("node", "n_docs", "linked", "head")
    return join_per_key(rows, known, "node", "left").select(
        "doc_id", F.coalesce("head.id", "doc_id").alias("class_id"),
        F.coalesce(F.col("linked") + F.col("n_docs") - 1, F.lit(0)).alias("n_links"), "n_shingles", "rec",
        F.coalesce("head.rec", "rec").alias("class_rec"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id."""
    row = free_name(docs, "row_")
    files = files_for(docs)
    stays = materialise(near_groups(docs, id_col, text_col, files).filter("rec = class_rec").groupBy("rec")
                        .agg(F.count("*").alias("n")), files)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                         record(id_col, text_col).alias("rec"))
    alone = packed.join(stays.filter("n = 1"), "rec", "left_semi")
    # of rows equal in id and text the one with the larger hash, by an aggregate that starts in every task
    hashed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
                         record(id_col, text_col).alias("rec"), row_hash(docs).alias("mark"))
    again = hashed.join(stays.filter("n > 1"), "rec", "left_semi").groupBy("rec").agg(F.max_by(row, "mark").alias(row))
    return alone.select(f"{row}.*").unionByName(again.select(f"{row}.*")).coalesce(files)
