"""Prefix trie of conversations, by truncation peeling.

Conversations are peeled from their last turns.  From the greatest depth
upwards, the nodes that survive from the depth below meet the conversations that
end at this depth; equal prefixes are one node, whose members, children, leaves
and savings are summed as it is found; then its last turn is stripped and it
goes up to its parent.

A prefix is named by its length and 128 bits: the sum of a digest of every turn
with its place.  Such sums are running totals, so a conversation's turns never
have to meet in one task.  Equal conversations are peeled once, with their
number as weight.  A node that at most ``TOGETHER`` different conversations pass
is light: all below the topmost light nodes is peeled inside tasks, whole
subtrees at a time, deepest turns first, so that a task holds one depth of a
subtree.  The heavy rest, at most one node in ``TOGETHER`` conversations a
depth, is peeled by one grouping per depth; what the light subtrees hand up is
summed before, partially in every task, so a node with any number of children
meets nothing but sums.

Turns stand in the order of ``turn`` (null first), then role, then text; a null
role or text is empty.  Rows without a conversation id belong to none and are
left out.  Repeated rows are turns of their own.  An empty table gives no node.
Columns beside the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.common import WORD, materialise

#: Different conversations that pass a node which a task peels by itself, at most.
TOGETHER = 512
#: Rows of a subtree that a task gathers before it peels the deepest of them.
GATHERED = 100_000
#: Ids in one piece of a list of conversations.
PIECE = 512
#: Conversations that share the opening of one, and turns of it that they share.
SHARED_BY, OPENINGS = 20, 4
KEY = ["depth", "k1", "k2"]
UP = ["u1", "u2"]
PARTS = ["s1", "s2", "s3", "s4"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def running(df: DataFrame, group: str, bucket: str, order: str, sums: dict[str, Column]) -> DataFrame:
    """Add running totals, the row itself included, of ``sums`` per group.

    A group is summed bucket by bucket; totals of the earlier buckets, one row
    each, are joined on.  ``df`` is read twice and must be materialised.
    """
    inside = Window.partitionBy(group, bucket).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = (df.groupBy(F.col(group).alias("_g"), F.col(bucket).alias("_b"))
              .agg(*[F.sum(value).alias(f"_{name}") for name, value in sums.items()])
              .select("_g", "_b", *[F.coalesce(F.sum(f"_{name}").over(before), F.lit(0)).alias(f"_{name}") for name in sums]))
    return (df.withColumns({name: F.sum(value).over(inside) for name, value in sums.items()})
            .join(totals, (F.col(group) == F.col("_g")) & (F.col(bucket) == F.col("_b")))
            .withColumns({name: F.col(name) + F.col(f"_{name}") for name in sums})
            .drop("_g", "_b", *[f"_{name}" for name in sums]))


def words_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def ordered_turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id, rank (from 1), bucket, at (increasing), turn_md5, words: one narrow row per turn."""
    turns = (conversations.filter(F.col(conv_col).isNotNull())
             .select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                     *[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))]))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = (turns.repartitionByRange(*order).sortWithinPartitions(*order)
              .select("conv_id", F.monotonically_increasing_id().alias("at"), words_of(F.col("text")).alias("words"),
                      F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
                      .alias("turn_md5"))
              .withColumn("bucket", F.shiftright("at", 33)))
    return running(materialise(placed), "conv_id", "bucket", "at", {"rank": F.lit(1)})


def per_conversation(big: DataFrame, small: DataFrame, key: str = "conv_id", how: str = "inner") -> DataFrame:
    """Join rows to one row per key; the hash gives the join a shuffle of its own, which AQE can split."""
    other = small.withColumnRenamed(key, "_key").withColumn("_spread", F.xxhash64("_key"))
    return (big.join(other, (F.col(key) == F.col("_key")) & (F.xxhash64(key) == F.col("_spread")), how)
            .drop("_key", "_spread"))


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first one of its twenty."""
    return (F.crc32(conv.cast("string").cast("binary")) % OPENINGS).cast("long")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, depth, bucket, at, turn_md5, words), and conv_id with its length.

    A conversation c begins with the first turns of c - c % 20 and goes on with its own, after as many.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    first = F.col("conv_id") - F.col("conv_id") % SHARED_BY
    base = sizes.select(F.col("conv_id").alias("_base"), F.col("n").alias("_base_n"))
    h = shared_turns(F.col("conv_id"))
    taken = F.least(h, F.coalesce(F.col("_base_n"), F.lit(0)))
    convs = (sizes.withColumn("_first", first).join(base, F.col("_first") == F.col("_base"), "left")
             .select("conv_id", h.alias("h"), taken.alias("taken"),
                     (taken + F.greatest(F.col("n") - h, F.lit(0))).alias("length")))
    convs = materialise(convs)
    own = (per_conversation(turns, convs.select("conv_id", "h", "taken")).filter(F.col("rank") > F.col("h"))
           .select("conv_id", (F.col("rank") - F.col("h") + F.col("taken")).alias("depth"), "bucket", "at",
                   "turn_md5", "words"))
    near = F.transform(F.sequence(F.lit(1 - SHARED_BY), F.lit(SHARED_BY - 1)),
                       lambda step: F.try_add(F.col("conv_id"), step.cast("long")))
    takers = F.filter(near, lambda c: c.isNotNull() & (c - c % SHARED_BY == F.col("conv_id"))
                      & (shared_turns(c) >= F.col("rank")))
    lent = (turns.filter((F.col("conv_id") % SHARED_BY == 0) & (F.col("rank") < OPENINGS))
            .select(F.explode(takers).alias("conv_id"), F.col("rank").alias("depth"), F.lit(-1).cast("long").alias("bucket"),
                    F.col("rank").alias("at"), "turn_md5", "words"))
    lent = lent.join(convs.select("conv_id"), "conv_id")
    return own.unionByName(lent), convs.select("conv_id", "length")


def with_keys(turns: DataFrame) -> DataFrame:
    """conv_id, depth, words, the prefix that ends at the turn (k1, k2) and the one before it (u1, u2)."""
    digest = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("turn_md5")))
    parts = turns.withColumns({p: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
                               for i, p in enumerate(PARTS)}).drop("turn_md5")
    summed = running(materialise(parts), "conv_id", "bucket", "at", {f"r{p}": F.col(p) for p in PARTS})
    word = lambda c: c.bitwiseAND(F.lit((1 << 32) - 1))
    joined = lambda a, b: F.shiftleft(word(a), 32).bitwiseOR(word(b))
    r, s = [F.col(f"r{p}") for p in PARTS], [F.col(p) for p in PARTS]
    return summed.select("conv_id", F.col("depth").cast("long").alias("depth"), "words",
                         joined(r[0], r[1]).alias("k1"), joined(r[2], r[3]).alias("k2"),
                         joined(r[0] - s[0], r[1] - s[1]).alias("u1"), joined(r[2] - s[2], r[3] - s[3]).alias("u2"))


COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
NODE = ["top1", "top2", *KEY, *UP, "conv_id", *COUNTS]
#: What reaches a node: from an ending, or from a child that has lost its last turn.
FRONT = ["top1", "top2", "k1", "k2", "conv_id", *COUNTS]


def peel(turns: pd.DataFrame, front: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Peel the given turns, deepest first; the nodes found, and what reaches nodes above them.

    ``turns`` hold, for every conversation that passes, its prefixes (KEY, UP, words; top1, top2 name the
    subtree), with ``ends`` conversations at its last turn, of which ``least`` is the smallest.  ``front`` holds
    what reaches them from below.
    """
    nodes = turns.drop_duplicates(["k1", "k2"]).sort_values("depth", ascending=False, kind="stable", ignore_index=True)
    numbered = nodes[["k1", "k2"]].assign(number=np.arange(len(nodes)))

    def number(df: pd.DataFrame, one: str, two: str) -> np.ndarray:
        found = df[[one, two]].set_axis(["k1", "k2"], axis=1).merge(numbered, how="left")["number"]
        return found.fillna(-1).to_numpy("i8")

    parent = number(nodes, *UP)
    least = np.full(len(nodes), np.iinfo("i8").max)
    n, children, leaves, saved = (np.zeros(len(nodes), "i8") for _ in COUNTS)
    ending = turns[turns["ends"] > 0]
    at = number(ending, "k1", "k2")
    np.add.at(n, at, ending["ends"].to_numpy())
    np.minimum.at(least, at, ending["least"].to_numpy())
    at = number(front, "k1", "k2")
    np.minimum.at(least, at, front["conv_id"].to_numpy())
    for own, name in zip((n, children, leaves, saved), COUNTS, strict=True):
        np.add.at(own, at, front[name].to_numpy())
    words, depths = nodes["words"].to_numpy(), nodes["depth"].to_numpy()
    starts = np.flatnonzero(np.append(True, depths[1:] != depths[:-1])[:len(depths)])
    for s, e in zip(starts, [*starts[1:], len(depths)], strict=True):
        leaves[s:e][children[s:e] == 0] = 1
        saved[s:e] += (n[s:e] - 1) * words[s:e]
        inner = np.flatnonzero(parent[s:e] >= 0) + s
        up = parent[inner]
        np.minimum.at(least, up, least[inner])
        for own, value in ((n, n[inner]), (children, 1), (leaves, leaves[inner]), (saved, saved[inner])):
            np.add.at(own, up, value)
    nodes = nodes.assign(conv_id=least, n_convs=n, n_children=children, n_leaves=leaves, saved_tokens=saved)[NODE]
    above = nodes[parent < 0]
    above = above.assign(k1=above["u1"], k2=above["u2"], n_children=1)[FRONT]
    return nodes, above


def peel_subtrees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Nodes of whole subtrees, whose turns come together (top_depth, top1, top2), deepest first."""
    nothing = pd.DataFrame({c: pd.Series(dtype="i8") for c in FRONT})
    held, front = None, nothing
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(held):
            continue
        last = held.iloc[-1]
        unfinished = ((held["top1"] == last["top1"]) & (held["top2"] == last["top2"])).to_numpy()
        if not unfinished.all():
            nodes, _ = peel(held[~unfinished], front)
            yield nodes
            held, front = held[unfinished], nothing
        lowest = held["depth"].iloc[-1]                      # its rows may go on in the next batch
        if len(held) > GATHERED and lowest < held["depth"].iloc[0]:
            nodes, front = peel(held[held["depth"] > lowest], front)
            yield nodes
            held = held[held["depth"] == lowest]
    if held is not None and len(held):
        yield peel(held, front)[0]


def ends_digests(ends: DataFrame) -> DataFrame:
    """KEY and the SHA-256 of the ascending ids of the conversations that end there, comma-joined.

    Ids are sorted over the cluster and joined to pieces first; then one task walks a node's pieces, as a
    SHA-256 must, and holds one piece at a time.
    """

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[KEY].to_numpy()
            new = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
            run = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            part = (np.arange(len(batch)) - first[run]) // PIECE
            cut = np.flatnonzero(np.append(True, (run[1:] != run[:-1]) | (part[1:] != part[:-1])))
            ids = batch["conv_id"].tolist()
            yield batch.iloc[cut].assign(ids=[",".join(map(str, ids[s:e])) for s, e in
                                              zip(cut, [*cut[1:], len(ids)], strict=True)])

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for batch in batches:
            out = []
            for key, ids in zip(batch[KEY].itertuples(index=False, name=None), batch["ids"], strict=True):
                if key == at:
                    state.update(b"," + ids.encode("ascii"))
                    continue
                if at is not None:
                    out.append((*at, state.hexdigest()))
                at, state = key, hashlib.sha256(ids.encode("ascii"))
            yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
        if at is not None:
            yield pd.DataFrame([(*at, state.hexdigest())], columns=[*KEY, "ends_sha256"])

    key = "depth long, k1 long, k2 long"
    return (ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
            .mapInPandas(pieces, f"{key}, conv_id long, ids string")
            .repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
            .mapInPandas(digests, f"{key}, ends_sha256 string"))


def by_key(df: DataFrame, other: DataFrame, how: str = "inner", left: list[str] = KEY) -> DataFrame:
    """Join to one row per KEY, in a shuffle of its own, which AQE can split."""
    names = {c: f"_{c}" for c in KEY}
    other = other.withColumnsRenamed(names).withColumn("_spread", F.xxhash64(*names.values()))
    match = (F.xxhash64(*left) == F.col("_spread"))
    for own, its in zip(left, names.values(), strict=True):
        match = match & (F.col(own) == F.col(its))
    return df.join(other, match, how).drop("_spread", *names.values())


def peel_heavy(arrivals: DataFrame, heavy: DataFrame, deepest: int) -> DataFrame:
    """Nodes of the heavy part: one grouping per depth, from the deepest up to the root.

    ``heavy`` has KEY, UP and words of every heavy node, ``arrivals`` the sums that endings and light subtrees
    bring to each.
    """
    done, front = None, None
    for depth in range(deepest, -1, -1):
        level = arrivals.filter(F.col("depth") == depth)
        if front is not None:
            level = level.unionByName(front)
        found = (level.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in COUNTS])
                 .join(heavy.filter(F.col("depth") == depth), KEY)
                 .withColumn("n_leaves", F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")))
                 .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
                 .select(*KEY, *UP, "conv_id", *COUNTS))
        found = materialise(found)
        done = found if done is None else done.unionByName(found)
        front = found.select((F.col("depth") - 1).alias("depth"), F.col("u1").alias("k1"), F.col("u2").alias("k2"), "conv_id",
                             "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens")
    return done


def trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text", share_openings: bool = False, together: int | None = None) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node.

    With ``share_openings`` conversations are rebuilt first (``rebuild``).
    """
    together = TOGETHER if together is None else together
    turns = materialise(ordered_turns(conversations, conv_col, turn_col, role_col, text_col))
    if share_openings:
        turns, convs = rebuild(turns)
    else:
        convs = turns.groupBy("conv_id").agg(F.count("*").alias("length"))
        turns = turns.withColumnRenamed("rank", "depth")
    turns = materialise(with_keys(turns))
    # where each conversation ends; equal ones have the same end
    last = turns.select("conv_id", *KEY)
    ends = (convs.select("conv_id", F.col("length").alias("depth"))
            .join(last, ["conv_id", "depth"], "left").na.fill(0, ["k1", "k2"]))
    ends = materialise(ends)
    alike = ends.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("ends"))
    alike = materialise(alike)
    if not alike.take(1):
        return conversations.sparkSession.createDataFrame(
            [], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                "saved_tokens long, ends_sha256 string")
    # one of every group of equal conversations passes its prefixes, its last turn with the weight of the group
    own = alike.filter("depth > 0").select("conv_id", F.col("depth").alias("length"), "ends")
    passing = (per_conversation(turns, own)
               .withColumn("ends", F.when(F.col("depth") == F.col("length"), F.col("ends")).otherwise(F.lit(0))).drop("length"))
    passing = materialise(passing)
    heavy = (passing.groupBy(*KEY).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in (*UP, "words")])
             .filter(F.col("n") > together).drop("n"))
    zero = F.lit(0).cast("long")
    root = alike.limit(1).select(*[zero.alias(c) for c in (*KEY, *UP, "words")])
    heavy = materialise(heavy.unionByName(root))
    marked = by_key(passing, heavy.select(*KEY, F.lit(True).alias("is_heavy")), "left")
    marked = materialise(marked.withColumn("is_heavy", F.col("is_heavy").isNotNull()))
    # the topmost light prefix of every conversation names the subtree that its lower turns belong to
    tops = (marked.filter(~F.col("is_heavy")).groupBy("conv_id").agg(F.min(F.struct(*KEY)).alias("top"))
            .select("conv_id", F.col("top.depth").alias("top_depth"), F.col("top.k1").alias("top1"),
                    F.col("top.k2").alias("top2")))
    light = per_conversation(marked.filter(~F.col("is_heavy")).drop("is_heavy"), tops)
    light = (light.select("top_depth", "top1", "top2", *KEY, *UP, "words", "ends", F.col("conv_id").alias("least"))
             .repartition("top_depth", "top1", "top2")
             .sortWithinPartitions("top_depth", "top1", "top2", F.col("depth").desc()))
    peeled = light.mapInPandas(peel_subtrees, ", ".join(f"{c} long" for c in NODE))
    peeled = materialise(peeled)
    handed = peeled.filter((F.col("k1") == F.col("top1")) & (F.col("k2") == F.col("top2")))
    arrivals = handed.select((F.col("depth") - 1).alias("depth"), F.col("u1").alias("k1"), F.col("u2").alias("k2"), "conv_id",
                             "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens")
    ending = alike.join(heavy.select(*KEY), KEY, "left_semi")
    arrivals = arrivals.unionByName(ending.select(*KEY, "conv_id", F.col("ends").alias("n_convs"), zero.alias("n_children"),
                                                  zero.alias("n_leaves"), zero.alias("saved_tokens")))
    arrivals = materialise(arrivals.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"),
                                                      *[F.sum(c).alias(c) for c in COUNTS]))
    deepest = heavy.agg(F.max("depth")).first()[0]
    nodes = materialise(peel_heavy(arrivals, heavy, deepest).unionByName(peeled.select(*KEY, *UP, "conv_id", *COUNTS)))
    parents = nodes.select(*KEY, F.col("conv_id").alias("parent_conv_id"))
    out = by_key(nodes.withColumn("up_depth", F.col("depth") - 1), parents, "left", ["up_depth", *UP])
    single = alike.filter("ends = 1").select(*KEY, F.sha2(F.col("conv_id").cast("string"), 256).alias("ends_sha256"))
    many = ends_digests(ends.join(alike.filter("ends > 1").select(*KEY), KEY, "left_semi"))
    out = by_key(out, single.unionByName(many), "left")
    return out.select("conv_id", "depth", "parent_conv_id", *COUNTS,
                      F.coalesce(F.col("ends_sha256"), F.lit(EMPTY_SHA)).alias("ends_sha256"))
