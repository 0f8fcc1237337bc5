"""Approximate nearest neighbours: an NN-descent graph and greedy search.

Nearness is the inner product.  Rows with equal vectors are one node of the
graph; a node remembers the ``top + 1`` smallest ids of its rows, which is all
that an answer can need.

1. Start: a bounded sample of nodes serves as pivots; every node joins the
   groups of its ``START_GROUPS`` nearest pivots.  A group of more than
   ``SPLIT_ABOVE`` takes one member in ``SECOND_SIZE`` as pivots of its own and is
   split by them, so groups stay as large as that at any number of vectors.  Nodes
   are compared within their groups.
2. NN-descent: in each round a node's best ``INTRODUCED`` neighbours, and the
   nodes it is such a neighbour of, are introduced to each other by joins: (centre, neighbour)
   pairs are dealt by the centre's group, vectors are joined to them once per
   group, and a group compares what its centres have gathered.  Only pairs
   that improve a node's list of ``DEGREE`` are returned.  Rounds end when few
   lists change.
3. Search: a query starts from the graph's entry at its own node and keeps the
   best ``POOL`` nodes found; each step expands the unexpanded ones along their
   edges, until the pool rests or ``STEPS`` steps are done.
4. The pool's rows are scored again in double precision on the original
   vectors and ranked; ties go to the smaller id.

Scores in single precision only choose candidates.  The side that ranks is scaled
row by row, the ranked side by one factor for the table, both powers of two,
so doubles of any finite size are compared without overflow.

Vectors that are null, empty or zero, or hold a null or a component that is not
finite, and rows without an id take no part.  Shorter vectors count as padded
with zeros.  Rows equal in id and vector count once.  Groups larger than
``MOST_MEMBERS`` are divided by hash and compared part by part, every part with
every other.  With no rows there are no answers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.common import materialise
from sessionlens.operators.joins import join_per_key

DEGREE = 32
START_GROUPS = 4
#: Best neighbours of a node that are introduced to each other in a round.
INTRODUCED = 12
#: Nodes per pivot, and pivots at most (the sample's bound).
GROUP_SIZE = 256
MOST_PIVOTS = 2048
#: Nodes that are compared in one task at once.
MOST_MEMBERS = 6144
#: Groups of more members are split by pivots of their own, one per SECOND_SIZE members.
SPLIT_ABOVE = 6144
SECOND_SIZE = 1024
ROUNDS = 4
#: Share of changed edges below which rounds end.
AT_REST = 0.02
POOL = 48
STEPS = 3
#: Improvements that a node takes from one group in a round.
OFFERS = 16


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))
            & F.exists(vector, lambda x: x != 0))


def make_nodes(rows: DataFrame, top: int) -> tuple[DataFrame, DataFrame]:
    """(node, v): one row per distinct vector, named by its smallest id; (node, id): its smallest ids."""
    same = ["h1", "h2"]
    hashed = rows.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), F.col("v")).alias("h2"))
    once = hashed.groupBy("id", *same).agg(F.first("v").alias("v"))
    few = (once.withColumn("r", F.row_number().over(Window.partitionBy(*same).orderBy("id")))
           .filter(F.col("r") <= top + 1))
    few = materialise(few.withColumn("node", F.min("id").over(Window.partitionBy(*same))))
    return few.filter("r = 1").select("node", "v"), few.select("node", "id")


def padded(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def exponent(largest: float) -> int:
    return int(np.frexp(largest)[1]) if largest else 0


def ranked_side(wide: np.ndarray, power: int) -> np.ndarray:
    """All rows times the same power of two, in single precision."""
    return np.ldexp(wide, -power).astype(np.float32)


def ranking_side(wide: np.ndarray) -> np.ndarray:
    """Every row times the power of two that brings it near 1: its order of the others stays the same."""
    power = np.frexp(np.abs(wide).max(axis=1, initial=0.0))[1]
    return np.ldexp(wide, -power[:, None]).astype(np.float32)


def best_of(names: np.ndarray, vectors: np.ndarray, others: np.ndarray, other_vectors: np.ndarray,
            worst: np.ndarray, count: int) -> pd.DataFrame:
    """For each name the ``count`` best others that beat its worst neighbour (columns a, b, s)."""
    out = []
    for at in range(0, len(names), 512):
        score = vectors[at:at + 512] @ other_vectors.T
        score[names[at:at + 512, None] == others[None, :]] = -np.inf
        k = min(count, score.shape[1])
        top = np.argpartition(-score, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(score, top, axis=1)
        good = value > worst[at:at + 512, None]
        row, _ = np.nonzero(good)
        out.append(pd.DataFrame({"a": names[at:at + 512][row], "b": others[top[good]],
                                 "s": value[good].astype(np.float64)}))
    return pd.concat(out, ignore_index=True)


def by_group(rows: DataFrame, compare, schema: str) -> DataFrame:
    """``compare`` of each group of rows with the same ``grp`` and ``part``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        key = None
        for batch in batches:
            marks = list(zip(batch["grp"], batch["part"], strict=True))
            at = 0
            while at < len(marks):
                stop = at + 1
                while stop < len(marks) and marks[stop] == marks[at]:
                    stop += 1
                if held and marks[at] != key:
                    yield compare(pd.concat(held, ignore_index=True))
                    held = []
                key = marks[at]
                held.append(batch.iloc[at:stop])
                at = stop
        if held:
            yield compare(pd.concat(held, ignore_index=True))

    return rows.repartition("grp", "part").sortWithinPartitions("grp", "part").mapInPandas(run, schema)


def divided(rows: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """``part`` of ``parts``: groups of more than MOST_MEMBERS rows are dealt by hash of ``name``, about ``most`` rows a part.

    ``rows`` is materialised.
    """
    sizes = rows.groupBy("grp").agg(F.count("*").alias("n")).filter(F.col("n") > MOST_MEMBERS)
    parts = F.coalesce(F.ceil(F.col("n") / (most or MOST_MEMBERS)).cast("long"), F.lit(1).cast("long"))
    return (join_per_key(rows, sizes, "grp").withColumn("parts", parts)
            .withColumn("part", F.pmod(F.xxhash64(name), F.col("parts"))).drop("n"))


def in_blocks(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` for each pair of parts of their group (``part``); ``half`` is the row's own part.

    Two parts together are about MOST_MEMBERS rows, and every two rows of a group meet in one pair.
    """
    dealt = divided(rows, name, max(1, MOST_MEMBERS // 2)).withColumnRenamed("part", "half")
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    pair = F.least("half", "other") * F.col("parts") + F.greatest("half", "other")
    return dealt.withColumn("part", pair).drop("parts", "other")


def best_in_block(group: pd.DataFrame, wide: np.ndarray, power: int, worst: np.ndarray, count: int) -> pd.DataFrame:
    """``best_of`` between the block's two halves, or within its only one."""
    names, half = group["node"].to_numpy(), group["half"].to_numpy()
    ranking, ranked = ranking_side(wide), ranked_side(wide, power)
    own = half == half[0]
    if own.all():
        # A part with itself (or, harmlessly once more, where the other part is empty).
        return best_of(names, ranking, names, ranked, worst, count)
    return pd.concat([best_of(names[a], ranking[a], names[~a], ranked[~a], worst[a], count) for a in (own, ~own)],
                     ignore_index=True)


def best_edges(edges: DataFrame, degree: int = DEGREE) -> DataFrame:
    once = edges.groupBy("a", "b").agg(F.max("s").alias("s"))
    ranked = once.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b")))
    return ranked.filter(F.col("r") <= degree)


def split_again(members: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, place, grp) with groups of more than SPLIT_ABOVE split by pivots among their own members.

    A part of a group meets all of the group's pivots; a group that has drawn none stays as it is.
    """
    large = members.groupBy("grp").agg(F.count("*").alias("n")).filter(F.col("n") > SPLIT_ABOVE).select("grp")
    large = materialise(large)
    if large.isEmpty():
        return members
    inside = materialise(join_per_key(members, large, "grp", "inner"))
    dealt = divided(inside, "node").withColumn("is_pivot", F.lit(0))
    pivots = dealt.filter(F.pmod(F.xxhash64(F.lit(5), F.col("node")), F.lit(SECOND_SIZE)) == 0)
    pivots = (pivots.select("node", "place", "grp", "parts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
                            .alias("part"), F.lit(1).alias("is_pivot")))
    rows = join_per_key(dealt.unionByName(pivots), nodes, "node", "inner")

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        drawn = group["is_pivot"].to_numpy() == 1
        out = group.loc[~drawn, ["node", "place", "grp"]]
        if drawn.any():
            centres = group[drawn].sort_values("node", kind="stable")
            vectors = ranking_side(padded(centres["v"], width))
            vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
            near = (ranking_side(padded(group.loc[~drawn, "v"], width)) @ vectors.T).argmax(axis=1)
            out = out.assign(grp=out["grp"] + MOST_PIVOTS * (1 + centres["node"].to_numpy()[near]))
        return out

    inner = by_group(rows, choose, "node long, place int, grp long")
    return materialise(join_per_key(members, large.withColumn("large", F.lit(True)), "grp").filter("large IS NULL")
                       .select("node", "place", "grp").unionByName(inner))


def start_graph(nodes: DataFrame, count: int, width: int, power: int = 0) -> tuple[DataFrame, DataFrame]:
    """(a, b, s) edges within the pivots' groups; (node, grp): the group of each node's nearest pivot."""
    pivots = min(MOST_PIVOTS, max(1, count // GROUP_SIZE))
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(pivots).select("v").collect()
    centres = ranking_side(padded([r["v"] for r in sample], width))
    centres = centres / np.linalg.norm(centres, axis=1, keepdims=True)
    groups = min(START_GROUPS, len(centres))

    def join_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = ranking_side(padded(batch["v"], width)) @ centres.T
            nearest = np.argsort(-score, axis=1, kind="stable")[:, :groups]
            yield pd.DataFrame({"node": batch["node"], "groups": list(nearest.astype("int64"))})

    joined = materialise(nodes.mapInPandas(join_groups, "node long, groups array<long>"))
    joined = joined.select("node", F.posexplode("groups").alias("place", "grp"))
    joined = split_again(joined, nodes, width)
    members = in_blocks(joined.select("node", "grp"), "node").join(nodes, "node")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        return best_in_block(group, padded(group["v"], width), power, np.full(len(group), -np.inf, "f4"), DEGREE)

    edges = by_group(members, compare, "a long, b long, s double")
    return materialise(best_edges(edges)), joined.filter("place = 0").select("node", "grp")


def descend(nodes: DataFrame, graph: DataFrame, home: DataFrame, width: int, power: int = 0) -> DataFrame:
    """One round of NN-descent: pairs (a, b, s) that improve a's list."""
    close = graph.filter(F.col("r") <= INTRODUCED)
    both = close.select("a", "b").unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b")))
    gathered = materialise(both.join(home.withColumnRenamed("node", "a"), "a")
                           .select("grp", F.col("b").alias("node"))
                           .unionByName(home.select("grp", "node")).distinct())
    lists = graph.groupBy("a").agg(F.count("*").alias("n"), F.min("s").alias("least"))
    worst = (nodes.join(lists, nodes["node"] == lists["a"], "left")
             .select("node", "v", F.when(F.col("n") >= DEGREE, F.col("least")).alias("worst")))
    members = join_per_key(in_blocks(gathered, "node"), worst, "node", "inner")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        least = group["worst"].to_numpy("f8", na_value=-np.inf)
        least = np.where(np.isnan(least), -np.inf, least).astype("f4")
        return best_in_block(group, padded(group["v"], width), power, least, OFFERS)

    return by_group(members, compare, "a long, b long, s double")


def build_graph(nodes: DataFrame, count: int, width: int, power: int) -> tuple[DataFrame, DataFrame]:
    graph, home = start_graph(nodes, count, width, power)
    for _ in range(ROUNDS):
        offers = descend(nodes, graph, home, width, power).withColumn("new", F.lit(1))
        merged = graph.drop("r").withColumn("new", F.lit(0)).unionByName(offers).groupBy("a", "b").agg(
            F.max("s").alias("s"), F.min("new").alias("new"))
        ranked = merged.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b")))
        after = materialise(ranked.filter(F.col("r") <= DEGREE))
        changed, total = after.agg(F.sum("new"), F.count("*")).first()
        graph = after.drop("new")
        if not total or changed < AT_REST * total:
            break
    return graph, home


def best_of_pool(found: DataFrame) -> DataFrame:
    """The POOL best (a, b, s) of each query a; ``done`` where some row of the pair is."""
    once = found.groupBy("a", "b").agg(F.max("s").alias("s"), F.max("done").alias("done"))
    ranked = once.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b")))
    return ranked.filter(F.col("r") <= POOL).drop("r")


def search(nodes: DataFrame, graph: DataFrame, home: DataFrame, queries: DataFrame, width: int, power: int) -> DataFrame:
    """(a, b, s): the best POOL nodes b found for each query node a (its own node among them)."""
    own = queries.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(float("inf")).alias("s"),
                         F.lit(True).alias("done"))
    near = graph.join(queries.withColumnRenamed("node", "a"), "a", "left_semi")
    pool = materialise(best_of_pool(own.unionByName(near.select("a", "b", "s", F.lit(False).alias("done")))))
    edges = graph.select(F.col("a").alias("via"), F.col("b").alias("to"))
    for _ in range(STEPS):
        fresh = pool.filter("NOT done").select("a", F.col("b").alias("via"))
        if fresh.isEmpty():
            break
        reached = join_per_key(fresh, edges, "via", "inner").select("a", F.col("to").alias("b")).distinct()
        # What left the pool earlier can come back to be scored, but not into a full pool.
        new = reached.join(pool.select("a", "b"), ["a", "b"], "left_anti")
        # Vectors of what a group's queries have reached travel to the group once.
        placed = new.join(home.withColumnRenamed("node", "a"), "a")
        wanted = materialise(placed.select("grp", F.col("b").alias("node")).distinct()
                             .withColumn("is_query", F.lit(0)))
        asking = (queries.join(home, "node").select("grp", "node").withColumn("is_query", F.lit(1)))
        parts = divided(wanted, "node").select("grp", "part", "node", "is_query")
        homes = parts.select("grp", "part").distinct()
        members = parts.unionByName(asking.join(homes, "grp").select("grp", "part", "node", "is_query"))
        members = join_per_key(members, nodes, "node", "inner")
        bounds = pool.groupBy("a").agg(F.count("*").alias("n"), F.min("s").alias("least"))
        members = (members.join(bounds, members["node"] == bounds["a"], "left")
                   .select("grp", "part", "node", "is_query", "v", F.when(F.col("n") >= POOL, F.col("least")).alias("worst")))

        def compare(group: pd.DataFrame) -> pd.DataFrame:
            asks = group["is_query"].to_numpy() == 1
            names, wide = group["node"].to_numpy(), padded(group["v"], width)
            least = group["worst"].to_numpy("f8", na_value=-np.inf)
            least = np.where(np.isnan(least), -np.inf, least).astype("f4")
            if not asks.any() or asks.all():
                return pd.DataFrame({"a": [], "b": [], "s": []}).astype({"a": "int64", "b": "int64", "s": "float64"})
            return best_of(names[asks], ranking_side(wide[asks]), names[~asks], ranked_side(wide[~asks], power), least[asks], POOL)

        found = by_group(members, compare, "a long, b long, s double")
        pool = materialise(best_of_pool(pool.withColumn("done", F.lit(True))
                                        .unionByName(found.withColumn("done", F.lit(False)))))
    return pool


def nearest(rows: DataFrame, is_query: Column, top: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest rows found for each row where ``is_query`` holds."""
    valid = rows.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    numbered = valid.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    nodes, ids = make_nodes(numbered, top)
    count, width, largest = nodes.agg(F.count("*"), F.max(F.size("v")), F.max(F.array_max(F.transform(
        "v", lambda x: F.abs(x.cast("double")))))).first()
    asked = valid.filter(is_query).select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).alias("q"),
                                          F.xxhash64(vector_col).alias("h1"),
                                          F.xxhash64(F.lit(1), F.col(vector_col)).alias("h2")).distinct()
    named = nodes.select("node", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), F.col("v")).alias("h2"))
    asked = materialise(asked.join(named, ["h1", "h2"]).select("query_id", "q", "node"))
    if not count:
        return asked.select("query_id", F.lit(0).alias("rank"), F.col("node").alias("vec_id"), F.lit(0.0).alias("score"))
    power = exponent(largest)
    graph, home = build_graph(nodes, count, width, power)
    pool = search(nodes, graph, home, asked.select("node").distinct(), width, power)
    wide = join_per_key(pool.select(F.col("a").alias("from"), F.col("b").alias("node")), nodes, "node", "inner")
    pairs = asked.withColumnRenamed("node", "from").join(wide, "from")
    product = F.aggregate(F.zip_with("q", "v", lambda x, y: F.coalesce(x.cast("double") * y.cast("double"), F.lit(0.0))),
                          F.lit(0.0), lambda s, x: s + x)
    scored = pairs.select("query_id", "node", product.alias("score"))
    answers = scored.join(ids, "node").filter(F.col("id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))
