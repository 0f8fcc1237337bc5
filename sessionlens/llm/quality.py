"""Quality classifier: a support vector machine on naive Bayes features.

A text's features are indicators of n-grams, hashed to ``BUCKETS`` numbers:
n-grams of one and two words, and of one to three word shapes (runs of small
letters, capitals and digits count as one character each, other characters
stand for themselves; a word equal to the one before it has a shape of its
own).  Each bucket is scaled by its log-count ratio, the logarithm of how much
likelier it is in good texts than in bad ones, from the counts of documents of
all rows that may be learned from.  A text's vector is scaled to length one; a
linear model with hinge loss is fitted to a bounded sample of labelled texts by
dual coordinate descent, and a logistic curve, fitted to margins of texts that
the model had not seen, turns margins into scores.

Learned from: rows of ``labels`` with a label 0 or 1 whose document exists and
is not held out; several labels of one document count each.  Repeated texts
count in the ratios as often as they stand there and are drawn once.  A null
text counts as empty; an empty text has no n-gram and gets the score of the
bias.  Labels of one class only give every text that class's smoothed share,
no labels 0.5.  Every row of ``docs`` gives one row, repeated rows and rows
without an id (never held out, never learned from) as well; texts are read
whole, and long ones by themselves.  Empty tables give empty tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.llm import hashing as H
from sessionlens.llm.common import materialise

#: Numbers that n-grams are hashed to.
BUCKETS = 1 << 18
#: Labelled texts that the linear model is fitted to, at most; half of each class where there are enough.
TRAIN_TEXTS = 8_000
#: Features of all those texts together, at most.
TRAIN_FEATURES = 12_000_000
#: Added to every count before ratios are taken.
SMOOTHING = 1.0
#: Price of a margin violation.
COST = 1.0
#: A text is predicted good from this score on.
LEAST_SCORE = 0.3
#: Characters of texts whose features are found at once; a longer text is read by itself.
TOGETHER = 1 << 20
#: n-grams: lengths in words, lengths in shapes.
WORD_GRAMS, SHAPE_GRAMS = (1, 2), (1, 2, 3)

LETTER, CAPITAL, DIGIT, SPACE = b"a"[0], b"A"[0], b"0"[0], b" "[0]
_shape = np.arange(256, dtype="u1")
_shape[97:123] = LETTER
_shape[128:] = LETTER
_shape[65:91] = CAPITAL
_shape[48:58] = DIGIT
_shape[H.SPACE] = SPACE
#: What stands for the shape of a word that repeats the one before it.
REPEATED = H.U(0xA24BAED4963EE407)
#: Sets shapes apart from words that look the same.
SHAPED = H.U(0x9FB21C651E98DF25)


def shape_text(data: bytes) -> bytes:
    """The text with runs of letters, capitals, digits or white space shortened to one character."""
    kind = _shape[np.frombuffer(data, dtype="u1")]
    run = np.isin(kind, (LETTER, CAPITAL, DIGIT, SPACE))
    keep = np.ones(len(kind), dtype=bool)
    keep[1:] = ~(run[1:] & (kind[1:] == kind[:-1]))
    return kind[keep].tobytes()


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of every text's n-grams, each once and ascending, and how many each text has."""
    parts = [t.encode("utf-8") for t in texts]
    data = b"\n".join(parts)
    starts, ends = H.word_spans(data)
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
    of = np.searchsorted(begins, starts, side="right") - 1
    words = H.word_hashes(data, starts, ends)
    shaped = shape_text(data)
    shapes = H.word_hashes(shaped, *H.word_spans(shaped))
    again = np.zeros(len(words), dtype=bool)
    again[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    shapes = np.where(again, REPEATED, H.mix(shapes ^ SHAPED))
    found = []
    for values, lengths in ((words, WORD_GRAMS), (shapes, SHAPE_GRAMS)):
        for n in lengths:
            grams = H.run_hashes(values, n, n)
            first = of[:len(grams)]
            inside = first == of[n - 1:]
            found.append(first[inside] * BUCKETS + (grams[inside] % H.U(BUCKETS)).astype("i8"))
    keys = np.unique(np.concatenate(found))
    return (keys % BUCKETS).astype("i4"), np.bincount(keys // BUCKETS, minlength=len(texts))


def in_runs(texts: list[str]) -> Iterator[slice]:
    """Consecutive texts of at most ``TOGETHER`` characters, or one longer text."""
    start, total = 0, 0
    for k, text in enumerate(texts):
        if k > start and total + len(text) > TOGETHER:
            yield slice(start, k)
            start, total = k, 0
        total += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def log_count_ratios(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Per bucket log of its smoothed share of the good texts' counts over that of the bad ones'."""
    p, q = good + SMOOTHING, bad + SMOOTHING
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: float = COST,
                            rounds: int = 60, tolerance: float = 0.01, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (and dual variables) of min |w|^2 / 2 + cost * sum(hinge(1 - y w.x)).

    ``rows`` are (indices, values).  Each step solves one text's dual variable within [0, cost] and moves the
    weights along; a round visits all texts in a random order, until no projected gradient exceeds ``tolerance``.
    """
    rng = np.random.default_rng(seed)
    w, alpha = np.zeros(size), np.zeros(len(rows))
    norms = np.array([float(values @ values) for _, values in rows])
    for _ in range(rounds):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            at, values = rows[i]
            slope = y[i] * float(w[at] @ values) - 1.0
            kept = min(slope, 0.0) if alpha[i] == 0 else max(slope, 0.0) if alpha[i] == cost else slope
            worst = max(worst, abs(kept))
            if kept:
                moved = min(max(alpha[i] - slope / norms[i], 0.0), cost)
                w[at] += (moved - alpha[i]) * y[i] * values
                alpha[i] = moved
        if worst <= tolerance:
            break
    return w, alpha


def logistic_curve(margins: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """slope, shift of 1 / (1 + exp(-(slope * margin + shift))), by Newton steps on smoothed targets."""
    many, few = weight[good].sum(), weight[~good].sum()
    target = np.where(good, (many + 1) / (many + 2), 1 / (few + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    theta = np.array([1.0, 0.0])

    def loss(t):
        z = x @ t
        return float((weight * (np.logaddexp(0, z) - target * z)).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -500, 500)))
        gradient = x.T @ (weight * (p - target))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2)
        step, size = np.linalg.solve(curve, gradient), 1.0
        while size > 1e-8 and loss(theta - size * step) > loss(theta):
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


@dataclass
class QualityModel:
    ratios: np.ndarray       # per bucket
    weights: np.ndarray      # per bucket, the last one the bias
    slope: float
    shift: float

    def scores(self, texts: list[str]) -> np.ndarray:
        out = [np.empty(0)]
        scaled = self.ratios * self.weights[:-1]
        for run in in_runs(texts):
            buckets, many = features(texts[run])
            of = np.repeat(np.arange(len(many)), many)
            length = np.sqrt(np.bincount(of, weights=self.ratios[buckets] ** 2, minlength=len(many)))
            margin = np.bincount(of, weights=scaled[buckets], minlength=len(many)) / np.maximum(length, 1e-12)
            z = self.slope * (margin + self.weights[-1]) + self.shift
            out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
        return np.concatenate(out)


@dataclass
class ConstantModel:
    share: float

    def scores(self, texts: list[str]) -> np.ndarray:
        return np.full(len(texts), self.share)


def fit(samples: list[np.ndarray], good: np.ndarray, ratios: np.ndarray, weight: np.ndarray) -> QualityModel:
    """Weights from all samples; the curve from margins of each half under the other half's weights."""
    rows = []
    for buckets in samples:
        values = ratios[buckets]
        values = values / max(float(np.sqrt(values @ values)), 1e-12)
        rows.append((np.append(buckets, BUCKETS), np.append(values, 1.0)))
    y = np.where(good, 1.0, -1.0)
    half = np.zeros(len(rows), dtype=bool)
    for side in (good, ~good):
        half[np.flatnonzero(side)[::2]] = True
    margins = np.zeros(len(rows))
    for own in (half, ~half):
        w, _ = dual_coordinate_descent([rows[i] for i in np.flatnonzero(own)], y[own], BUCKETS + 1)
        margins[~own] = [float(w[at] @ values) for at, values in (rows[i] for i in np.flatnonzero(~own))]
    slope, shift = logistic_curve(margins, good, weight)
    w, _ = dual_coordinate_descent(rows, y, BUCKETS + 1)
    return QualityModel(ratios, w, slope, shift)


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5, is 0 (a row without an id is not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str) -> DataFrame:
    """text, good, bad (how many labels of each kind) of the documents that may be learned from."""
    marks = (labels.filter(F.col(label_id).isNotNull() & F.col(label_col).isin(0, 1))
             .groupBy(F.col(label_id).alias("label_id"))
             .agg(F.sum(F.col(label_col).cast("long")).alias("good"), F.count("*").alias("marks"))
             .select("label_id", "good", (F.col("marks") - F.col("good")).alias("bad"), F.xxhash64("label_id").alias("spread")))
    texts = (docs.filter(F.col(id_col).isNotNull() & ~held_out(id_col))
             .select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    # the second key gives the join a shuffle of its own, which AQE can split at an id that many rows share;
    # labels grow with the documents, so they are never broadcast
    return (texts.join(marks.hint("merge"), (F.col("id") == F.col("label_id")) & (F.xxhash64("id") == F.col("spread")))
            .filter(~held_out("label_id")).select("text", "good", "bad"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "quality",
          sample: int = TRAIN_TEXTS) -> QualityModel | ConstantModel:
    """Counts over every labelled text, the linear model on at most ``sample`` of them."""
    rows = labelled(docs, labels, id_col, text_col, label_id, label_col)
    many = rows.agg(*[F.coalesce(F.sum((F.col(c) > 0).cast("long")), F.lit(0)).alias(c) for c in ("good", "bad")]).first()
    if not (many["good"] and many["bad"]):
        n = many["good"] + many["bad"]
        return ConstantModel((many["good"] + 1) / (n + 2) if n else 0.5)
    share = [min(1.0, sample / 2 / many[c]) for c in ("bad", "good")]

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row with the counts per bucket of all rows (class -1), and the buckets of the drawn texts (0 or 1)."""
        totals = np.zeros((2, BUCKETS), dtype="i8")
        for batch in batches:
            texts, marks = list(batch["text"]), batch[["bad", "good"]].to_numpy()
            for run in in_runs(texts):
                buckets, size = features(texts[run])
                for kind in (0, 1):
                    totals[kind] += np.bincount(buckets, weights=np.repeat(marks[run, kind], size),
                                                minlength=BUCKETS).astype("i8")
                ends = np.cumsum(size)
                rank = batch["rank"].to_numpy()[run]
                drawn = [(kind, rank[i], buckets[ends[i] - size[i]:ends[i]].tobytes()) for i in range(len(size))
                         for kind in (0, 1) if marks[run][i, kind] and rank[i] < share[kind]]
                if drawn:
                    yield pd.DataFrame(drawn, columns=["kind", "rank", "buckets"])
        if totals.any():
            yield pd.DataFrame([(-1, 0.0, zlib.compress(totals.tobytes(), 1))], columns=["kind", "rank", "buckets"])

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((2, BUCKETS), dtype="i8")
        for batch in batches:
            for packed in batch["buckets"]:
                totals += np.frombuffer(zlib.decompress(packed), dtype="i8").reshape(totals.shape)
        seen = np.flatnonzero(totals.any(axis=0))
        yield pd.DataFrame({"bucket": seen, "bad": totals[0][seen], "good": totals[1][seen]})

    # equal texts have equal ranks, evenly spread over 0..1
    rank = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    seen = materialise(rows.withColumn("rank", rank).mapInPandas(counted, "kind int, rank double, buckets binary"))
    # the counts of many tasks are added in one, and those of all by a shuffle of at most BUCKETS rows a task
    adders = max(8, seen.rdd.getNumPartitions() // 32)
    counts = (seen.filter("kind < 0").coalesce(adders).mapInPandas(added, "bucket long, bad long, good long")
              .groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas())
    good, bad = np.zeros(BUCKETS), np.zeros(BUCKETS)
    good[counts["bucket"]], bad[counts["bucket"]] = counts["good"], counts["bad"]
    drawn = seen.filter("kind >= 0").dropDuplicates(["kind", "buckets"]).withColumn("size", F.octet_length("buckets") / 4)
    # each class's texts in the order of their ranks, until half of either bound is reached
    lasts = [0.0, 0.0]
    for kind in (0, 1):
        sizes = (drawn.filter(F.col("kind") == kind).select("rank", "size").orderBy("rank").limit(sample // 2).toPandas())
        fits = np.cumsum(sizes["size"].to_numpy()) <= TRAIN_FEATURES / 2
        lasts[kind] = float(sizes["rank"][fits].max()) if fits.any() else -1.0
    chosen = (drawn.filter(F.col("rank") <= F.when(F.col("kind") == 0, F.lit(lasts[0])).otherwise(F.lit(lasts[1])))
              .select("kind", "rank", "buckets").toPandas().sort_values(["rank", "kind"], kind="stable"))
    kind = chosen["kind"].to_numpy() == 1
    if kind.all() or not kind.any():
        return ConstantModel((many["good"] + 1) / (many["good"] + many["bad"] + 2))
    weight = np.where(kind, many["good"] / kind.sum(), many["bad"] / (~kind).sum())
    weight *= len(kind) / weight.sum()
    return fit([np.frombuffer(x, dtype="i4") for x in chosen["buckets"]], kind, log_count_ratios(good, bad), weight)


def with_score(docs: DataFrame, model: QualityModel | ConstantModel, text_col: str = "text",
               score_out: str = "score") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)        # two numbers per bucket

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(shared.value.scores([t or "" for t in batch]))

    return docs.withColumn(score_out, score(F.col(text_col)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_id: str = "doc_id", label_col: str = "quality", least_score: float = LEAST_SCORE) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``."""
    model = train(docs, labels, id_col, text_col, label_id, label_col)
    read = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return (with_score(read, model)
            .select("doc_id", "held_out", "score", (F.col("score") >= least_score).cast("int").alias("predicted")))
