"""Quality classifier: features and scores against plain Python, the solver against its optimality conditions,
held-out accuracy."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlens.llm import quality

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, quality long, score double, good long, rank double"


def good_text(seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "house", "Was", "old", "and", "green.", "trees", "stood", "it,", "by"])
                    for _ in range(rng.randint(6, 60)))


def bad_text(seed):
    rng = random.Random(seed)
    word = good_text(seed).split()[0]
    return [good_text(seed).upper().replace(" ", "!! "), good_text(seed).replace(" ", "$$$ "), " ".join([word] * 30)][rng.randrange(3)]


def plain_features(text):
    """The n-grams themselves, as a set of strings."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
    shapes = [re.sub(rb"a+", b"a", re.sub(rb"A+", b"A", re.sub(rb"0+", b"0", re.sub(rb"[a-z\x80-\xff]", b"a",
              re.sub(rb"[A-Z]", b"A", re.sub(rb"[0-9]", b"0", w)))))) for w in words]
    shapes = [b"=" if k and words[k] == words[k - 1] else s for k, s in enumerate(shapes)]
    return ({("w", *words[k:k + n]) for n in (1, 2) for k in range(len(words) - n + 1)}
            | {("s", *shapes[k:k + n]) for n in (1, 2, 3) for k in range(len(shapes) - n + 1)})


def test_features_are_the_sets_of_grams(monkeypatch):
    monkeypatch.setattr(quality, "BUCKETS", 1 << 30)       # so that no two grams of the test share a number
    texts = ["", "  ", "one", "La La La La", "É é ÉÉ a1B2", "same words", "same  words\n", "a b a b a b", "x" * 5000,
             *map(good_text, range(20)), *map(bad_text, range(20)), good_text(3)]
    buckets, many = quality.features(texts)
    ends = np.cumsum(many)
    got = [frozenset(buckets[e - n:e].tolist()) for e, n in zip(ends, many, strict=True)]
    want = [plain_features(t) for t in texts]
    assert [len(g) for g in got] == many.tolist() == [len(w) for w in want]
    for g, w in zip(got, want, strict=True):       # a gram has one number in all texts
        for other, its in zip(got, want, strict=True):
            assert len(g & other) == len(w & its)
    assert got[5] == got[6]


def test_runs_do_not_change_features(monkeypatch):
    texts = [*map(good_text, range(30)), "x " * 4000, "", *map(bad_text, range(9))]
    monkeypatch.setattr(quality, "TOGETHER", 500)
    runs = list(quality.in_runs(texts))
    assert len(runs) > 5 and [i for r in runs for i in range(r.start, r.stop)] == list(range(len(texts)))
    together = quality.features(texts)
    apart = [quality.features(texts[r]) for r in runs]
    assert np.array_equal(together[0], np.concatenate([x for x, _ in apart]))
    assert np.array_equal(together[1], np.concatenate([x for _, x in apart]))


def test_log_count_ratios():
    r = quality.log_count_ratios(np.array([3.0, 0, 1]), np.array([0.0, 5, 1]))
    p, q = [4, 1, 2], [1, 6, 2]
    assert r == pytest.approx([math.log(a / 7 * 9 / b) for a, b in zip(p, q, strict=True)])


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 5))
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=80) > 0, 1.0, -1.0)
    w, alpha = quality.dual_coordinate_descent([(np.arange(5), row) for row in x], y, 5, 0.7, 3000, 1e-7)
    assert w == pytest.approx((alpha * y) @ x) and (alpha >= 0).all() and (alpha <= 0.7).all()
    margin = y * (x @ w)
    for a, m in zip(alpha, margin, strict=True):
        assert (m >= 1 - 1e-5 if a == 0 else m <= 1 + 1e-5 if a == 0.7 else abs(m - 1) < 1e-5)
    primal = w @ w / 2 + 0.7 * np.maximum(0, 1 - margin).sum()
    assert primal == pytest.approx(alpha.sum() - w @ w / 2, abs=1e-5)


def test_logistic_curve_has_no_slope_left():
    rng = np.random.default_rng(6)
    m = rng.normal(size=400)
    good = rng.random(400) < 1 / (1 + np.exp(-(2 * m + 0.5)))
    slope, shift = quality.logistic_curve(m, good, np.ones(400))
    assert 1.3 < slope < 3 and 0 < shift < 1.1


@pytest.fixture(scope="module")
def tables(spark):
    texts = [(i, good_text(i) if i % 3 else bad_text(i)) for i in range(240)]
    texts += [(900, None), (901, ""), (902, "   "), (None, good_text(1)), texts[5], texts[5], (903, "word " * 60_000)]
    labels = [(i, int(i % 3 > 0)) for i in range(200)] + [(7, None), (None, 0), (5000, 1), (8, 2)]
    return (spark.createDataFrame([(*t, 9, 0.5, None, 1.0) for t in texts], SCHEMA),
            spark.createDataFrame([(*x, "t") for x in labels], "doc_id long, quality long, text string"), texts, labels)


def test_ratios_count_every_label_and_scores_follow_the_model(spark, tables):
    docs, labels, texts, marks = tables
    model = quality.train(docs, labels)
    of = collections.defaultdict(list)
    for doc, label in marks:
        if doc is not None and label in (0, 1) and zlib.crc32(str(doc).encode()) % 5:
            of[doc].append(label)
    counts = np.zeros((2, quality.BUCKETS))
    for doc, text in texts:
        for label in of.get(doc, []):
            buckets, _ = quality.features([text or ""])
            counts[label][buckets] += 1
    assert model.ratios == pytest.approx(quality.log_count_ratios(counts[1], counts[0]))
    out = quality.classify(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["held_out"], round(r["score"], 9), r["predicted"])
                 for r in out.collect())
    want = []
    for doc, text in texts:
        buckets, _ = quality.features([text or ""])
        values = model.ratios[buckets]
        margin = model.weights[-1] + (model.weights[buckets] @ values / math.sqrt(values @ values) if len(buckets) else 0)
        score = 1 / (1 + math.exp(-(model.slope * margin + model.shift)))
        out_of = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0
        want.append((-1 if doc is None else doc, out_of, round(score, 9), int(score >= 0.3)))
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in sorted(want)]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in sorted(want)], abs=1e-8)


def test_learning_ignores_held_out_labels_and_stays_within_its_sample(spark, tables):
    docs, labels, *_ = tables
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.train(docs, x, sample=60) for x in (labels, flipped))
    assert np.array_equal(a.weights, b.weights) and (a.slope, a.shift) == (b.slope, b.shift)


def test_one_class_no_labels_empty_tables(spark, tables):
    docs, labels, *_ = tables
    only = quality.classify(docs, labels.filter("quality = 1")).collect()
    assert len({r["score"] for r in only}) == 1 and only[0]["score"] > 0.9 and len(only) == docs.count()
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).collect() == []


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)
    assert all(r["predicted"] for r in rows if r["quality"] == 1)
