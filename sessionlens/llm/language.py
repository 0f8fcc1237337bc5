"""Language ID by a byte convolutional network.

Each UTF-8 byte has a small vector; filters of several widths slide over a
window, the largest response of each filter is kept (max pooling), and a
softmax layer names the language.  The network is trained in numpy on the
driver, from a sample whose size is bounded by ``TRAIN_WINDOWS`` (windows drawn
evenly over the languages), and applied to every byte of every text in batches
of fixed-length windows.  A text's log-probabilities are the means over its
windows, weighted by their length.

Only rows that the caller marks for learning, with a label, are learned from.
A text that is null or has no letter is ``und`` with score 0.  Without any
learned label every text is ``und``.  Equal texts get equal answers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Bytes of a window.
WINDOW = 128
#: Labelled windows that are learned from, at most, over all languages.
TRAIN_WINDOWS = 12_000
#: Windows that one document gives to the sample, at most.
WINDOWS_PER_DOCUMENT = 4
WIDTHS = (2, 4)
FILTERS = 12
EMBEDDING = 6
#: Windows that are computed at once.
BATCH = 2048


@dataclass
class ByteConvNet:
    languages: list[str]
    table: np.ndarray          # 256 + 1 (padding) x EMBEDDING
    filters: list[np.ndarray]  # per width: width * EMBEDDING x FILTERS
    shift: np.ndarray          # per filter
    out: np.ndarray            # filters x languages
    out_shift: np.ndarray

    def responses(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of each filter in each window, and the unrolled input per width."""
        n, length = windows.shape
        vectors = self.table[windows]
        unrolled, best = [], []
        for weights in self.filters:
            width = weights.shape[0] // EMBEDDING
            places = length - width + 1
            view = np.lib.stride_tricks.as_strided(
                vectors, (n, places, width * EMBEDDING),
                (vectors.strides[0], vectors.strides[1], vectors.strides[2]), writeable=False)
            unrolled.append(view)
            best.append((np.ascontiguousarray(view).reshape(-1, width * EMBEDDING) @ weights)
                        .reshape(n, places, -1))
        return best, unrolled

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(windows), BATCH):
            best, _ = self.responses(windows[at:at + BATCH])
            pooled = np.concatenate([b.max(axis=1) for b in best], axis=1) + self.shift
            out.append(log_softmax(np.maximum(pooled, 0) @ self.out + self.out_shift))
        return np.concatenate(out)


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def windows_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The text cut into windows (the last one padded with 256) and the bytes in each."""
    count = max(1, -(-len(data) // WINDOW))
    out = np.full(count * WINDOW, 256, dtype="int16")
    out[:len(data)] = np.frombuffer(data, dtype="uint8")
    sizes = np.full(count, WINDOW)
    sizes[-1] = len(data) - (count - 1) * WINDOW
    return out.reshape(count, WINDOW), sizes


def fit(texts: list[str], labels: list[str], epochs: int = 8, seed: int = 7, rate: float = 0.004,
        batch: int = 64) -> ByteConvNet:
    """Train by Adam on windows; the last window of a text counts if it is at least a quarter full."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    rows, marks = [], []
    for text, label in zip(texts, labels, strict=True):
        windows, sizes = windows_of(text.encode("utf-8"))
        keep = sizes * 4 >= WINDOW
        keep[0] = True
        rows.append(windows[keep])
        marks += [languages.index(label)] * int(keep.sum())
    x, y = np.concatenate(rows), np.array(marks)
    if len(x) > TRAIN_WINDOWS:
        chosen = rng.permutation(len(x))[:TRAIN_WINDOWS]
        x, y = x[chosen], y[chosen]
    # every language weighs the same
    weight = (len(y) / (len(languages) * np.bincount(y, minlength=len(languages)).clip(1)))[y].astype("f4")
    total = len(WIDTHS) * FILTERS
    table = rng.normal(0, 0.5, (257, EMBEDDING)).astype("f4")
    table[256] = 0
    net = ByteConvNet(languages, table,
                      [rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)).astype("f4") for w in WIDTHS],
                      np.zeros(total, "f4"), rng.normal(0, total ** -0.5, (total, len(languages))).astype("f4"),
                      np.zeros(len(languages), "f4"))
    params = [net.table, *net.filters, net.shift, net.out, net.out_shift]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            grads = _gradients(net, x[pick], y[pick], weight[pick])
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
            net.table[256] = 0
    return net


def _gradients(net: ByteConvNet, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    n = len(x)
    best, unrolled = net.responses(x)
    at = [b.argmax(axis=1) for b in best]
    pooled = np.concatenate([b.max(axis=1) for b in best], axis=1) + net.shift
    hidden = np.maximum(pooled, 0)
    error = np.exp(log_softmax(hidden @ net.out + net.out_shift))
    error[np.arange(n), y] -= 1
    error *= weight[:, None] / n
    d_hidden = (error @ net.out.T) * (pooled > 0)
    d_table = np.zeros_like(net.table)
    d_filters = []
    for k, (weights, view, place) in enumerate(zip(net.filters, unrolled, at, strict=True)):
        width = weights.shape[0] // EMBEDDING
        d = d_hidden[:, k * FILTERS:(k + 1) * FILTERS]
        seen = view[np.arange(n)[:, None], place]                 # n x filters x (width * EMBEDDING)
        d_filters.append(np.einsum("nf,nfk->kf", d, seen))
        back = (d[:, :, None] * weights.T[None]).reshape(n, -1, width, EMBEDDING)
        bytes_at = x[np.arange(n)[:, None, None], place[:, :, None] + np.arange(width)]
        np.add.at(d_table, bytes_at.reshape(-1), back.reshape(-1, EMBEDDING))
    return [d_table, *d_filters, d_hidden.sum(axis=0), hidden.T @ error, error.sum(axis=0)]


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, modulo 4, is 2 (a row without an id is not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_for_training(learnable: DataFrame, text_col: str, label_col: str,
                        windows: int = TRAIN_WINDOWS) -> tuple[list[str], list[str]]:
    """Texts and labels, ``windows`` of them in expectation and twice that at most.

    A document gives ``WINDOWS_PER_DOCUMENT`` pieces from evenly spaced places,
    one that hashes below its language's share of the bound.  Equal pieces of one
    label, as of many copies, are one.
    """
    lettered = learnable.filter(F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = {r["label"]: r["n"] for r in lettered.groupBy(F.col(label_col).alias("label"))
              .agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], []
    share = windows / len(counts) / WINDOWS_PER_DOCUMENT
    below = F.lit(0.0)
    for label, n in sorted(counts.items()):
        below = F.when(F.col(label_col) == label, F.lit(min(1.0, share / n))).otherwise(below)
    drawn = F.pmod(F.xxhash64(text_col), F.lit(1 << 20)) < below * (1 << 20)
    length = F.char_length(text_col)
    pieces = [F.substring(F.col(text_col), (F.floor(F.greatest(length - WINDOW, F.lit(0)) * (i / WINDOWS_PER_DOCUMENT))
                                            + 1).cast("int"), F.lit(WINDOW))
              for i in range(WINDOWS_PER_DOCUMENT)]
    rows = (lettered.filter(drawn)
            .select(F.explode(F.array_distinct(F.array(*pieces))).alias("piece"), F.col(label_col).alias("label"))
            .dropDuplicates(["piece", "label"])
            .orderBy(F.xxhash64("piece"), "piece", "label").limit(2 * windows).collect())
    return [r["piece"] for r in rows], [r["label"] for r in rows]


def train(learnable: DataFrame, text_col: str = "text", label_col: str = "lang") -> ByteConvNet | None:
    texts, labels = sample_for_training(learnable, text_col, label_col)
    return fit(texts, labels) if texts else None


def with_language(docs: DataFrame, net: ByteConvNet | None, text_col: str = "text",
                  label_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its probability."""

    @F.pandas_udf("label string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            labels, scores = [UNKNOWN] * len(batch), np.zeros(len(batch))
            group, size = [], 0
            for i, text in enumerate([*batch, None]):
                if text is not None:
                    group.append((i, *windows_of(text.encode("utf-8"))))
                    size += len(group[-1][1])
                if group and (size >= BATCH or i == len(batch)):
                    logs = net.log_probabilities(np.concatenate([w for _, w, _ in group]))
                    at = 0
                    for row, w, sizes in group:
                        mean = (logs[at:at + len(w)] * sizes[:, None]).sum(axis=0) / max(1, sizes.sum())
                        at += len(w)
                        mean -= mean.max()
                        p = np.exp(mean) / np.exp(mean).sum()
                        labels[row], scores[row] = net.languages[int(p.argmax())], float(p.max())
                    group, size = [], 0
            yield pd.DataFrame({"label": labels, "score": scores})

    if net is None:
        return docs.withColumn(label_out, F.lit(UNKNOWN)).withColumn(score_out, F.lit(0.0))
    lettered = F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col))
    answer = predict(lettered)
    return (docs.withColumn(label_out, answer["label"]).withColumn(score_out, answer["score"]))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the labelled rows that are not held out."""
    net = train(docs.filter(~held_out(id_col)), text_col, label_col)
    out = with_language(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), net)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def drop_unknown(docs: DataFrame, least_score: float, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "lang") -> DataFrame:
    """The documents whose language is recognised with at least ``least_score``, with all their columns."""
    net = train(docs.filter(~held_out(id_col)), text_col, label_col)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    kept = with_language(packed, net).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return kept.select("row.*")
