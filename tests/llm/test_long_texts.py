"""Texts beyond the stretches that operators walk at once, and the language network byte by byte."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sessionlens.llm import anchors, hashing, language, lz_dedup, packing, suffix_dedup

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def long_text(seed: int, size: int) -> str:
    rng = random.Random(seed)
    vocabulary = [f"{rng.randrange(10**6)}é" if k % 9 == 0 else f"w{rng.randrange(10**5)}" for k in range(3000)]
    words, length = [], 0
    while length < size:
        words.append(rng.choice(vocabulary))
        length += len(words[-1]) + 1
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    base = long_text(1, 1_300_000)
    cut = len(base) // 3
    assert len(base) > max(anchors.STRETCH, hashing.CHUNK)
    return [(3, base), (5, long_text(2, 4000) + " " + base[cut:cut + 9000] + " tail"), (7, "y" * 3000)]


def test_suffix_dedup(spark, texts):
    data = {i: t.encode() for i, t in texts}
    seen, again = set(), set()
    for d in data.values():
        for k in range(len(d) - 199):
            h = hash(d[k:k + 200])
            (again if h in seen else seen).add(h)
    for r in suffix_dedup.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        d = data[r["doc_id"]]
        change = np.zeros(len(d) + 1, int)
        for k in range(len(d) - 199):
            if hash(d[k:k + 200]) in again:
                change[k] += 1
                change[k + 200] -= 1
        gone = np.cumsum(change)[:-1] > 0
        kept = np.frombuffer(d, "u1")[~gone].tobytes()
        assert (r["n_bytes"], r["n_removed"], r["kept_sha256"]) == (len(d), gone.sum(), hashlib.sha256(kept).hexdigest())


def test_lz_dedup(spark, texts):
    words = {i: t.encode().split() for i, t in texts}
    least: dict = {}
    for i, w in words.items():
        for k in range(len(w) - 49):
            h = hash(tuple(w[k:k + 50]))
            least[h] = min(least.get(h, i), i)
    for r in lz_dedup.remove_held_words(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        w = words[r["doc_id"]]
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if least[hash(tuple(w[k:k + 50]))] < r["doc_id"]:
                gone[k:k + 50] = [True] * 50
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(w), sum(gone), hashlib.sha256(kept).hexdigest())


def test_packing(spark, texts):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), TOKENIZER).collect()
    for i, text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        own = sorted((r["piece"], r["start"], r["length"]) for r in rows if r["doc_id"] == i)
        assert sum(n for _, _, n in own) == len(ids) + 1
        assert [s for _, s, _ in own] == [2048 * k for k in range(len(own))]


def _network(rng) -> language.ByteConvNet:
    total = len(language.WIDTHS) * language.FILTERS
    draw = lambda *shape: rng.normal(0, 0.6, shape).astype("f4")
    return language.ByteConvNet(["aa", "bb", "cc"], draw(257, language.EMBEDDING),
                                [draw(w * language.EMBEDDING, language.FILTERS) for w in language.WIDTHS],
                                draw(total), draw(total, 3), draw(3))


def _plain(net, text: str) -> np.ndarray:
    """Probabilities by loops over windows, filters and places."""
    data = text.encode()
    total, size = np.zeros(3), 0
    for at in range(0, max(1, len(data)), language.WINDOW):
        part = list(data[at:at + language.WINDOW])
        own = len(part)
        part += [256] * (language.WINDOW - own)
        hidden = []
        for width, weights in zip(language.WIDTHS, net.filters, strict=True):
            for f in range(language.FILTERS):
                best = -np.inf
                for k in range(language.WINDOW - width + 1):
                    value = 0.0
                    for j in range(width):
                        value += float(net.table[part[k + j]].astype("f8")
                                       @ weights[j * language.EMBEDDING:(j + 1) * language.EMBEDDING, f].astype("f8"))
                    best = max(best, value)
                hidden.append(best)
        hidden = np.maximum(np.array(hidden) + net.shift, 0)
        logits = hidden @ net.out.astype("f8") + net.out_shift
        total += own * (logits - logits.max() - np.log(np.exp(logits - logits.max()).sum()))
        size += own
    mean = total / size
    p = np.exp(mean - mean.max())
    return p / p.sum()


def test_language_network_byte_by_byte(spark):
    rng = np.random.default_rng(11)
    net = _network(rng)
    texts = ["a", "short é", "x" * 128, "x" * 129 + "yz", long_text(3, 700), "漢字 kana " * 30]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[1]])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.with_language(rows, net).collect()}
    for i, text in enumerate([*texts, texts[1]]):
        p = _plain(net, text)
        assert got[i]["lang_pred"] == net.languages[int(p.argmax())]
        assert got[i]["score"] == pytest.approx(p.max(), abs=2e-4)


def test_language_of_a_long_text(spark, monkeypatch):
    """More windows than are computed at once."""
    net = _network(np.random.default_rng(12))
    text = long_text(4, language.BATCH * language.WINDOW + 5000)
    windows, sizes = language.windows_of(text.encode())
    assert len(windows) > language.BATCH
    logs = np.concatenate([net.log_probabilities(windows[k:k + 100]) for k in range(0, len(windows), 100)])
    mean = (logs * sizes[:, None]).sum(axis=0) / sizes.sum()
    p = np.exp(mean - mean.max())
    row = language.with_language(spark.createDataFrame([(1, text)], "doc_id long, text string"), net).first()
    assert row["score"] == pytest.approx((p / p.sum()).max(), abs=1e-4)


def test_a_hot_group_of_copies_gives_its_pieces_once(spark):
    rows = [(f"copy of one text {'z' * 90}", "aa")] * 400 + [(long_text(k, 300), "aa") for k in range(30)]
    texts, labels = language.sample_for_training(spark.createDataFrame(rows, "text string, lang string"), "text", "lang", 2000)
    assert len(texts) == len(set(texts)) and set(labels) == {"aa"} and len(texts) > 30
