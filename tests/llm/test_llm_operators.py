"""Each operator against a brute-force twin, on rows with nulls, empty and long texts, ties and repeats."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sessionlens.llm import (exact_dedup, language, license_scan, lz_dedup, mixing, near_join, neighbours, packing,
                             sharding, suffix_dedup)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, value string, key string, rec string"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x{rng.randrange(9)}" for _ in range(words))


def corpus() -> list[tuple]:
    base, passage = prose(1, 180), prose(2, 70)
    edited = base.split()
    edited[90] = "changed"
    texts = [base, base, base, " ".join(edited), base + " tail", prose(3, 60) + "\n" + passage + "\n" + prose(4, 50),
             prose(5, 40) + "\t" + passage, passage, None, "", "   ", "a", "a", "one two three", "one two  three",
             "x" * 700, "ab" * 400, "é" * 150 + prose(6, 30), prose(7, 3000), "中文 字 " * 60, "12 34 !!",
             "Released under the MIT License.", "cc by cc by CC-BY", "GNU General Public License, mit license",
             prose(8, 120) + "\nLicensed under the\nApache License, Version 2.0.", None]
    rows = [(i, t, ["en", "fr", None][i % 3], ["b", "a", None, "é"][i % 4], len(t or ""), "v", "k", "r")
            for i, t in enumerate(texts)]
    rows.append((3, texts[3], "en", "b", 1, None, None, None))       # a repeated row
    rows.append((None, base, "en", "a", 1, None, None, None))        # no id
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r["doc_id"]].append(r)
    return out


def test_suffix_dedup_matches_every_window_counted(docs):
    rows = corpus()
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    count = collections.Counter(d[k:k + 200] for _, d in data for k in range(len(d) - 199))
    got = by_id(suffix_dedup.remove_repeats(docs))
    assert sum(map(len, got.values())) == len(rows)
    for doc, d in data:
        gone = np.zeros(len(d) + 1, int)
        for k in range(len(d) - 199):
            if count[d[k:k + 200]] > 1:
                gone[k] += 1
                gone[k + 200] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = bytes(b for b, g in zip(d, gone) if not g)
        row = got[doc][0]
        assert (row["n_bytes"], row["n_removed"]) == (len(d), int(gone.sum()))
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        assert row["n_spans"] == len(row["removed"])


def test_suffix_dedup_window_by_window_path_agrees(docs, monkeypatch):
    want = sorted(map(tuple, suffix_dedup.remove_repeats(docs).select("doc_id", "n_removed").fillna(-1).collect()))
    monkeypatch.setattr(suffix_dedup.A, "MOST_CONTENTS", 1)
    got = sorted(map(tuple, suffix_dedup.remove_repeats(docs).select("doc_id", "n_removed").fillna(-1).collect()))
    assert got == want


def test_column_rounds_find_common_windows():
    rng = random.Random(3)
    for _ in range(60):
        n, window = rng.randint(1, 12), rng.randint(1, 6)
        docs = [bytes(rng.choice(b"ab") for _ in range(rng.randint(window, 14))) for _ in range(n)]
        anchors = np.array([rng.randrange(len(d)) for d in docs])
        got = suffix_dedup.repeated_windows(docs, anchors, window)
        seen = collections.Counter((k - a, d[k:k + window]) for d, a in zip(docs, anchors)
                                   for k in range(len(d) - window + 1))
        for d, a, marked in zip(docs, anchors, got):
            assert marked.tolist() == [seen[k - a, d[k:k + window]] > 1 for k in range(len(d) - window + 1)]


def test_lz_dedup_matches_smallest_holder(docs):
    rows = corpus()
    parsed = [(r[0], (r[1] or "").encode().split()) for r in rows]
    rank = lambda doc: lz_dedup.LAST if doc is None else doc
    least = {}
    for doc, w in parsed:
        for k in range(len(w) - 49):
            window = tuple(w[k:k + 50])
            least[window] = min(least.get(window, rank(doc)), rank(doc))
    got = by_id(lz_dedup.remove_held_words(docs))
    for doc, w in parsed:
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if least[tuple(w[k:k + 50])] < rank(doc):
                gone[k:k + 50] = [True] * 50
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        row = got[doc][0]
        assert (row["n_words"], row["n_removed"]) == (len(w), sum(gone))
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("most", [lz_dedup.A.MOST_CONTENTS, 1])
def test_lz_dedup_parses_every_place_of_a_content(spark, monkeypatch, most):
    passage, around = prose(21, 90), prose(22, 80)
    twice = f"{around} {passage} {around} {passage} {around}"
    texts = [(1, f"{prose(23, 70)} {passage} {prose(24, 70)}"), (7, twice), (8, passage), (None, f"{prose(25, 60)} {twice}"),
             (None, f"{prose(26, 60)} {prose(27, 90)} {prose(28, 60)}"), (None, f"{prose(29, 60)} {prose(27, 90)}"),
             (None, f"{prose(30, 80)} {prose(31, 90)} {prose(30, 80)}"),
             (None, f"{prose(30, 80)} {prose(31, 90)} {prose(30, 80)} tail"), (None, None),
             (5, f"{prose(32, 60)} {prose(31, 90)} {prose(33, 60)}")]
    texts += [texts[4], texts[1]]                                          # rows equal in id and text
    rank = lambda doc: lz_dedup.LAST if doc is None else doc
    least: dict = {}
    for doc, text in texts:
        w = (text or "").split()
        for k in range(len(w) - 49):
            window = tuple(w[k:k + 50])
            least[window] = min(least.get(window, rank(doc)), rank(doc))
    want = []
    for doc, text in texts:
        w = (text or "").split()
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if least[tuple(w[k:k + 50])] < rank(doc):
                gone[k:k + 50] = [True] * 50
        want.append((rank(doc), len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    monkeypatch.setattr(lz_dedup.A, "MOST_CONTENTS", most)
    got = lz_dedup.remove_held_words(spark.createDataFrame(texts, "doc_id long, text string"))
    got = got.select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted((rank(d), *rest) for d, *rest in got) == sorted(want)


def test_lz_dedup_window_by_window_path_agrees(docs, monkeypatch):
    want = sorted(map(tuple, lz_dedup.remove_held_words(docs).select("doc_id", "n_removed").fillna(-1).collect()))
    monkeypatch.setattr(lz_dedup.A, "MOST_CONTENTS", 1)
    got = sorted(map(tuple, lz_dedup.remove_held_words(docs).select("doc_id", "n_removed").fillna(-1).collect()))
    assert got == want


def test_packing_round_trip(docs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = packing.pack(docs, TOKENIZER, capacity=64).collect()
    want = []
    for r in corpus():
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[start:start + 64], dtype="<u4")
            want.append((r[0] if r[0] is not None else -1, piece, start, len(part), zlib.crc32(part.tobytes())))
    got = [(r["doc_id"] if r["doc_id"] is not None else -1, r["piece"], r["start"], r["length"], r["ids_crc32"])
           for r in rows]
    assert sorted(got) == sorted(want)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64


def greedy_by_item(lengths: list[int], capacity: int) -> int:
    """Sequences that large-item matching and best fit need, item by item."""
    large = sorted((n for n in lengths if 3 * n > capacity), reverse=True)
    gaps = []
    while large:
        a = large.pop(0)
        fits = [n for n in large if n <= capacity - a]
        if fits:
            large.remove(max(fits))
            gaps.append(capacity - a - max(fits))
        else:
            gaps.append(capacity - a)
    for n in sorted((n for n in lengths if 3 * n <= capacity), reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps[gaps.index(min(fits))] -= n
        else:
            gaps.append(capacity - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(25))
def test_packing_plan_equals_item_by_item(seed):
    rng = random.Random(seed)
    capacity = rng.choice([12, 64, 2048])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 150))]
    plan = packing.plan_packing(collections.Counter(lengths), capacity)
    used = {p.sequence + r // p.each for p in plan for r in range(p.count)}
    assert sum(p.count for p in plan) == len(lengths)
    # Equal lengths fill one gap as often as they can here, and one after the other there.
    assert abs(len(used) - greedy_by_item(lengths, capacity)) <= 1


def test_word_by_word_tokens_equal_the_whole_text():
    tokenizer, words = Tokenizer.from_file(TOKENIZER), packing.WordTokens(TOKENIZER)
    rng = random.Random(5)
    odd = "aA É́  \x0b\x0c\x1c\x85\t\r\nΣς'sdll<|endoftext|>12½ßİ中　​ཱ"
    plain = "aAbsSdDtTlLvVmMrReE'\"!.,;<>|-_09 7 \n"
    latin = "aéÉßÿŸÖöñÑçx'tS. ×÷ªº7e\u0301 "
    for alphabet in (odd, plain, latin):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
        texts += ["x" * 900 + " <|endoftext|>y", "don't we'LL they'Ve I'm x'x ''s"]
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [ids.tolist() for at in range(0, len(texts), 100) for ids in words.batch(texts[at:at + 100])] == want


def shingle_set(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])


def test_near_groups_match_all_pairs(docs):
    rows = [r for r in corpus() if r[0] is not None]
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = collections.Counter()
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 10 * len(a & b) >= 8 * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    smallest = {}
    for i, r in enumerate(rows):
        smallest[root(i)] = min(smallest.get(root(i), r[0]), r[0])
    want = sorted((r[0], smallest[root(i)], links[i]) for i, r in enumerate(rows))
    got = near_join.near_groups(docs.filter("doc_id IS NOT NULL")).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, got)) == want
    kept = near_join.drop_near_copies(docs.filter("doc_id IS NOT NULL"))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _ in want})


def test_near_groups_in_blocks(spark, monkeypatch):
    base = prose(11, 150).split()
    rows = []
    for i in range(40):
        words = list(base)
        words[i * 3] = f"edit{i}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_join, "BLOCK", 7)
    got = near_join.near_groups(df).collect()
    assert {r["class_id"] for r in got} == {0}
    assert {r["n_links"] for r in got} == {39}


def test_matched_depth_meets_the_recall():
    depth = near_join.matched_depth()
    assert 1 - (1 - 0.8 ** depth) ** near_join.TREES >= near_join.RECALL
    assert 1 - (1 - 0.8 ** (depth + 1)) ** near_join.TREES < near_join.RECALL


def vectors(n: int, dim: int = 12):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=dim).tolist()) for i in range(n)]
    rows += [(n + i, rows[min(7, n - 1)][1]) for i in range(60)]                      # copies
    rows += [(5000, None), (5001, []), (5002, [0.0] * dim), (5003, [1.0, None] + [0.0] * (dim - 2)),
             (5004, [float("nan")] * dim), (5005, [float("inf")] + [0.0] * (dim - 1)), (None, [1.0] * dim),
             (5007, [2.0, 1.0]), (5007, [2.0, 1.0])]
    return rows


@pytest.mark.parametrize("n", [0, 1, 9, 900])
def test_neighbours_against_brute_force(spark, n):
    rows = vectors(n) if n else []
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = collections.defaultdict(dict)
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    good = {i: np.array(v + [0.0] * (12 - len(v))) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    hits = total = 0
    for q in (i for i in good if i % 20 == 0):
        best = sorted(((-float(good[q] @ v), i) for i, v in good.items() if i != q))[:20]
        answer = [got[q][k][0] for k in sorted(got[q])]
        assert sorted(got[q]) == list(range(1, len(best) + 1))
        assert all(abs(s - float(good[q] @ good[i])) < 1e-9 for i, s in got[q].values())
        ordered = [(-got[q][k][1], got[q][k][0]) for k in sorted(got[q])]
        assert ordered == sorted(ordered)
        hits += len(set(answer) & {i for _, i in best})
        total += len(best)
    assert hits >= 0.9 * total


def test_divided_groups_are_compared_whole(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(700)]
    nodes = spark.createDataFrame(rows, "node long, v array<double>")
    rough = spark.createDataFrame([(i, (i + k) % 700, float(k), k) for i in range(700) for k in range(1, 4)],
                                  "a long, b long, s double, r int")
    monkeypatch.setattr(neighbours, "OFFERS", 700)

    def found():
        graph, home = neighbours.start_graph(nodes, len(rows), 12)
        return [{(r["a"], r["b"]) for r in df.collect()}
                for df in (graph, neighbours.descend(nodes, rough, home, 12))]

    want = found()
    monkeypatch.setattr(neighbours, "MOST_MEMBERS", 100)
    got = found()
    v = np.array([x for _, x in rows], dtype=np.float32)
    score = v @ v.T
    np.fill_diagonal(score, -np.inf)
    best = {(a, int(b)) for a in range(700) for b in np.argsort(-score[a])[:neighbours.DEGREE]}
    assert len(best & got[0]) >= 0.999 * len(best)
    assert len(want[1] ^ got[1]) <= 0.001 * len(want[1])


def test_neighbours_of_huge_and_tiny_vectors(spark):
    """Components beyond single precision on both sides; scores stay finite in double precision."""
    rng = np.random.default_rng(21)
    rows = [(i, (rng.normal(size=6) * 10.0 ** rng.choice([-120, -39, 0, 39, 120])).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    v = np.array([x for _, x in rows])
    for q in range(0, 300, 20):
        score = v @ v[q]
        want = [i for i in np.lexsort((np.arange(300), -score)) if i != q][:20]
        assert len(got[q]) == 20 and len({i for _, i, _ in got[q]} & set(want)) >= 19
        assert all(np.isclose(s, score[i], rtol=1e-9) for _, i, s in got[q])


def test_large_groups_are_split_by_pivots_of_their_own(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(3000)]
    nodes = spark.createDataFrame(rows, "node long, v array<double>")
    monkeypatch.setattr(neighbours, "MOST_MEMBERS", 200)
    monkeypatch.setattr(neighbours, "SPLIT_ABOVE", 200)
    monkeypatch.setattr(neighbours, "SECOND_SIZE", 60)
    monkeypatch.setattr(neighbours, "MOST_PIVOTS", 4)
    members = spark.range(3000).select(F.col("id").alias("node"), F.lit(0).alias("place"), (F.col("id") % 4).alias("grp"))
    members = members.filter("grp < 3 OR node < 400")
    out = neighbours.split_again(members, nodes, 8).collect()
    assert sorted(r["node"] for r in out) == sorted(r["node"] for r in members.collect())
    sizes = collections.Counter(r["grp"] for r in out)
    assert max(sizes.values()) < 350 and len(sizes) > 15
    assert {r["grp"] for r in out if r["node"] % 4 == 3} == {3}              # small enough as it is
    for name, value in (("SPLIT_ABOVE", 300), ("SECOND_SIZE", 150), ("MOST_PIVOTS", 6)):
        monkeypatch.setattr(neighbours, name, value)
    df = nodes.select(F.col("node").alias("vec_id"), F.col("v").alias("embedding"))
    got = collections.defaultdict(set)
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    v = np.array([x for _, x in rows])
    hits = sum(len(got[q] & {int(i) for i in np.argsort(-np.where(np.arange(3000) == q, -np.inf, v @ v[q]))[:20]})
               for q in range(0, 3000, 20))
    assert hits >= 0.9 * 150 * 20


def test_license_scan_against_brute_force(docs):
    got = by_id(license_scan.scan(docs))
    for r in corpus():
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places, labels = [], set()
        for phrase, label in license_scan.PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k:k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        own = set()
        for start in range(0, len(words), license_scan.STEP):
            block = set(words[start:start + license_scan.BLOCK])
            line = f" {' '.join(words[start:start + license_scan.BLOCK])} "
            for label, telling, text in license_scan.TEMPLATES:
                t = set(text.split())
                if len(t & block) >= license_scan.CONTAINMENT * len(t) - 1e-9 and f" {telling} " in line:
                    own.add(label)
        row = got[r[0]][0]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert (row["first_word"], row["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert row["base_labels"] == ",".join(sorted(labels))
        assert row["labels"] == ",".join(sorted(labels | own))
        assert 0 <= row["score"] <= 1


#: Notices as people write them, and the labels that they mean.
NOTICES = {
    "Licensed under CC BY 4.0.": "cc-by,cc-by-4.0",
    "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0",
    "Licensed under CC BY-SA 4.0": "cc-by,cc-by-sa-4.0",
    "Text licensed under cc by-nc-sa 4.0!": "cc-by,cc-by-nc-sa-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
    "This work is licensed under the GNU General Public License, version 2.": "gpl,gpl-2.0",
    "Released under the MIT License.": "mit,mit-notice",
    "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "cc-by-4.0",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "cc-by-sa-4.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction": "mit-text",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
    "Public License as published by the Free Software Foundation": "agpl-notice",
    "All rights reserved.": "all-rights-reserved",
    "We released the film under the new license of the year.": "",
    "All of the rights of the reserved seats": "",
    "A license under which the public may use general works is free; version 3 of the GNU tools is not licensed so.": "",
    "mit 4 0 cc licensed by under": "",
}


@pytest.mark.parametrize("around", ["", "alpha beta gamma delta " * 40])
def test_each_notice_has_its_own_label_and_no_siblings(spark, around):
    rows = [(i, f"{around}{notice} {around}") for i, notice in enumerate(NOTICES)]
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(rows))] == list(NOTICES.values())


def test_exact_groups(docs, monkeypatch):
    groups = collections.defaultdict(list)
    for r in corpus():
        groups[r[1] or ""].append(r[0])
    want = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda x: -1 if x is None else x, reverse=True):
            want.append((i if i is not None else -1, best, len(ids), first, digest))
            first = False
    got = [tuple(-1 if v is None else v for v in r) for r in exact_dedup.exact_groups(docs).collect()]
    assert sorted(got) == sorted(want)
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted(groups)


def test_heavy_hitters_are_decided_before_the_shuffle(spark):
    df = spark.createDataFrame([(i, "same" if i % 3 else f"t{i}") for i in range(900)], "doc_id long, text string")
    digests = df.select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.lit(1).alias("mark"))
    winners = exact_dedup.verified_winners(digests, "doc_id", "text_sha256", "mark").collect()
    assert [(r["winner_size"], r["winner_id"]) for r in winners] == [(600, 899)]
    rows = exact_dedup.exact_groups(df).filter("group_size = 600").collect()
    assert len(rows) == 600 and [r["doc_id"] for r in rows if r["kept"]] == [899]


@pytest.mark.parametrize("ids", ["null", "same", "both"])
def test_frequent_text_without_distinct_ids_leaves_one_row(spark, ids):
    """A third of all rows have one text and no id, or one id: all but one go before the shuffle."""
    own = {"null": lambda i: None, "same": lambda i: 7, "both": lambda i: None if i % 2 else 7}[ids]
    rows = [(own(i) if i % 3 == 0 else i + 10, "hot" if i % 3 == 0 else f"t{i}", "b" if i == 30 else "a", i % 4) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, mark string, row_no int").repartition(6)
    got = exact_dedup.exact_groups(df).filter("group_size = 200").collect()
    assert len(got) == 200 and sum(r["kept"] for r in got) == 1
    kept = next(r for r in got if r["kept"])
    assert kept["doc_id"] == kept["keep_id"] == (None if ids == "null" else 7)
    marked = df.select("doc_id", F.sha2("text", 256).alias("digest"), F.monotonically_increasing_id().alias("mark"))
    frequent, rest = exact_dedup._split(marked, marked.cache(), "doc_id", "digest", "mark")
    assert frequent.filter("wins").count() == 1 and rest.count() == 400
    stay = exact_dedup.drop_exact_copies(df)
    assert stay.columns == df.columns and stay.filter("text = 'hot'").count() == 1 and stay.count() == 401


def test_sketches_are_combined_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "ARITY", 2)
    rows = spark.range(5000).select(F.when(F.col("id") % 4 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit("warm"))
                                    .otherwise(F.col("id").cast("string")).alias("v")).repartition(13)
    named = exact_dedup.misra_gries(rows, "v", candidates=2, tracked=64)
    assert {r["value"] for r in named.collect()} >= {"hot"}
    # 13 tasks: 7, 4, 2, one
    assert named._jdf.queryExecution().optimizedPlan().toString().count("approx_top_k_combine(") == 4
    assert exact_dedup.misra_gries(rows.limit(0), "v").collect() == []


def brute_targets(sizes: dict) -> dict:
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left / open_weight * weight[s] for s in order}
        above = {s for s in order if s not in capped and target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


def test_mixing_targets_and_budget(docs):
    got = mixing.mix(docs).collect()
    sizes = collections.Counter()
    for r in corpus():
        sizes[r[3]] += len(WORDS.findall(r[1] or ""))
    targets = brute_targets(sizes)
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, words in taken.items():
        assert abs(words - targets[source]) <= 1
    again = mixing.mix(docs.repartition(5), rows_per_bucket=3).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_corpus_has_the_budgeted_words(docs):
    rows = docs.filter("doc_id IS NOT NULL")
    taken = {r["source"]: r["t"] for r in mixing.mix(rows).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    mixed = mixing.apply_mix(rows)
    assert mixed.columns == docs.columns
    words, whole = collections.Counter(), collections.Counter()
    texts = {r[1] for r in corpus()}
    for r in mixed.collect():
        words[r["source"]] += len(WORDS.findall(r["text"] or ""))
        whole[r["text"] in texts] += 1
        assert any((t or "").startswith(r["text"] or "") for t in texts)
    assert {s: words[s] for s in taken} == taken
    assert whole[False] <= len(taken)


def test_language_id_learns_from_marked_rows_only(spark):
    alphabets = {"aa": "abcdefgh", "bb": "nopqrstu", "cc": "éèêàùçô"}
    rows, rng = [], random.Random(2)
    for i in range(240):
        lang = sorted(alphabets)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(alphabets[lang]) for _ in range(5)) for _ in range(40)), lang))
    rows += [(900, None, "aa"), (901, "", "aa"), (902, "12 !!", "aa"), (903, rows[0][1], None), (None, rows[1][1], "bb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = by_id(language.identify(df))
    for i, text, lang in rows[:240]:
        row = got[i][0]
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert row["lang_pred"] == lang and 0 <= row["score"] <= 1
    assert [got[i][0]["lang_pred"] for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "aa", "bb"]
    kept = language.drop_unknown(df, 0.4)
    assert kept.columns == df.columns and kept.count() == len(rows) - 3
    unlabelled = language.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_sharding_moves_rows_only_into_the_added_shard(docs):
    four = by_id(sharding.shard_documents(docs, [1.0] * 4, rows_per_bucket=2))
    five = by_id(sharding.shard_documents(docs, [1.0] * 5))
    slots = collections.defaultdict(list)
    for rows in four.values():
        for r in rows:
            slots[r["shard"]].append(r["slot"])
    for used in slots.values():
        assert sorted(used) == list(range(len(used)))
    for r in corpus():
        row = four[r[0]][0]
        text = (r[1] or "").encode()
        assert (row["size"], row["text_crc32"], row["law"]) == (len(text) + 1, zlib.crc32(text), "key")
        assert five[r[0]][0]["shard"] == row["grown_shard"]
        assert row["grown_shard"] in (row["shard"], 4)


def test_sharding_follows_the_weights(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    counts = {r["shard"]: r["count"] for r in sharding.shard_documents(df, [1.0, 2.0, 3.0]).groupBy("shard").count().collect()}
    assert [round(counts[i] / 1000) for i in range(3)] == [1, 2, 3]


EMPTY = {
    "suffix": suffix_dedup.remove_repeats, "lz": lz_dedup.remove_held_words,
    "packing": lambda d: packing.pack(d, TOKENIZER), "near": near_join.near_groups, "license": license_scan.scan,
    "exact": exact_dedup.exact_groups, "mixing": mixing.mix, "language": language.identify,
    "sharding": lambda d: sharding.shard_documents(d, [1.0, 1.0]),
    "drop_exact": exact_dedup.drop_exact_copies, "drop_near": near_join.drop_near_copies,
    "apply_mix": mixing.apply_mix, "drop_unknown": lambda d: language.drop_unknown(d, 0.4),
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty_table(empty, name):
    assert EMPTY[name](empty).collect() == []


def naive_factors(blocks: list[tuple[int, list]], own: int, size: int) -> list[tuple[int, int]]:
    """Longest match of the rest with one block of a smaller document, from left to right, then boundary windows."""
    document, words = blocks[own]
    smaller = [w for d, w in blocks if d < document]

    def longest(at):
        best = 0
        for w in smaller:
            for k in range(len(w)):
                n = 0
                while at + n < len(words) and k + n < len(w) and words[at + n] == w[k + n]:
                    n += 1
                best = max(best, n)
        return best

    out, at = [], 0
    while at < len(words):
        n = longest(at)
        if n < size:
            at += 1
            continue
        out.append((at, at + n))
        out += [(k, k + size) for k in range(at + n - size + 1, min(at + n, len(words) - size + 1)) if longest(k) >= size]
        at += n
    return out


def test_lz_factors_equal_a_naive_parser(monkeypatch):
    monkeypatch.setattr(lz_dedup, "WINDOW", 6)
    rng = random.Random(12)
    for _ in range(120):
        # distinct words, so that blocks are aligned as anchors align them; edits part them
        base = list(range(11))
        blocks = []
        for document in rng.sample(range(50), rng.randint(2, 9)):
            words = [w if rng.random() < 0.9 else 100 + rng.randrange(3) for w in base]
            low = rng.randrange(3)
            blocks.append((document, words[low:len(words) - rng.randrange(3)]))
        windows = [np.array([hash(tuple(w[k:k + 6])) for k in range(len(w) - 5)], dtype="int64") for _, w in blocks]
        index = lz_dedup.ReferenceIndex(np.zeros(len(blocks), "int64"), windows, np.array([d for d, _ in blocks]))
        length, reference = index.longest_matches()
        for own, (s, e) in enumerate(zip([0, *index.ends[:-1]], index.ends, strict=True)):
            got = lz_dedup.factors(length[s:e], reference[s:e], index.least[s:e])
            assert [(a, b) for a, b, _ in got] == naive_factors(blocks, own, 6)
            for a, b, document in got:      # the reference is a smaller document that holds the factor
                run = blocks[own][1][a:b]
                assert document == min(d for d, w in blocks if any(w[k:k + b - a] == run for k in range(len(w))))
                assert document < blocks[own][0]


def test_near_copies_without_ids(spark):
    base = prose(41, 90)
    near = base.split()
    near[20] = "other"
    rows = [(None, base), (None, base), (3, base), (9, " ".join(near)), (None, prose(42, 60)), (None, None), (4, None)]
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in near_join.near_groups(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(None, 3, 3), (None, 3, 3), (3, 3, 3), (9, 3, 3), (None, None, 0), (None, None, 0), (4, 4, 0)], key=str)


def test_trie_node_connects_whatever_is_alike():
    """Clusters of one node against all pairs of signatures, as connected components."""
    rng = np.random.default_rng(5)
    shortest = near_join.matched_depth()
    for tree in (0, 7):
        centres = rng.integers(0, 256, (6, near_join.TREES * near_join.DEPTH), dtype="u1")
        signs = centres[rng.integers(0, 6, 60)]
        noise = rng.random(signs.shape) < rng.random((60, 1)) * 0.6
        signs = np.where(noise, rng.integers(0, 256, signs.shape, dtype="u1"), signs)
        label = near_join.connected_in_node(signs, tree, shortest)
        alike = (signs[:, None, :] == signs[None, :, :]).mean(axis=2) >= near_join.PLAUSIBLE
        want = np.arange(60)
        while True:
            new = np.array([want[alike[i]].min() for i in range(60)])
            if (new == want).all():
                break
            want = new
        assert len(set(zip(label.tolist(), want.tolist(), strict=True))) == len(set(label.tolist())) == len(set(want.tolist()))


@pytest.mark.parametrize("block", [2, 5])
def test_large_trie_nodes_in_blocks_lose_no_link(spark, monkeypatch, block):
    base = prose(43, 200).split()
    rows = []
    for i in range(24):
        words = list(base)
        for k in range(i % 8):
            words[(i * 7 + k * 23) % 200] = f"new{i}x{k}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_join, "NODE_BLOCK", block)
    sets = [shingle_set(t) for _, t in rows]
    want = {i: sum(10 * len(a & b) >= 8 * len(a | b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)}
    assert {r["doc_id"]: r["n_links"] for r in near_join.near_groups(df).collect()} == want


def test_near_join_of_texts_of_megabytes(spark):
    words = prose(44, 400_000, vocabulary=5000)
    rows = [(1, words), (2, words + " tail"), (3, prose(45, 300))]
    assert len(words) > 2 << 20
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_join.near_groups(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
