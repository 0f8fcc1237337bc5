"""Prefix trie of conversations against a plain walk over every prefix."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest

from sessionlens.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, k1 string, words string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(seed: int, convs: int = 70) -> list[tuple]:
    """Few texts, so that prefixes are shared; copies, nulls, ties, repeated rows, long and negative ids."""
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        conv = rng.choice([c, c, c, c + 1000, -c])
        for turn in range(rng.choice([0, 1, 2, 3, 5, 6, 9])):
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(["user", "user", "bot", None]),
                         rng.choice(["hello there", "hello there", "a b c", "", None, "x"])))
    rows += [r for r in rows[:40]]                                          # repeated rows
    rows += [(None, 1, "user", "no conversation"), (9223372036854775800, 0, "user", "hello there"),
             (9223372036854775807, 1, "bot", "a"), (-9223372036854775808, 1, "bot", "a")]
    rows += [(2000 + c, t, "user", "long" if t < 30 else f"own {c % 3} {t}") for c in range(8) for t in range(40)]
    rows += [(3000 + c, 0, "user", "the same single turn") for c in range(60)]
    rng.shuffle(rows)
    return [(*r, 7, "x", "y") for r in rows]


def brute(rows, share: bool):
    own = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = turns.get(base, [])[:h] + v[h:] if share else v
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, v in sorted(built.items()):
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
        ends[tuple(v)].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own_members in members.items():
        saves = (len(own_members) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += saves
            leaves[node[:d]] += not children[node]
    return sorted((m[0], len(n), members[n[:-1]][0] if n else None, len(m), children[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, ends.get(n, []))).encode()).hexdigest()) for n, m in members.items())


@pytest.mark.parametrize("together,gathered,share", [(4096, 100_000, True), (2, 12, True), (5, 3, False)])
def test_trie_matches_a_walk_over_every_prefix(spark, monkeypatch, together, gathered, share):
    monkeypatch.setattr(trie, "GATHERED", gathered)
    rows = table(together)
    got = trie.trie(spark.createDataFrame(rows, SCHEMA), share_openings=share, together=together)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute(rows, share)


def test_a_conversation_longer_than_a_task_gathers(spark, monkeypatch):
    monkeypatch.setattr(trie, "GATHERED", 50)
    monkeypatch.setattr(trie, "PIECE", 3)
    rows = [(c, t, "user", f"turn {t}" if t < 900 else f"{c % 2} {t}") for c in range(20, 25) for t in range(1200)]
    rows += [(c, 0, "user", "many end here") for c in range(100, 140)]
    rows = [(*r, None, None, None) for r in rows]
    got = trie.trie(spark.createDataFrame(rows, SCHEMA), share_openings=True, together=50)
    assert sorted(map(tuple, got.collect())) == brute(rows, True)


def test_empty_tables_and_turnless_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    got = trie.trie(empty, share_openings=True)
    assert got.columns == COLUMNS and got.collect() == []
    assert trie.trie(spark.createDataFrame([(None, 0, "user", "x", 1, "", "")], SCHEMA)).collect() == []
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)      # gives its only turn away
    rows = [(lone, 0, "user", "x", 1, "", "")]
    assert sorted(map(tuple, trie.trie(spark.createDataFrame(rows, SCHEMA), share_openings=True).collect())) == brute(rows, True)


def test_peeling_piece_by_piece_gives_the_same_nodes():
    rng = random.Random(8)
    rows = []
    for conv in range(40):
        path = [rng.randrange(2) for _ in range(rng.randint(1, 12))]
        keys = [hash(tuple(path[:d])) for d in range(len(path) + 1)]
        rows += [(1, 5, 5, d, keys[d], 0, keys[d - 1] if d > 1 else -9, 0, 3, int(d == len(path)), conv)
                 for d in range(1, len(path) + 1)]
    turns = pd.DataFrame(rows, columns=["top_depth", "top1", "top2", *trie.KEY, *trie.UP, "words", "ends", "least"])
    turns = turns.sort_values("depth", ascending=False, kind="stable", ignore_index=True)
    whole = pd.concat(trie.peel_subtrees(iter([turns])))
    trie_gathered, trie.GATHERED = trie.GATHERED, 5
    try:
        pieces = pd.concat(trie.peel_subtrees(turns.iloc[k:k + 7] for k in range(0, len(turns), 7)))
    finally:
        trie.GATHERED = trie_gathered
    order = ["depth", "k1"]
    assert np.array_equal(whole.sort_values(order).to_numpy(), pieces.sort_values(order).to_numpy())
