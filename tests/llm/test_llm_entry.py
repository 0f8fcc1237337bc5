"""The registered queries: contract columns, SQL oracles, and the pipeline stage by stage."""

import collections
import importlib
import itertools

import pytest
from test_llm_operators import TOKENIZER, WORDS, brute_targets, shingle_set
from tokenizers import Tokenizer

E = importlib.import_module("__spark_entry__")

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op2_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op3_near_copies": "doc_id class_id n_links n_shingles",
    "op4_nn_descent": "query_id rank vec_id score",
    "op5_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op6_lz_dedup": "doc_id n_words n_removed kept_sha256",
    "op7_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op8_mix_sources": "doc_id size source_size target taken",
    "op9_language_id": "doc_id held_out lang_pred score",
    "op10_rendezvous_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op11_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_align_tokens": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op13_quality_nbsvm": "doc_id held_out score predicted",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_contract_columns(spark, name):
    assert E.queries()[name](spark, SF).columns == COLUMNS[name].split()


def test_pipeline_stage_by_stage_against_brute_force(spark):
    import corpus_pipeline as cp
    first = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in cp.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "pack"]
    rows = [tuple(r) for r in first.collect()]
    after = {}
    for name, stage in cp.STAGES:
        out = stage(spark, spark.createDataFrame(rows, first.schema), SF)
        after[name] = [tuple(r) for r in out.collect()]
        if name != "pack":
            assert out.columns == first.columns
            rows = after[name]
    # Language ID keeps rows as they are; the rejected ones are few.
    assert set(after["language_id"]) <= set(map(tuple, first.collect()))
    assert len(after["language_id"]) >= 0.97 * first.count()
    # Of equal texts the largest id stays.
    largest = {}
    for row in after["language_id"]:
        largest[row[1]] = max(row, largest.get(row[1], row))
    assert sorted(after["exact_dedup"]) == sorted(largest.values())
    # Of linked documents the smallest id stays.
    kept = sorted(after["exact_dedup"])
    sets, root = [shingle_set(r[1]) for r in kept], list(range(len(kept)))
    holders = collections.defaultdict(list)
    for i, shingles in enumerate(sets):
        for x in shingles:
            holders[x].append(i)
    common = collections.Counter(pair for v in holders.values() for pair in itertools.combinations(v, 2))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, j), n in common.items():
        if 10 * n >= 8 * (len(sets[i]) + len(sets[j]) - n):
            low, high = sorted((find(i), find(j)))
            root[high] = low
    assert sorted(after["near_dedup"]) == [r for i, r in enumerate(kept) if find(i) == i]
    # Every source has its target in words, from whole texts and one shortened one.
    sizes, words = collections.Counter(), collections.Counter()
    for r in after["near_dedup"]:
        sizes[r[3]] += len(WORDS.findall(r[1]))
    for r in after["mix_sources"]:
        words[r[3]] += len(WORDS.findall(r[1]))
    targets = brute_targets(sizes)
    assert all(abs(words[s] - targets[s]) <= 1 for s in sizes)
    # Every token of the mix stands in one sequence.
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = sum(len(tokenizer.encode(r[1], add_special_tokens=False).ids) + 1 for r in after["mix_sources"])
    assert sum(r[3] for r in after["pack"]) == ids
    fill = collections.Counter()
    for r in after["pack"]:
        fill[r[5]] += r[3]
    assert max(fill.values()) <= 2048 and len(fill) <= 1.05 * ids / 2048 + 2


def test_pipeline_query_runs(spark):
    assert E.queries()["pipeline"](spark, SF).columns == COLUMNS["op2_best_fit_packing"].split()
