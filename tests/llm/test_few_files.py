"""Few rows in many shuffle partitions are written to few files, with the same rows."""

import os
import random

import public_tokenizers
import pytest

from sessionlens.llm import exact_dedup, mixing, near_join, packing
from sessionlens.llm.common import BYTES_PER_FILE, ROWS_PER_FILE, files_for, materialise
from sessionlens.session import checkpoint_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PARTITIONS = 61
STAGES = {
    "exact": (exact_dedup.drop_exact_copies, 1), "near": (near_join.drop_near_copies, 3),
    "mix": (mixing.apply_mix, 1), "pack": (lambda d: packing.pack(d, TOKENIZER), 1),
}


@pytest.fixture()
def many_partitions(spark):
    held = {"spark.sql.shuffle.partitions": str(PARTITIONS), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def files_below(folder: str) -> int:
    return sum(name.startswith("part-") for _, _, names in os.walk(folder.removeprefix("file://")) for name in names)


def documents(spark):
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(60)) for _ in range(100)]
    texts += [t + " tail" for t in texts[:20]] + texts[:20] + [None, ""]
    rows = [(i, t, "en", "ab"[i % 2], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2)


@pytest.mark.parametrize("name", STAGES)
def test_stage_writes_few_files(many_partitions, name):
    stage, wide = STAGES[name]
    docs, folder = documents(many_partitions), checkpoint_dir(many_partitions)
    before = files_below(folder)
    found = stage(docs)
    few = many_partitions.sparkContext.defaultParallelism
    assert found.rdd.getNumPartitions() <= few
    rows = sorted(found.collect(), key=repr)
    # ``wide``: intermediate tables that may take a file for each partition
    assert files_below(folder) - before <= wide * PARTITIONS + 20 * few
    many_partitions.conf.set("spark.sql.shuffle.partitions", "3")
    assert sorted(stage(docs).collect(), key=repr) == rows


def test_files_grow_with_rows_and_bytes(spark):
    least = spark.sparkContext.defaultParallelism
    assert files_for(spark.range(5)) == least
    assert files_for(spark.range(0)) == least
    assert files_for(spark.range(ROWS_PER_FILE * (least + 3) + 1)) == least + 4
    texts = spark.range(2 * least + 2).selectExpr(f"repeat('é', {BYTES_PER_FILE // 4}) AS `a.b`", "string(null) AS c")
    assert files_for(texts) == least + 1


def test_materialise_keeps_rows_in_fewer_files(spark):
    spread = spark.range(0, 100, 1, 37)
    assert materialise(spread).rdd.getNumPartitions() == 37
    held = materialise(spread, 4)
    assert held.rdd.getNumPartitions() == 4
    assert sorted(r[0] for r in held.collect()) == list(range(100))
