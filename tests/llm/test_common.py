"""Helpers and odd input that several operators share."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskwright.llm import classify, decontaminate, minhash, quality, sharding, substring
from maskwright.llm._common import Buckets, hash_buckets, is_local, slices, spark_hash

from .conftest import prose


def test_buckets_are_dealt_as_spark_deals_them(spark):
    numbers = [0, 1, 2, 7, -1, 12345, 2**31 - 1, -(2**31)]
    got = [r.h for r in spark.createDataFrame([(n,) for n in numbers], "n int").select(F.hash("n").alias("h")).collect()]
    assert got == spark_hash(np.array(numbers, np.int64)).tolist()
    for n, parts in ((7, 7), (130, 51), (3, 8), (211, 211), (1, 1)):
        labels = Buckets(n, parts).labels
        assert len(set(labels.tolist())) == n
        per = np.bincount(spark_hash(labels.astype(np.int64)) % parts, minlength=parts)
        assert per.max() - per.min() <= 1
    assert hash_buckets(spark.range(10).select("id")).n >= 4


def test_folders():
    assert is_local("local") and is_local("local[8]") and not is_local("local-cluster[3,2,1024]") and not is_local("spark://x:7077")


def test_slices_split_no_row():
    import pyarrow as pa

    texts = ["é" * 10, None, "x" * 5000, "", "y" * 3]
    batch = pa.RecordBatch.from_arrays([pa.array(texts * 3, pa.string())], names=["t"])
    rows = [r for part, data, offsets in slices(batch, "t", 64, 4) for r in (bytes(data[a:b]).decode() for a, b in zip(offsets[:-1], offsets[1:]))]
    assert rows == [t or "" for t in texts * 3] and max(len(p) for p, *_ in slices(batch, "t", 64, 4)) <= 4


def test_clashing_names(spark):
    rows = spark.createDataFrame([(1, "a b c", "en", 9)], "doc_id long, text string, lang string, n_words long")
    out = quality.quality_rules(rows, carry=("n_words", "text"))
    assert out.columns.count("n_words") == 1 and out.first().n_words == 3
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    with pytest.raises(ValueError):
        decontaminate.leaks(rows.select(F.col("doc_id").alias("item_id"), "text"), bench, doc_id="item_id")


def test_very_long_texts(spark):
    """A text of 2 MB beside short ones, in each operator that reads words."""
    rng = random.Random(8)
    long = prose(rng, 330_000, 90_000)
    passage = " ".join(long.split()[1000:1040])
    rows = spark.createDataFrame([(1, long, "en"), (2, long, "en"), (3, prose(rng, 30) + " " + passage, "en"), (4, None, None)], "doc_id long, text string, lang string")
    n = len(long.split())
    base = {r.doc_id: r for r in quality.quality_rules(rows).collect()}
    assert base[1].n_words == n and base[4].base_failed
    near = {r.doc_id: r for r in minhash.near_duplicates(rows).collect()}
    assert (near[2].component_id, near[2].kept, near[3].component_id) == (1, False, 3)
    gone = {r.doc_id: r.n_removed for r in substring.remove_repeats(rows, texts=False).collect()}
    assert gone[1] == 0 and gone[2] == n and gone[3] >= 40
    found = decontaminate.leaks(rows, spark.createDataFrame([(5, passage)], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in found) == [1, 2, 3] and {r.edits for r in found} == {0}


def test_one_id_with_several_texts(spark):
    rng = random.Random(9)
    a, b = prose(rng, 60, 5000), prose(rng, 60, 5000)
    rows = spark.createDataFrame([(1, a), (2, a), (2, b), (2, b)], "doc_id long, text string")
    got = sorted((r.doc_id, r.kept, r.text_hash) for r in minhash.near_duplicates(rows).collect())
    hashes = {r.text: r.h for r in rows.select("text", F.xxhash64("text").alias("h")).collect()}
    assert got == sorted([(1, True, hashes[a]), (2, False, hashes[a]), (2, True, hashes[b]), (2, True, hashes[b])])


def test_one_id_in_a_third_of_rows(spark):
    rows = [(7 if i % 3 == 0 else i, "x" * (i % 50)) for i in range(600)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(9), shards=6).collect()
    assert len(got) == 600 and sorted((r.shard, r.slot) for r in got) == sorted((s, k) for s in range(6) for k in range(sum(r.shard == s for r in got)))
    sizes = [sum(r["size"] for r in got if r.shard == s) for s in range(6)]
    assert max(sizes) - min(sizes) <= 2 * 58


def test_repeated_rows_get_equal_scores(spark):
    docs = spark.createDataFrame([(i % 40, f"text number {i % 40} " * (1 + i % 40)) for i in range(80)] + [(None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 7), (2, None)], "doc_id long, quality int")
    got = {}
    for r in classify.quality_scores(docs, labels).collect():
        assert 0 <= r.score <= 1 and got.setdefault(r.doc_id, r.score) == r.score
    assert len(got) == 41
