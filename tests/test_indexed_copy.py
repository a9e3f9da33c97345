"""The copy target with a key index: exact, idempotent, and reading no more as the target grows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from relkit.session import scratch_path
from relkit.streaming import jobs
from relkit.streaming.indexed import IndexedTarget

SCHEMA = "k long, s string, x int"


def target(spark, keys=("k",), **more):
    schema = spark.createDataFrame([], SCHEMA).schema
    return IndexedTarget(spark, scratch_path(spark, "t_index"), schema, keys, **more)


def numbers(spark, lo, hi):
    return spark.range(lo, hi).selectExpr("id AS k", "concat('s', id) AS s", "cast(id % 7 AS int) AS x")


def test_new_and_known_keys(spark):
    t = target(spark, buckets=8, filter_bits=1024)
    assert t.read().count() == 0
    assert t.append(numbers(spark, 0, 100)) == 100 and t.append(numbers(spark, 50, 150)) == 50
    assert t.append(numbers(spark, 0, 150)) == 0 and t.append(numbers(spark, 0, 0)) == 0
    assert rows(t.read()) == rows(numbers(spark, 0, 150))


def test_a_full_filter_only_costs_reading(spark):
    t = target(spark, buckets=2, filter_bits=64)
    for lo in range(0, 300, 50):
        assert t.append(numbers(spark, lo, lo + 60)) == (60 if lo == 0 else 50)
    assert rows(t.read()) == rows(numbers(spark, 0, 310))


def test_a_batch_of_new_keys_reads_no_rows_of_the_target(spark):
    read = {}
    for size in (2_000, 40_000):
        t = target(spark, buckets=16, filter_bits=1 << 16)
        t.append(numbers(spark, 0, size))
        assert t.append(numbers(spark, 10**9, 10**9 + 20)) == 20
        stats = t.history()[-1]
        assert stats["read_buckets"] == 0 and stats["new"] == 20
        read[size] = stats["read_bytes"]
    # What is read are filters, which have one size.
    assert read[40_000] <= 16 * (1 << 16) / 8 + 16 * 2_000
    known = t.append(numbers(spark, 7, 8))
    assert known == 0 and t.history()[-1]["read_buckets"] == 1


def test_null_keys_and_repeated_rows(spark):
    t = target(spark, keys=("k", "s"))
    batch = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (None, "a", 1), (None, "a", 1), (1, None, 1), (2, "b", 1)], SCHEMA)
    here, there = F.lit("file-1"), F.lit("file-2")
    assert t.append(batch, origin=here) == 5
    assert t.append(batch, origin=here) == 0  # the same file again
    assert t.append(batch, origin=there) == 3  # other rows without a key
    got = Counter(tuple(r) for r in t.read().select("k", "s").collect())
    assert got == Counter({(None, "a"): 4, (1, None): 2, (1, "a"): 1, (2, "b"): 1})


def test_a_commit_that_failed_leaves_nothing(spark):
    t = target(spark, buckets=4)
    t.append(numbers(spark, 0, 10))
    # As a writer would leave it that died before its commit.
    left = numbers(spark, 50, 60).withColumns({"_origin": F.lit(None).cast("string"), "_b": F.lit(1), "_e": F.lit(1)})
    left.write.mode("append").partitionBy("_b", "_e").parquet(f"{t.path}/data")
    assert rows(t.read()) == rows(numbers(spark, 0, 10))
    assert t.append(numbers(spark, 5, 15)) == 5
    assert rows(t.read()) == rows(numbers(spark, 0, 15))


def test_micro_batches_are_taken_once(spark):
    t = target(spark)
    empty_key = spark.createDataFrame([(None, "a", 1)], SCHEMA)
    assert t.append(empty_key, "stream", 0) == 1 and t.append(empty_key, "stream", 0) == 0
    assert t.append(empty_key, "stream", 1, F.lit("f")) == 1 and t.append(empty_key, "other", 0, F.lit("g")) == 1
    with pytest.raises(ValueError):
        IndexedTarget(spark, t.path, t.schema, ["k"], buckets=3).append(empty_key)
    with pytest.raises(ValueError):
        IndexedTarget(spark, t.path, t.schema, ["k"], filter_bits=100)


def test_streams_keep_rows_without_a_key(spark):
    run = scratch_path(spark, "t_null_stream")
    landed = [[(None, "a", 1), (None, "a", 1), (1, "a", 1)], [(None, "a", 1), (1, "a", 5)]]
    for data in landed:
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{run}/landing")
    schema = spark.createDataFrame([], SCHEMA).schema
    for checkpoint in ("one", "one", "two"):
        out = jobs.batch_copy(spark, f"{run}/landing", schema, ["k"], f"{run}/target", f"{run}/{checkpoint}")
        assert Counter(r.k for r in out.collect()) == Counter({None: 3, 1: 1})
    audit = jobs.dedup_audit(spark, f"{run}/landing", schema, ["k"], ["k", "s"], f"{run}/sink", f"{run}/ck")
    assert Counter(r.k for r in audit.collect()) == Counter({None: 3, 1: 1})
