"""Column order, NULL and duplicate keys, and deltas of the table maintenance operators."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from relkit.operators import dml
from relkit.operators.dml import S, When
from relkit.sources.batches import pending_batches

LAST = "name string, id int, x int"


def replay(target, result):
    """The target with the delta applied, row by row: it must be the snapshot."""
    signed = target.withColumn(dml.SIGN, F.lit(1)).unionByName(result.delta)
    left = signed.groupBy(*target.columns).agg(F.sum(dml.SIGN).alias("n"))
    assert left.where("n < 0").count() == 0
    return rows(left.where("n > 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))), *target.columns)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([("a", 1, 10), ("b", 2, 20), ("c", 3, None), ("n", None, 5)], LAST)


def test_snapshots_keep_the_column_order(spark, target):
    src = spark.createDataFrame([("B", 2, 21), ("d", 4, 40)], LAST)
    res = dml.upsert(target, src, ["id"])
    assert res.snapshot.columns == target.columns
    assert rows(res.snapshot) == rows(spark.createDataFrame([("a", 1, 10), ("B", 2, 21), ("c", 3, None), ("n", None, 5), ("d", 4, 40)], LAST))
    accepted, rejected = dml.insert_new_only(target, src, ["id"], ["x"])
    assert accepted.columns == target.columns and rejected.columns == [*target.columns, "reason"]
    assert rows(accepted) == [("d", 4, 40)] and rows(rejected) == [("B", 2, 21, "key exists")]
    assert pending_batches(src, target, ["id"], ["id"]).columns == [*src.columns, "batch_id"]
    merged = dml.merge(target, src, ["id"], [When(True, {"x": S("x")}), When(False, {c: S(c) for c in target.columns})])
    assert merged.snapshot.columns == target.columns


def test_deltas_lead_from_target_to_snapshot(spark, target):
    src = spark.createDataFrame([("B", 2, 21), ("d", 4, 40), ("N", None, 1)], LAST)
    clauses = [When(True, "delete", S("x") > 30), When(True, {"x": S("x")}, S("x") < 30),
               When(False, {c: S(c) for c in target.columns}, S("x") > 5)]
    for res in (dml.insert(target, src), dml.update(target, {"x": F.col("x") + 1}, F.col("id") > 1),
                dml.delete(target, F.col("x") > 15), dml.upsert(target, src, ["id"]), dml.merge(target, src, ["id"], clauses)):
        assert replay(target, res) == rows(res.snapshot)


def test_merge_allows_duplicates_that_change_nothing(spark, target):
    src = spark.createDataFrame([("B", 2, 21), ("B", 2, 99), ("z", 7, 99), ("z", 8, 1)], LAST)
    one = [When(True, {"x": S("x")}, S("x") < 50), When(False, {c: S(c) for c in target.columns}, S("x") < 50)]
    res = dml.merge(target, src, ["id"], one)
    assert rows(res.snapshot, "id", "x") == rows(spark.createDataFrame([(1, 10), (2, 21), (3, None), (None, 5), (8, 1)], "id int, x int"))
    assert rows(res.audit, "operation", "id") == [("INSERT", 8), ("UPDATE", 2)]
    none = dml.merge(target, src, ["id"], [When(True, "delete", S("x") > 1000)])
    assert rows(none.snapshot) == rows(target)
    with pytest.raises(ValueError):
        dml.merge(target, src, ["id"], [When(True, {"x": S("x")})])


def test_merge_plans_no_full_outer_join(spark, target):
    src = spark.createDataFrame([("B", 2, 21)], LAST)
    res = dml.merge(target, src, ["id"], [When(True, {"x": S("x")}), When(False, {c: S(c) for c in target.columns})])
    plan = res.snapshot._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "LeftAnti" in plan


def test_a_key_map_gives_one_new_key(spark):
    child = spark.createDataFrame([(10, 1), (11, 1)], "id int, fk int")
    twice = spark.createDataFrame([(1, 5), (1, 6)], "old_key int, new_key int")
    with pytest.raises(ValueError):
        dml.cascade_update(child, "fk", twice)
    once = spark.createDataFrame([(1, 5), (None, 6), (None, 7)], "old_key int, new_key int")
    assert rows(dml.cascade_update(child, "fk", once)) == [(10, 5), (11, 5)]


def test_new_rows_with_two_key_columns(spark):
    target = spark.createDataFrame([(1, 1)], "a int, b int")
    batch = spark.createDataFrame([(9, 1, 1), (8, 1, 2), (7, 1, 2), (6, None, 2), (5, None, 2), (4, 1, None)], "seq int, a int, b int")
    accepted, rejected = dml.insert_new_only(target, batch, ["a", "b"], ["seq"])
    assert rows(accepted, "seq") == [(4,), (5,), (6,), (7,)]
    assert rows(rejected, "seq", "reason") == [(8, "duplicate in batch"), (9, "key exists")]
