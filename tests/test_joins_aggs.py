from pyspark.sql import functions as F

from conftest import rows
from relkit.functions import scalar as fx
from relkit.operators import joins


def _lr(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, lv string")
    right = spark.createDataFrame([(1, "x"), (3, "z"), (None, "m")], "rk int, rv string")
    return left, right


def test_null_join_keys_never_match(spark):
    left, right = _lr(spark)
    on = left.k == right.rk
    assert rows(left.join(right, on, "inner"), "k", "rv") == [(1, "x")]
    assert rows(joins.anti(left, right, on), "lv") == [("b",), ("n",)]
    assert rows(joins.semi(left, right, on), "lv") == [("a",)]
    full = joins.full_outer_coalesced(left, right, "key", left_key="k", right_key="rk")
    assert rows(full, "key", "lv", "rv") == [(1, "a", "x"), (2, "b", None), (3, None, "z"), (None, "n", None),
                                             (None, None, "m")]


def test_left_join_is_null_keeps_null_payload_matches(spark):
    cust = spark.createDataFrame([(1,), (2,), (3,)], "c int")
    orders = spark.createDataFrame([(10, 1, 5), (11, 2, None)], "o int, oc int, ship_via int")
    got = joins.left_where_null(cust, orders, cust.c == orders.oc, "ship_via")
    # customer 2 has an order with no shipping choice, customer 3 no order
    assert rows(got, "c", "o") == [(2, 11), (3, None)]


def test_self_parent_root_gets_nulls(spark):
    emp = spark.createDataFrame([(1, None, "root"), (2, 1, "kid")], "id int, boss int, name string")
    got = joins.self_parent(emp, "id", "boss", ["name"], prefix="boss_")
    assert rows(got, "id", "boss_name") == [(1, None), (2, "root")]


def test_band_join_open_bounds_and_null_value(spark):
    bands = joins.bands_frame(spark, [(None, 10.0, "low"), (10.0, None, "high")])
    df = spark.createDataFrame([(1, 5.0), (2, 10.0), (3, None)], "id int, v double")
    assert rows(joins.band_join(df, "v", bands), "id", "band") == [(1, "low"), (2, "high"), (3, None)]


def test_broadcast_if_bounded_falls_back(spark):
    small = spark.range(5)
    big = spark.range(100)
    hinted = joins.broadcast_if_bounded(small, 10)
    plan = spark.range(50).join(hinted, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert joins.broadcast_if_bounded(big, 10) is big


def test_aggregates_ignore_null_inputs_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 1.00), ("a", None), ("a", 2.01), ("b", None)], "g string, x double")
    got = {r["g"]: r["avg"] for r in df.groupBy("g").agg(fx.avg_money("x").alias("avg")).collect()}
    assert got == {"a": 1.51, "b": None}   # (1.00 + 2.01) / 2 = 1.505 -> half up
    empty = df.where("g = 'zzz'")
    assert empty.groupBy("g").count().count() == 0
    assert empty.agg(F.max("x")).first()[0] is None


def test_null_sort_keys_follow_sql_defaults(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 1.0)], "id int, v double")
    asc_first = [r["id"] for r in df.orderBy(F.col("v").asc_nulls_last()).collect()]
    desc_first = [r["id"] for r in df.orderBy(F.col("v").desc_nulls_first()).collect()]
    assert asc_first == [3, 1, 2] and desc_first == [2, 1, 3]   # PostgreSQL: NULLs largest


def test_full_outer_lookup_equals_full_outer(spark):
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, k string")
    lookup = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z"), (None, "n")], "rk string, d string")
    plain = joins.full_outer_coalesced(left, lookup, "key", left_key="k", right_key="rk")
    split = joins.full_outer_lookup(left, lookup, "key", left_key="k", right_key="rk")
    assert rows(split, "id", "key", "d") == rows(plain, "id", "key", "d")
    empty = joins.full_outer_lookup(left.limit(0), lookup, "key", left_key="k", right_key="rk")
    assert sorted(r.d for r in empty.collect()) == ["n", "x", "y", "z"]
    assert rows(joins.full_outer_lookup(left, lookup.limit(0), "key", left_key="k", right_key="rk"), "id") == [(1,), (2,), (3,), (4,)]
