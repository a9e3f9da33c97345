import pytest
import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import rows
from relkit.operators import publish, quality
from relkit.operators.profile import profile
from relkit.session import scratch_path
from relkit.sources import files
from relkit.sources.batches import pending_batches
from relkit.sources.evolve import evolve


def test_csv_quoted_commas_crlf_utf8_and_empty_as_null(spark, tmp_path):
    path = tmp_path / "employees.csv"
    path.write_bytes(("employeeID,employeeName,city,reportsTo\r\n"
                      '1,"Davolio, Nancy",Seattle,8\r\n'
                      "2,Fuller Andrew,Tacoma,\r\n"
                      "3,José Pavarotti,São Paulo,8\r\n").encode("utf-8"))
    df = files.read_csv(spark, str(path), "employeeID int, employeeName string, city string, reportsTo int")
    assert rows(df) == [(1, "Davolio, Nancy", "Seattle", 8), (2, "Fuller Andrew", "Tacoma", None),
                        (3, "José Pavarotti", "São Paulo", 8)]


def _partition_demo(spark):
    # 22 orders over 12 months, January and June with two each (as the reference's demo).
    days = [(1, 5), (1, 20), (2, 3), (3, 3), (4, 3), (5, 3), (6, 1), (6, 30), (7, 3), (8, 3), (9, 3), (10, 3),
            (11, 3), (12, 3), (2, 14), (3, 14), (4, 14), (5, 14), (7, 14), (8, 14), (9, 14), (10, 14)]
    data = [(i + 1, f"item{i}", i % 5 + 1, dt.date(2023, m, d)) for i, (m, d) in enumerate(days)]
    return spark.createDataFrame(data, "order_id int, product string, quantity int, order_date date")


def test_month_partitions_prune_and_inventory(spark):
    path = scratch_path(spark, "test_months")
    files.write_by_month(_partition_demo(spark), "order_date", path)
    df = spark.read.schema("order_id int, product string, quantity int, order_date date, month string").parquet(path)
    inv = {r["month"]: r["n_rows"] for r in files.partition_inventory(df, "order_date").collect()}
    assert len(inv) == 12 and inv["2023-01"] == 2 and inv["2023-06"] == 2 and sum(inv.values()) == 22
    q = files.between_dates(df, "order_date", "2023-06-01", "2023-06-30")
    assert q.count() == 2
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "2023-06" in plan
    assert files.single_month(df, "2023-01").count() == 2


def test_publish_guard_and_versions(spark):
    base = scratch_path(spark, "test_publish")
    df = spark.createDataFrame([(1, 10.0)], "id int, price double")
    assert publish.publish(df, base) == {"published": True, "version": 1}
    bad = df.where(F.col("price") > 5)
    assert publish.publish(df.withColumn("price", F.lit(99.0)), base, guard=bad) == {"published": False,
                                                                                      "version": 1}
    assert publish.publish(df.withColumn("price", F.lit(20.0)), base) == {"published": True, "version": 2}
    assert rows(publish.read_current(spark, base)) == [(1, 20.0)]


def test_pending_batches_of_100(spark):
    src = spark.range(0, 350).withColumnRenamed("id", "k")
    loaded = spark.range(0, 50).withColumnRenamed("id", "k")
    b = pending_batches(src, loaded, ["k"], ["k"], 100)
    counts = {r["batch_id"]: r["count"] for r in b.groupBy("batch_id").count().collect()}
    assert counts == {1: 100, 2: 100, 3: 100}
    assert rows(b.where("batch_id = 1").agg(F.min("k"), F.max("k"))) == [(50, 149)]


def test_evolve_and_quality_rules(spark):
    df = spark.createDataFrame([(1, "abcdef", 2), (1, None, None), (2, "x", 1)], "id int, name string, ref int")
    ev = evolve(df, add={"email": "string"}, retype={"id": "bigint"}, drop=["ref"])
    assert ev.columns == ["id", "name", "email"] and dict(ev.dtypes)["id"] == "bigint"
    nulls = {r["column_name"]: r["n_null"] for r in quality.null_counts(df).collect()}
    assert nulls == {"id": 0, "name": 1, "ref": 1}
    assert rows(quality.unique_violations(df, ["id"]), "id", "n") == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "pid int")
    assert rows(quality.foreign_key_violations(df, ["ref"], parent, ["pid"]), "ref") == [(2,)]
    assert quality.length_violations(df, "name", 5).count() == 1
    assert quality.check_violations(df, F.col("ref") > 1).count() == 1   # NULL passes a CHECK


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "id int, s string")
    p = {r["column_name"]: r for r in profile(df, profiled_at="2024-01-01 00:00:00").collect()}
    assert p["id"]["n_distinct"] == 2 and p["id"]["min_value"] == "1" and p["id"]["max_value"] == "2"
    assert abs(p["s"]["null_frac"] - 1 / 3) < 1e-12
    assert p["s"]["profiled_at"] == dt.datetime(2024, 1, 1)


def test_profile_approx_and_frequent_values(spark):
    from relkit.operators.profile import frequent_values
    df = spark.range(0, 1000).select((F.col("id") % 10).alias("k"), F.col("id"))
    p = {r["column_name"]: r for r in profile(df, approx=True).collect()}
    assert 9 <= p["k"]["n_distinct"] <= 11 and 950 <= p["id"]["n_distinct"] <= 1050
    top = frequent_values(df.where("id < 25"), "k", 3).collect()
    assert [(r["k"], r["freq"]) for r in top] == [(0, 3), (1, 3), (2, 3)]


def test_temp_tables_are_filled_and_dropped(spark):
    from relkit.sources.temp import TempTable
    t = TempTable(spark, "t_temp_rows", "k int, name string, qty int")
    assert t.read().count() == 0
    t.insert(spark.createDataFrame([("a", 1)], "name string, k int"), defaults={"qty": 0})
    t.insert(spark.sql("SELECT k + 1 AS k, name, 5 AS qty FROM t_temp_rows"))
    assert rows(spark.sql("SELECT * FROM t_temp_rows")) == [(1, "a", 0), (2, "a", 5)]
    with pytest.raises(ValueError):
        TempTable(spark, "t_temp_rows", "k int")
    t.drop()
    assert not spark.catalog.tableExists("t_temp_rows")
