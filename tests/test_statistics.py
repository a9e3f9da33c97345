"""Samples, distinct counts that roll up, profiles and the inventory from file statistics."""

import datetime as dt
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from relkit.operators import profile as prof
from relkit.operators import rollup, sampling
from relkit.session import scratch_path
from relkit.sources import files


# ------------------------------------------------------------- samples

def test_samples_repeat_and_nest(spark):
    df = spark.range(500).selectExpr("id", "id % 4 AS g").repartition(7)
    small, large = (set(r.id for r in sampling.sample_fixed(df, k, ["id"], 3).collect()) for k in (20, 60))
    again = set(r.id for r in sampling.sample_fixed(df.repartition(3), 20, ["id"], 3).collect())
    assert small == again and small < large and len(small) == 20
    assert small != set(r.id for r in sampling.sample_fixed(df, 20, ["id"], 4).collect())
    assert sampling.sample_fixed(df, 1000, ["id"], 3).count() == 500


def test_strata_get_their_share(spark):
    df = spark.createDataFrame([(k, "a" if k < 200 else "b" if k < 203 else None) for k in range(260)], "id int, g string")
    got = Counter(r.g for r in sampling.sample_stratified(df, ["g"], 10, ["id"], 1).collect())
    assert got == Counter({"a": 10, "b": 3, None: 10})
    sizes = F.when(F.col("g") == "a", 25).otherwise(1)
    assert Counter(r.g for r in sampling.sample_stratified(df, ["g"], sizes, ["id"], 1).collect()) == Counter({"a": 25, "b": 1, None: 1})


def test_every_row_is_as_likely(spark):
    df = spark.range(40)
    hits = Counter()
    for seed in range(200):
        hits.update(r.id for r in sampling.sample_fixed(df, 10, ["id"], seed).collect())
    # 50 expected for each of 40 rows: chi squared with 39 degrees of freedom, 99.9% quantile 72.1.
    assert sum((hits[k] - 50) ** 2 / 50 for k in range(40)) < 72.1


def test_weights_decide(spark):
    df = spark.createDataFrame([(k, 10.0 if k < 5 else 1.0) for k in range(55)] + [(100, 0.0), (101, None), (102, -1.0), (103, math.inf)],
                               "id int, w double")
    first = Counter(r.id < 5 for seed in range(60) for r in sampling.sample_weighted(df, 1, "w", ["id"], seed).collect())
    assert 17 < first[True] < 43  # half of the weight: 30 expected, standard deviation 3.9
    assert {r.id for r in sampling.sample_weighted(df, 100, "w", ["id"], 1).collect()} == set(range(55))


# ------------------------------------------------------------ roll-up

def test_distinct_counts_roll_up(spark):
    rnd = random.Random(1)
    day = lambda: dt.date(2023, 11, 1) + dt.timedelta(days=rnd.randrange(120))
    ids = [None, -5, 0, 1, 32767, 32768, 32769, -40000, 10**12, *range(200, 400)]
    df = spark.createDataFrame([(day(), rnd.choice(ids)) for _ in range(3000)], "d date, who long")
    stored = rollup.distinct_bitmaps(df, {"day": F.col("d")}, "who")
    for level in (F.year("day"), F.date_format("day", "yyyy-MM"), F.dayofweek("day"), F.col("day")):
        want = df.withColumnRenamed("d", "day").groupBy(level.alias("v")).agg(F.count_distinct("who").alias("n"))
        assert rows(rollup.rolled_up(stored, {"v": level}, "n")) == rows(want)
    both = rollup.rolled_up_levels(stored, {"year": F.year("day"), "dow": F.dayofweek("day")})
    assert both.where("level = 'year'").count() == 2 and both.where("level = 'dow'").count() == 7


def test_names_get_numbers(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "name string")
    assert rows(rollup.numbered(df, "name", "id")) == [("a", 1), ("b", 2), ("c", 3)]


# ------------------------------------------------------------ profile

def odd(spark):
    ts = dt.datetime(2024, 10, 27, 0, 30)
    return spark.createDataFrame(
        [(1, 0.0, "a", ts, bytearray(b"x"), [1]), (1, -0.0, "a", ts + dt.timedelta(hours=1), bytearray(b"y"), [1]),
         (2, float("nan"), "", None, None, [2, None]), (None, float("nan"), None, ts, None, None)],
        "i int, d double, s string, t timestamp, b binary, l array<int>")


def test_exact_profile_counts_values(spark):
    df = odd(spark)
    got = {r.column_name: r.n_distinct for r in prof.profile(df, ["i", "d", "s", "t", "b", "l"]).collect()}
    want = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    assert got == want
    assert {r.n_distinct for r in prof.profile(df.limit(0)).collect()} == {0}


def test_exact_profile_copies_no_rows(spark):
    plan = prof.profile(odd(spark), ["i", "s"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan


def test_sketches_merge_within_their_errors(spark):
    n = 20_000
    df = spark.range(n).selectExpr("id", "id % 12 AS month", "cast(pmod(hash(id), 5000) AS double) AS v", "id % 20 AS few",
                                   "if(id % 4 = 0, NULL, concat('n', id % 3000)) AS name", "date_add(date'2024-01-01', cast(id % 365 AS int)) AS d",
                                   "cast(NULL AS double) AS nothing")
    cols = ["v", "few", "name", "d", "nothing"]
    path = scratch_path(spark, "t_sketches")
    # Stored part by part, as a table grows.
    for lo in (0, 6):
        prof.sketches(df.where(f"month BETWEEN {lo} AND {lo + 5}"), F.col("month"), cols).write.mode("append").parquet(path)
    got = {r.column_name: r for r in prof.from_sketches(spark.read.parquet(path), cols).collect()}
    for c in cols:
        exact = df.agg(F.count_distinct(c)).first()[0]
        assert abs(got[c].n_distinct - exact) <= 0.05 * exact and got[c].n_rows == n
    assert got["name"].null_frac == 0.25 and got["nothing"].null_frac == 1.0 and got["name"].bounds is None
    values = sorted(r.v for r in df.select("v").collect())
    for j, b in enumerate(got["v"].bounds):
        below, upto = sum(x < b for x in values) / n, sum(x <= b for x in values) / n
        assert below - 0.02 <= j / 10 <= upto + 0.02
    assert sorted(c.freq for c in got["few"].common) == [n // 20] * 5 and got["nothing"].common == []


# ---------------------------------------------------------- inventory

def test_inventory_from_footers(spark):
    rows_ = [(k, None if k % 50 == 0 else dt.date(2024, 1, 1) + dt.timedelta(days=k % 200)) for k in range(400)]
    df = spark.createDataFrame(rows_, "id int, d date")
    path = scratch_path(spark, "t_inventory")
    files.write_by_month(df, "d", path)
    schema = df.withColumn(files.MONTH, F.lit("")).schema
    got = files.inventory_from_footers(spark, path, schema, "d")
    assert rows(got) == rows(files.partition_inventory(spark.read.schema(schema).parquet(path), "d"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(d), MAX(d), COUNT(*)]" in plan and "PushedGroupBy: [month]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
