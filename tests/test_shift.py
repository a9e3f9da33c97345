"""LAG and LEAD in one exchange, with hot partition keys cut into ranges."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from relkit.operators.windows import asc, desc, lag, lead, shift


def table(spark, n=600):
    rnd = random.Random(8)
    part = lambda k: rnd.choice(["hot"] * 6 + [None] * 3 + [f"p{k % 40}"])
    return spark.createDataFrame([(part(k), rnd.choice([None, *range(12)]), k, rnd.choice([None, k * 10])) for k in range(n)],
                                 "p string, o int, id int, v int")


@pytest.mark.parametrize("order, sql", [
    ([asc("o"), "id"], "o ASC NULLS LAST, id"), ([desc("o"), "id"], "o DESC NULLS FIRST, id"),
    ([asc("o", nulls_first=True), desc("id")], "o ASC NULLS FIRST, id DESC"), ([desc("o", nulls_first=False), "id"], "o DESC NULLS LAST, id")])
@pytest.mark.parametrize("offset", [1, -1])
@pytest.mark.parametrize("size", [7, 60, 10**6])
def test_equals_the_window(spark, order, sql, offset, size):
    df = table(spark)
    df.createOrReplaceTempView("t_shift")
    fn = "lag" if offset == 1 else "lead"
    want = spark.sql(f"SELECT *, {fn}(v, 1, id) OVER (PARTITION BY p ORDER BY {sql}) AS nb FROM t_shift")
    got = shift(df, ["p"], order, "v", offset, "nb", default="id", rows_per_range=size)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_two_partition_columns_and_no_default(spark):
    df = table(spark).withColumn("q", F.col("id") % 2)
    df.createOrReplaceTempView("t_shift2")
    want = spark.sql("SELECT *, lead(v) OVER (PARTITION BY p, q ORDER BY id) AS nb FROM t_shift2")
    assert rows(shift(df, ["p", "q"], ["id"], "v", -1, "nb", rows_per_range=25)) == rows(want)


def test_whole_table(spark):
    df = table(spark)
    df.createOrReplaceTempView("t_shift3")
    for fn, sql in ((lag, "lag(v, 1, -1)"), (lead, "lead(v, 1, -1)")):
        want = spark.sql(f"SELECT *, {sql} OVER (ORDER BY id) AS nb FROM t_shift3")
        assert rows(fn(df, [], ["id"], "v", "nb", default=F.lit(-1))) == rows(want)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") + plan.count("SinglePartition")


def test_one_exchange(spark):
    df = table(spark)
    assert exchanges(shift(df, ["p"], ["id"], "v", 1, "nb")) == 1
    # The boundary table, one row per range of a hot key, has its own; the rows have one.
    cut = shift(df, ["p"], ["id"], "v", 1, "nb", rows_per_range=10)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    main = plan[:plan.rindex("BroadcastExchange")]
    assert "rangepartitioning" not in plan and main.count("Window [lag") == 1


def test_ranges_are_balanced(spark):
    from relkit.operators.windows import _hot_ranges, _keys
    df = spark.range(20_000).selectExpr("cast(id % 3 = 0 AS int) AS p", "id AS o")
    hot = _hot_ranges(df, ["p"], _keys(["o"]), 500)
    bounds = {r["_hr_0"]: r["_hr_bounds"] for r in hot.collect()}
    assert set(bounds) == {0, 1} and 20 <= len(bounds[0]) <= 40
    cuts = [0, *(b["k0"] for b in bounds[0]), 20_000]
    assert max(b - a for a, b in zip(cuts, cuts[1:])) < 3 * 20_000 / len(cuts)
