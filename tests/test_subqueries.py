from pyspark.sql import functions as F

from conftest import rows
from relkit.operators import subqueries as sq


def _x(spark):
    return spark.createDataFrame([(1, 5.0), (2, 10.0), (3, None), (4, 20.0)], "id int, x double")


def _sub(spark, vals):
    return spark.createDataFrame([(v,) for v in vals], "v double")


def test_gt_all_empty_subquery_keeps_every_row_even_null(spark):
    assert sq.gt_all(_x(spark), "x", _sub(spark, []), "v").count() == 4


def test_gt_all_null_in_subquery_keeps_nothing(spark):
    assert sq.gt_all(_x(spark), "x", _sub(spark, [1.0, None]), "v").count() == 0


def test_gt_all_regular(spark):
    assert rows(sq.gt_all(_x(spark), "x", _sub(spark, [1.0, 9.0]), "v"), "id") == [(2,), (4,)]


def test_gt_any_rules(spark):
    x = _x(spark)
    assert sq.gt_any(x, "x", _sub(spark, []), "v").count() == 0
    assert sq.gt_any(x, "x", _sub(spark, [None]), "v").count() == 0
    # a NULL beside a real minimum does not block TRUE comparisons
    assert rows(sq.gt_any(x, "x", _sub(spark, [None, 9.0, 15.0]), "v"), "id") == [(2,), (4,)]


def test_not_in_null_aware(spark):
    x = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    empty = spark.createDataFrame([], "v int")
    with_null = spark.createDataFrame([(1,), (None,)], "v int")
    plain = spark.createDataFrame([(1,)], "v int")
    assert sq.not_in_subquery(x, "k", empty, "v").count() == 3
    assert sq.not_in_subquery(x, "k", with_null, "v").count() == 0
    assert rows(sq.not_in_subquery(x, "k", plain, "v")) == [(2,)]


def test_eq_max_keeps_all_ties(spark):
    df = spark.createDataFrame([("Mon", 3), ("Tue", 5), ("Wed", 5)], "d string, n int")
    assert rows(sq.eq_max(df, "n"), "d") == [("Tue",), ("Wed",)]


def test_scalar_top1_and_exists(spark):
    df = spark.createDataFrame([(1, 3), (2, 5), (3, 5)], "k int, n int")
    top = sq.top1_key(df, "k", [F.col("n").desc(), F.col("k").asc()])
    assert rows(df.where(F.col("k") == top), "k") == [(2,)]
    assert sq.any_row(df) and not sq.any_row(df.where("k > 10"))
