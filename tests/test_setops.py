from conftest import rows
from relkit.operators import setops


def _ab(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "w")], "k int, v string")
    return a, b


def test_intersect_and_except_are_distinct_and_null_safe(spark):
    a, b = _ab(spark)
    assert rows(setops.intersect(a, b)) == [(1, "x"), (2, None)]
    assert rows(setops.except_(a, b)) == [(3, "z")]


def test_union_and_union_all(spark):
    a, b = _ab(spark)
    assert setops.union_all(a, b).count() == 7
    assert rows(setops.union(a, b)) == [(1, "x"), (2, None), (3, "z"), (4, "w")]
