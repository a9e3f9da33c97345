"""Set operations with SQL semantics (by position, like SQL)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*frames: DataFrame) -> DataFrame:
    """``UNION ALL``: bag union, no shuffle."""
    return reduce(lambda a, b: a.union(b), frames)


def union(*frames: DataFrame) -> DataFrame:
    """``UNION``: distinct rows of the bag union (one aggregate, map-side first)."""
    return union_all(*frames).distinct()


def _null_safe_on(a: DataFrame, b: DataFrame):
    cond = None
    for ca, cb in zip(a.columns, b.columns):
        e = a[ca].eqNullSafe(b[cb])
        cond = e if cond is None else cond & e
    return cond


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """``INTERSECT`` (distinct; NULLs compare equal, as in SQL set operations).

    Both sides are de-duplicated first (partial aggregation before the
    shuffle), so a value repeated millions of times costs one row in the
    semi join instead of a skewed join partition.
    """
    left = a.distinct()
    right = b.distinct().toDF(*[f"_si_{i}" for i in range(len(b.columns))])
    return left.join(right, _null_safe_on(left, right), "left_semi")


def except_(a: DataFrame, b: DataFrame) -> DataFrame:
    """``EXCEPT`` (distinct).  ``exceptAll`` would keep duplicates; wrong here.

    De-duplicated on both sides before the null-safe anti join.
    """
    left = a.distinct()
    right = b.distinct().toDF(*[f"_se_{i}" for i in range(len(b.columns))])
    return left.join(right, _null_safe_on(left, right), "left_anti")
