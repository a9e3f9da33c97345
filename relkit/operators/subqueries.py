"""Subquery predicates with SQL's NULL and empty-set rules.

Quantified comparisons (``> ANY``/``> ALL``) do not parse in Spark SQL; they
are rewritten to one aggregate over the subquery, evaluated once as a scalar
subquery, so the outer table is streamed once with a constant comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _one_row(global_agg: DataFrame) -> DataFrame:
    """A global aggregate (exactly one row by construction), marked for
    broadcast: it is computed once and compared against every outer row."""
    return F.broadcast(global_agg)


def in_subquery(df: DataFrame, col: str, sub: DataFrame, sub_col: str) -> DataFrame:
    """``col IN (SELECT sub_col FROM sub)`` as a left-semi join."""
    keys = sub.select(F.col(sub_col).alias("_in_k"))
    return df.join(keys, df[col] == keys["_in_k"], "left_semi")


def not_in_subquery(df: DataFrame, col: str, sub: DataFrame, sub_col: str) -> DataFrame:
    """``col NOT IN (SELECT ...)``, null-aware.

    Empty subquery: every row qualifies (even a NULL ``col``).  A NULL in the
    subquery: no row qualifies.  Otherwise rows whose non-NULL ``col`` has no
    match.
    """
    stats = _one_row(sub.agg(F.count(F.lit(1)).alias("_nin_n"), F.count(sub_col).alias("_nin_nn")))
    keys = sub.select(F.col(sub_col).alias("_nin_k")).where(F.col("_nin_k").isNotNull())
    anti = df.join(keys, df[col] == keys["_nin_k"], "left_anti")
    keep = (F.col("_nin_n") == 0) | ((F.col("_nin_n") == F.col("_nin_nn")) & F.col(col).isNotNull())
    # Rows of the empty-subquery case are exactly the anti-join rows, since
    # nothing can match; so one filter over the anti join covers both cases.
    return anti.crossJoin(stats).where(keep).drop("_nin_n", "_nin_nn")


def gt_any(df: DataFrame, col: str, sub: DataFrame, sub_col: str) -> DataFrame:
    """``col > ANY (SELECT sub_col ...)`` == ``col > min(non-NULL sub_col)``.

    Empty or all-NULL subquery: no row.  A NULL in the subquery cannot make a
    TRUE comparison FALSE, so it is ignored when the minimum exists.
    """
    lo = sub.agg(F.min(sub_col)).scalar()
    return df.where(F.col(col) > lo)


def gt_all(df: DataFrame, col: str, sub: DataFrame, sub_col: str) -> DataFrame:
    """``col > ALL (SELECT sub_col ...)``.

    Empty subquery: every row qualifies (even a NULL ``col``).  Any NULL in a
    non-empty subquery: the comparison is never TRUE.  Otherwise
    ``col > max(sub_col)``.
    """
    stats = sub.agg(F.struct(F.max(sub_col).alias("mx"), F.count(F.lit(1)).alias("n"),
                             F.count(sub_col).alias("nn"))).scalar()
    n, nn, mx = (stats.getField(f) for f in ("n", "nn", "mx"))
    return df.where((n == 0) | ((n == nn) & (F.col(col) > mx)))


def eq_scalar(df: DataFrame, col: str, value_frame: DataFrame) -> DataFrame:
    """``col = (SELECT v FROM value_frame)``: value_frame has one column, <= 1 row."""
    return df.where(F.col(col) == value_frame.scalar())


def eq_max(df: DataFrame, col: str, sub: DataFrame | None = None, sub_col: str | None = None) -> DataFrame:
    """``col = (SELECT MAX(sub_col) FROM sub)``; defaults to ``df`` itself."""
    sub = df if sub is None else sub
    return df.where(F.col(col) == sub.agg(F.max(sub_col or col)).scalar())


def top1_key(df: DataFrame, key: str, order: list[Column]) -> Column:
    """Scalar subquery: the ``key`` of the first row in ``order`` (LIMIT 1)."""
    return df.orderBy(*order).limit(1).select(key).scalar()


def exists_where(df: DataFrame, sub: DataFrame, on) -> DataFrame:
    """``WHERE EXISTS (SELECT 1 FROM sub WHERE correlated)`` as left-semi join."""
    return df.join(sub, on, "left_semi")


def any_row(df: DataFrame) -> bool:
    """Driver-side ``EXISTS``: reads at most one row."""
    return len(df.limit(1).take(1)) > 0
