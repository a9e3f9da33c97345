"""Constraints as checks: each rule returns the violating rows.

Spark does not enforce NOT NULL, UNIQUE, FOREIGN KEY, CHECK or length on
Parquet tables; these jobs verify a snapshot before it is published.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One pass over ``df``: ``(column_name, n_null, n_rows)`` per column."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(f"_z{i}")
                   for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _z{i}" for i, c in enumerate(cols))
    return agg.select(F.expr(f"stack({len(cols)}, {pairs}) as (column_name, n_null)"),
                      F.col("_n").alias("n_rows"))


def not_null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = None
    for c in cols:
        e = F.col(c).isNull()
        cond = e if cond is None else cond | e
    return df.where(cond)


def unique_violations(df: DataFrame, keys: Sequence[str], count_name: str = "n") -> DataFrame:
    """Key values held by more than one row; NULL keys are exempt (UNIQUE)."""
    nonnull = df
    for k in keys:
        nonnull = nonnull.where(F.col(k).isNotNull())
    return (nonnull.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
                   .where(F.col(count_name) > 1))


def foreign_key_violations(child: DataFrame, fk: Sequence[str], parent: DataFrame,
                           pk: Sequence[str]) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row."""
    c = child
    for k in fk:
        c = c.where(F.col(k).isNotNull())
    p = parent.select(*[F.col(a).alias(f"_fk_{i}") for i, a in enumerate(pk)])
    cond = None
    for i, k in enumerate(fk):
        e = c[k] == p[f"_fk_{i}"]
        cond = e if cond is None else cond & e
    return c.join(p, cond, "left_anti")


def length_violations(df: DataFrame, col: str, max_len: int) -> DataFrame:
    """Values longer than ``varchar(max_len)``."""
    return df.where(F.char_length(F.col(col)) > max_len)


def check_violations(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which a CHECK / view check option is FALSE (NULL passes, as in SQL)."""
    return df.where(~F.coalesce(predicate, F.lit(True)))


def view_violations(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that a view WITH CHECK OPTION rejects: its predicate is not TRUE (a NULL fails)."""
    return df.where(~F.coalesce(predicate, F.lit(False)))
