"""Join shapes.

Spark chooses broadcast vs. sort-merge itself from size estimates, and AQE
re-plans from real shuffle sizes; explicit broadcasts are used here only for
sides whose size is bounded by construction (fixed band tables, one-row
aggregates) or checked at run time by ``broadcast_if_bounded``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only if it provably has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows (a limited scan), so it is
    cheap when the side is small and stops early when it is not.  Beyond the
    bound the frame is returned unchanged and Spark/AQE pick a shuffle join.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def inner(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "inner")


def chain(frames: Sequence[DataFrame], keys: Sequence, how: str = "inner") -> DataFrame:
    """``f0 JOIN f1 USING (k1) JOIN f2 USING (k2) ...``."""
    out = frames[0]
    for frame, key in zip(frames[1:], keys):
        out = out.join(frame, key, how)
    return out


def full_outer_coalesced(left: DataFrame, right: DataFrame, key: str,
                         left_key: str | None = None, right_key: str | None = None) -> DataFrame:
    """FULL OUTER JOIN with one coalesced key column (as ``USING`` gives)."""
    lk = left_key or key
    rk = right_key or key
    l2 = left.withColumnRenamed(lk, "_fo_l")
    r2 = right.withColumnRenamed(rk, "_fo_r")
    j = l2.join(r2, l2["_fo_l"] == r2["_fo_r"], "full")
    return j.withColumn(key, F.coalesce("_fo_l", "_fo_r")).drop("_fo_l", "_fo_r")


def full_outer_lookup(left: DataFrame, lookup: DataFrame, key: str,
                      left_key: str | None = None, right_key: str | None = None) -> DataFrame:
    """FULL OUTER JOIN of a large frame with a lookup table on a few hot keys.

    A full outer join can be neither broadcast nor split, so a key with a third
    of the rows lands in one task.  Here the large side is left-joined (Spark
    may broadcast the lookup, or AQE split the key), and the lookup rows that
    no distinct key of the large side meets are added.  Rows of either side
    with a NULL key match nothing and are kept.
    """
    lk, rk = left_key or key, right_key or key
    l2 = left.withColumnRenamed(lk, "_fo_l")
    r2 = lookup.withColumnRenamed(rk, "_fo_r")
    matched = l2.join(r2, F.col("_fo_l") == F.col("_fo_r"), "left")
    held = l2.select("_fo_l").distinct()
    rest = r2.join(held, F.col("_fo_l") == F.col("_fo_r"), "left_anti")
    both = matched.unionByName(rest, allowMissingColumns=True)
    return both.withColumn(key, F.coalesce("_fo_l", "_fo_r")).drop("_fo_l", "_fo_r")


def self_parent(df: DataFrame, id_col: str, parent_col: str, keep: Sequence[str],
                prefix: str = "parent_") -> DataFrame:
    """Each row with its parent's columns (LEFT self join; roots get NULLs)."""
    parent = df.select(F.col(id_col).alias("_sp_id"), *[F.col(c).alias(prefix + c) for c in keep])
    return df.join(parent, df[parent_col] == parent["_sp_id"], "left").drop("_sp_id")


def left_where_null(left: DataFrame, right: DataFrame, on, payload: str) -> DataFrame:
    """``LEFT JOIN ... WHERE right.payload IS NULL``.

    Keeps left rows with no match *and* matches whose payload is NULL; this
    is not an anti join when the payload is nullable.
    """
    return left.join(right, on, "left").where(F.col(payload).isNull())


def anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Left rows with no match on the key (``NOT EXISTS``)."""
    return left.join(right, on, "left_anti")


def semi(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Left rows with at least one match (``EXISTS``/``IN``), each once."""
    return left.join(right, on, "left_semi")


def band_join(df: DataFrame, value: Column | str, bands: DataFrame,
              lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Attach the band whose ``[lo, hi)`` contains ``value`` (NULL bounds = open).

    ``bands`` must be a small table (its rows are compared against every
    input row); callers build it from a fixed list, so it is broadcast.
    """
    v = F.col(value) if isinstance(value, str) else value
    cond = ((bands[lo].isNull() | (v >= bands[lo])) & (bands[hi].isNull() | (v < bands[hi])))
    return df.join(F.broadcast(bands), cond, "left")


def bands_frame(spark, rows: Sequence[tuple], label: str = "band") -> DataFrame:
    """A band table from ``(lo, hi, label)`` tuples (bounded by the list)."""
    return spark.createDataFrame(list(rows), f"lo double, hi double, {label} string")
