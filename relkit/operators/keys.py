"""Surrogate keys (``SERIAL``), gap-free and deterministic.

New ids are ``max(existing id) + position`` where the position comes from
``global_position`` (range buckets, no single-task window).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import SortKey, global_position


def assign_ids(df: DataFrame, order: Sequence[SortKey | str], name: str = "id",
               existing: DataFrame | None = None, existing_col: str | None = None,
               start: int = 1) -> DataFrame:
    """Number rows ``start..`` in ``order``, after the largest existing id."""
    numbered = global_position(df, order, "_sk_pos")
    if existing is not None:
        base = existing.agg(F.coalesce(F.max(existing_col), F.lit(0)).cast("long")).scalar()
        ident = base + F.col("_sk_pos")
    else:
        ident = F.col("_sk_pos") + F.lit(start - 1)
    return numbered.withColumn(name, ident.cast("long")).drop("_sk_pos")
