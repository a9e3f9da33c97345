"""Distinct counts that roll up.

``COUNT(DISTINCT id)`` per day does not add up to the count per month.  Bitmaps
do: ``distinct_bitmaps`` stores, per fine group and per bucket of 32,768 ids,
the set of ids as a bitmap (4 KB at most); ``rolled_up`` ors the bitmaps of
the fine groups of a coarser one and counts their bits.  Exact at every level
from one stored table, which also takes new days without reading old ones.

Ids are integers; ``numbered`` gives other values dense numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import global_position

_BUCKET, _BITS = "id_bucket", "id_bits"


def numbered(df: DataFrame, col: str, name: str) -> DataFrame:
    """The distinct values of ``col`` with numbers from 1: a dictionary for ids that are not integers."""
    return global_position(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], name)


def distinct_bitmaps(df: DataFrame, groups: Mapping[str, Column], id_col: str) -> DataFrame:
    """One bitmap per group and id bucket; NULL ids are in none."""
    rows = df.where(F.col(id_col).isNotNull()).select(
        *[c.alias(n) for n, c in groups.items()],
        F.bitmap_bucket_number(id_col).alias(_BUCKET), F.bitmap_bit_position(id_col).alias("_bit"))
    return rows.groupBy(*groups, _BUCKET).agg(F.bitmap_construct_agg("_bit").alias(_BITS))


def rolled_up(bitmaps: DataFrame, groups: Mapping[str, Column], name: str = "n_distinct") -> DataFrame:
    """Distinct ids per coarser group, from expressions over the stored groups."""
    keyed = bitmaps.select(*[c.alias(n) for n, c in groups.items()], _BUCKET, _BITS)
    merged = keyed.groupBy(*groups, _BUCKET).agg(F.bitmap_or_agg(_BITS).alias(_BITS))
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count(_BITS)).alias(name))


def rolled_up_levels(bitmaps: DataFrame, levels: Mapping[str, Column], name: str = "n_distinct") -> DataFrame:
    """(level, value, count) for several levels in one pass over the bitmaps; values are text."""
    pairs = F.array(*[F.struct(F.lit(n).alias("level"), c.cast("string").alias("value")) for n, c in levels.items()])
    keyed = bitmaps.select(F.explode(pairs).alias("at"), _BUCKET, _BITS).select("at.*", _BUCKET, _BITS)
    return rolled_up(keyed, {"level": F.col("level"), "value": F.col("value")}, name)
