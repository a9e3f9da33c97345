"""Random samples that can be repeated.

A row's draw is the MD5 of the seed and its key, so it does not depend on how
the table is cut into tasks, on retries or on the engine: the same seed takes
the same rows, and a larger sample holds the smaller one.  A fixed-size sample
is the k smallest draws (each task keeps k rows, then they are merged); per
stratum, a rank with a partial limit before the shuffle; by weight, the k
smallest exponential keys -ln(u) / w, which is sampling without replacement
with probabilities in proportion to the weights.

Keys must be unique for a well-defined sample; equal keys draw equally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGITS = 13  # hexadecimal: 52 bits, exact in a double


def draw(keys: Sequence[str], seed: int) -> Column:
    """The row's draw: 32 hexadecimal digits of the seed and the key (NULL reads as empty)."""
    part = lambda k: F.coalesce(F.col(k).cast("string"), F.lit(""))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[part(k) for k in keys]))


def uniform(keys: Sequence[str], seed: int) -> Column:
    """The draw as a number above 0 and below 1."""
    number = F.conv(F.substring(draw(keys, seed), 1, _DIGITS), 16, 10).cast("bigint").cast("double")
    return (number + 0.5) / float(16 ** _DIGITS)


def sample_fixed(df: DataFrame, k: int, keys: Sequence[str], seed: int) -> DataFrame:
    """``k`` rows (all, if there are fewer), every set of ``k`` as likely as any other."""
    return df.orderBy(draw(keys, seed), *keys).limit(k)


def sample_stratified(df: DataFrame, strata: Sequence[str], k: int | Column, keys: Sequence[str], seed: int) -> DataFrame:
    """``k`` rows of each stratum (a number, or a column that is the same within a stratum); NULL is a stratum too."""
    nth = F.row_number().over(Window.partitionBy(*strata).orderBy(draw(keys, seed), *keys))
    return df.withColumn("_sm_n", nth).where(F.col("_sm_n") <= k).drop("_sm_n")


def sample_weighted(df: DataFrame, k: int, weight: str | Column, keys: Sequence[str], seed: int) -> DataFrame:
    """``k`` rows drawn one after the other by weight, without replacement; rows without a positive weight are left out."""
    w = (F.col(weight) if isinstance(weight, str) else weight).cast("double")
    return df.where((w > 0) & (w < float("inf"))).orderBy(-F.ln(uniform(keys, seed)) / w, *keys).limit(k)
