"""Schema evolution on snapshots (``ALTER TABLE`` add / retype / drop).

Parquet files are immutable; a new schema is a projection of the old
snapshot that is written as the next version.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evolve(df: DataFrame, add: Mapping[str, str] | None = None, retype: Mapping[str, str] | None = None,
           drop: Sequence[str] = (), defaults: Mapping | None = None) -> DataFrame:
    """Add columns (NULL or a default), cast columns, drop columns."""
    out = df
    for name, dtype in (retype or {}).items():
        out = out.withColumn(name, F.col(name).cast(dtype))
    for name, dtype in (add or {}).items():
        value = (defaults or {}).get(name)
        out = out.withColumn(name, F.lit(value).cast(dtype))
    return out.drop(*drop)
