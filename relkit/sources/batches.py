"""Bulk copy in key-ordered batches (the reference's loop that copies 100
not-yet-loaded rows per call until none are left).

Set-based form: the rows missing from the target are found with one anti
join and every one of them gets its batch number from its position in key
order, so all batches are known in one pass and can be written (or
replayed) independently; the streaming form is ``streaming.copy``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.windows import SortKey, global_position


def pending_batches(source: DataFrame, target: DataFrame, keys: Sequence[str],
                    order: Sequence[SortKey | str], batch_size: int = 100,
                    name: str = "batch_id") -> DataFrame:
    """Source rows not yet in ``target``, each with a 1-based batch number."""
    # A join USING moves the keys to the front.
    pending = source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)
    pos = global_position(pending, order, "_b_pos")
    return (pos.withColumn(name, ((F.col("_b_pos") - 1) / F.lit(batch_size)).cast("long") + 1)
               .drop("_b_pos"))
