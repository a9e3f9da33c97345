"""Incremental forms of the reference's row-at-a-time jobs, on Structured
Streaming.

* ``dedup_audit``: append an audit row for every arriving key the first time
  it is seen, rejecting keys seen in any earlier micro-batch (the
  duplicate-rejecting insert trigger).  State is the set of seen keys; with
  ``watermark`` it is bounded by event time (``dropDuplicatesWithinWatermark``).
  ``batch_copy`` with the same keys keeps them in storage instead.
* ``batch_copy``: copy arriving rows into a target table in micro-batches,
  skipping keys the target already holds (the "copy the next N rows until
  none are left" loop).  The target is an ``IndexedTarget``: a batch reads
  filters and those buckets that may hold its keys, not the table.  The
  checkpoint replaces the loop's "found" flag: a restart resumes after the
  last committed batch, and a replayed batch appends nothing twice.

A key with a NULL is never a duplicate, in either job.

Both run with ``trigger(availableNow=True)``: process everything that has
arrived, in bounded micro-batches, then stop.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .indexed import IndexedTarget, stream_id


def stage_landing(df: DataFrame, path: str, order_col: str, n_files: int) -> None:
    """Land a table as ``n_files`` files of consecutive ``order_col`` ranges
    (how data arrives for a file-stream source)."""
    df.repartitionByRange(n_files, order_col).write.mode("overwrite").parquet(path)


def _read(spark: SparkSession, path: str, schema: StructType, files_per_batch: int) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
                 .parquet(path))


def dedup_audit(spark: SparkSession, landing: str, schema: StructType, keys: Sequence[str],
                columns: Sequence[str], sink: str, checkpoint: str,
                watermark: tuple[str, str] | None = None, files_per_batch: int = 1) -> DataFrame:
    """Run the dedup-audit stream to completion and return the audit table."""
    stream = _read(spark, landing, schema, files_per_batch)
    no_key = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x)
    keyed, unkeyed = stream.where(~no_key), stream.where(no_key)
    if watermark:
        ts_col, delay = watermark
        keyed = keyed.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))
    else:
        keyed = keyed.dropDuplicates(list(keys))
    # Rows whose key has a NULL need no state.
    q = (keyed.select(*columns).unionByName(unkeyed.select(*columns)).writeStream.format("parquet")
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start(sink))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(sink)


def batch_copy(spark: SparkSession, landing: str, schema: StructType, keys: Sequence[str],
               target: str, checkpoint: str, files_per_batch: int = 1, buckets: int = 64,
               filter_bits: int = 1 << 16) -> DataFrame:
    """Copy landed rows into ``target`` batch by batch; returns the target's rows."""
    table = IndexedTarget(spark, target, schema, keys, buckets, filter_bits)

    def copy_batch(batch: DataFrame, epoch_id: int) -> None:
        table.append(batch, stream_id(spark, checkpoint), epoch_id, F.col("_file"))

    # The file a row came from names rows whose key has a NULL.
    rows = _read(spark, landing, schema, files_per_batch).select("*", F.col("_metadata.file_path").alias("_file"))
    q = rows.writeStream.foreachBatch(copy_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return table.read()
