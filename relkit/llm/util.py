"""Helpers shared by the training-data operators.

``stored`` is the one way these operators cut lineage or use a result twice:
the frame is written as Parquet under the folder that ``spark.checkpoint.dir``
names (shared by driver and executors) and read back, so a lost executor never
takes a finished step with it.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

#: The folder that holds the ``relkit`` package.
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Bytes of an Arrow batch between Spark and a Python worker: both hold a few copies of it at a time.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: A small table is written in no more files than so many per core, or of so many rows.
FILES_PER_CORE, FILE_ROWS = 8, 1 << 16


def prepare(spark: SparkSession) -> None:
    """Make the package importable in Python workers, set the checkpoint folder and bound the Arrow batches."""
    ensure_checkpoint_dir(spark)
    # A limit that the caller set stays.
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if _ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, known]))


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared scratch space and read it back.

    ``rows``: how many it has at most.  It then goes into few files, however many
    partitions the session deals small tables to; each file costs its executor
    two processes on a local file system.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(FILES_PER_CORE * spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    """A text column as string, NULL read as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """One Arrow batch of ``columns`` (lists, numpy or Arrow arrays) under ``schema``."""
    arrays = [c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
              for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
