"""File sources and sinks: CSV with a declared schema, month-partitioned
Parquet with pruning, and partition inventories.

Schemas are always declared, never inferred: inference reads the data an
extra time and can change types between runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: What the reader gives for a quoted empty field, to tell it from an empty one (NULL).
_EMPTY = "\u0001empty\u0001"


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, one file per task; spaces, quotes and backslashes are kept, NULL is empty and '' is quoted."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", '""')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_csv(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False) -> DataFrame:
    """Header CSV with an explicit schema; empty fields read as NULL, quoted empty ones as ''.

    Quoted fields may hold commas and doubled quotes, and with ``multi_line``
    line breaks (each file is then read by one task).
    """
    df = (spark.read.schema(schema).option("header", True).option("multiLine", multi_line).option("escape", '"')
          .option("emptyValue", _EMPTY).option("encoding", "UTF-8").option("mode", "FAILFAST").csv(path))
    return df.select(*[F.when(F.col(f"`{c}`") != _EMPTY, F.col(f"`{c}`")).when(F.col(f"`{c}`") == _EMPTY, "").alias(c)
                       if kind == "string" else F.col(f"`{c}`") for c, kind in df.dtypes])


MONTH = "month"


def month_key(date_col: str | Column) -> Column:
    """The partition value of a date: ``'yyyy-MM'`` (one partition per month)."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.date_format(c, "yyyy-MM")


def write_by_month(df: DataFrame, date_col: str, path: str, num_tasks: int | None = None,
                   salt_buckets: int = 1024) -> None:
    """``PARTITION BY RANGE (date)`` with monthly partitions.

    Rows are range-partitioned on (month, salt) before the write: every task
    holds a contiguous slice of months and so writes files for one or two
    month directories, while the salt (a hash of the row, deterministic, so a
    retried task rewrites the same rows) lets a large or hot month spread
    over several tasks instead of landing in one.
    """
    n = num_tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salt_buckets))
    (df.withColumn(MONTH, month_key(date_col))
       .repartitionByRange(n, F.col(MONTH), salt)
       .write.mode("overwrite").partitionBy(MONTH).parquet(path))


def read_months(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def between_dates(df: DataFrame, date_col: str, lo: str, hi: str) -> DataFrame:
    """``date BETWEEN lo AND hi`` on a month-partitioned table.

    A predicate on the date column alone does not prune the derived month
    partitions, so the implied month range is added; Spark applies it as a
    ``PartitionFilters`` entry and lists only the matching directories.
    """
    lo_d = F.lit(lo).cast("date")
    hi_d = F.lit(hi).cast("date")
    return df.where((F.col(MONTH) >= lo[:7]) & (F.col(MONTH) <= hi[:7])
                    & (F.col(date_col) >= lo_d) & (F.col(date_col) <= hi_d))


def single_month(df: DataFrame, month: str) -> DataFrame:
    """Read one child partition directly (a partition-column equality)."""
    return df.where(F.col(MONTH) == month)


def partition_inventory(df: DataFrame, date_col: str) -> DataFrame:
    """Partitions with their actual date range and row count."""
    return df.groupBy(MONTH).agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                                 F.count(F.lit(1)).alias("n_rows"))


def inventory_from_footers(spark: SparkSession, path: str, schema: StructType | str, date_col: str) -> DataFrame:
    """The same inventory of a month-partitioned Parquet table from its files' statistics.

    Counts and date ranges per month are pushed into the scan (Spark's
    aggregate pushdown of the Parquet source), which then reads file footers
    and no rows.  The setting belongs to a session of its own, so the caller's
    is left alone.  Spark pushes dates and numbers, not timestamps.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = own.read.schema(schema).parquet(path)
    dated = partition_inventory(table.where(F.col(MONTH).isNotNull()), date_col)
    # Files without any date have no range in their footers; their rows are counted.
    undated = table.where(F.col(MONTH).isNull()).groupBy(MONTH).agg(F.count(F.lit(1)).alias("n_rows"))
    return dated.unionByName(undated, allowMissingColumns=True)
