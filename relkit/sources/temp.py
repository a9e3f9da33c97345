"""Temporary tables of a session: created with a schema, filled by INSERTs, read by
name, dropped with their rows.  The rows lie in the shared scratch folder, so a
statement that reads the table sees what was inserted before and a lost
executor takes nothing with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.dml import insert
from ..session import scratch_path


class TempTable:
    """``CREATE TEMP TABLE name (schema)``."""

    def __init__(self, spark: SparkSession, name: str, schema: StructType | str) -> None:
        self.spark, self.name = spark, name
        self.schema = spark.createDataFrame([], schema).schema
        self._path = scratch_path(spark, f"temp-{name}")
        if spark.catalog.tableExists(name):
            raise ValueError(f"table {name!r} exists")
        spark.createDataFrame([], self.schema).write.parquet(self._path)
        self._show()

    def _show(self) -> None:
        self.spark.read.schema(self.schema).parquet(self._path).createOrReplaceTempView(self.name)

    def insert(self, rows: DataFrame, defaults: dict | None = None) -> None:
        """``INSERT INTO name (columns of rows) SELECT ...``; missing columns take defaults or NULL."""
        empty = self.spark.createDataFrame([], self.schema)
        insert(empty, rows, defaults).returning.write.mode("append").parquet(self._path)
        self._show()

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """``DROP TABLE name``: the name goes at once, and the rows with it."""
        self.spark.catalog.dropTempView(self.name)
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self._path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
