"""Readers for the base tables.

Every reader is a plain ``spark.read.parquet`` so Catalyst sees the scan and
can prune columns and push filters into it; nothing is cached or collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLE_NAMES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Attribute access to the base tables of one data directory.

    ``Tables(spark, d).orders`` returns a fresh lazy scan each time, so two
    uses in one plan are two scan nodes that Spark can reuse or prune
    independently.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def register_views(self, names=TABLE_NAMES) -> None:
        """Expose the tables to ``spark.sql`` under their own names."""
        for n in names:
            read_table(self.spark, self.sf_dir, n).createOrReplaceTempView(n)
