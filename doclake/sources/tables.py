"""Parquet tables of a data set folder (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read one table; columns are pruned and filters pushed by Catalyst."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, root).lineitem``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return table(self.spark, self.root, name)
