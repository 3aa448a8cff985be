"""Stored tables dealt into buckets by key: joined or grouped by it without an exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.llm.common import make_folder


class BucketedTable:
    """An external table below ``folder``, bucketed and sorted by ``keys`` and
    partitioned by the text column ``part``; one that exists is opened again."""

    def __init__(self, spark: SparkSession, folder: str, columns: str, keys: list[str], buckets: int, part: str):
        self.spark, self.keys, self.buckets, self.part = spark, keys, buckets, part
        self.name = f"bucketed_{uuid.uuid4().hex[:12]}"
        make_folder(spark, folder)
        by = ", ".join(keys)
        spark.sql(f"CREATE TABLE {self.name} ({columns}, {part} STRING) USING parquet OPTIONS (compression 'zstd') "
                  f"PARTITIONED BY ({part}) CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{folder}'")
        spark.catalog.recoverPartitions(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` exchanged into the table's buckets."""
        return rows.repartition(self.buckets, *self.keys)

    def put(self, rows: DataFrame, value: str) -> None:
        """Replace the partition ``value``, one file a bucket; the others stay."""
        columns = ", ".join(c for c in self.read().columns if c != self.part)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({self.part} = '{value}') SELECT {columns} FROM {{rows}}",
                       rows=self.dealt(rows))
        self.spark.catalog.refreshTable(self.name)

    def only(self, value: str) -> DataFrame:
        return self.read().filter(F.col(self.part) == value)
