"""A table with one row per key that grows by inserts.

Rows lie in partitions by key hash, and within them by batch. An insert reads
the keys of only those partitions that the batch's keys fall into, and writes
its rows as the batch's own partitions by dynamic overwrite: a batch that is
inserted again, after a break or by mistake, finds the table as it was before
it, takes the same decision and replaces its own files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.session import scratch_path
from doclake.sinks.files import flag_present
from doclake.storage import path_exists

PART, BATCH = "_part", "_batch"


class KeyedTable:
    """The table at ``path``, unique by ``key``. ``parts`` (a bounded number,
    about one per 256 MB expected) is fixed when the table is made."""

    def __init__(self, spark: SparkSession, path: str, key: str, parts: int = 64):
        self.spark, self.path, self.key, self.parts = spark, path, key, parts

    def read(self) -> DataFrame | None:
        """The table with its partition columns, or None before the first insert."""
        return self.spark.read.parquet(self.path) if path_exists(self.spark, self.path) else None

    def known(self, touched: list[int], batch_id: str) -> DataFrame | None:
        """Keys of the touched partitions, but for the batch's own: a scan of
        one column, pruned to these partitions."""
        table = self.read()
        if table is None:
            return None
        return table.filter(F.col(PART).isin(touched) & (F.col(BATCH) != batch_id)).select(self.key, PART)

    def insert(self, batch: DataFrame, batch_id: str, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
        """Insert the rows of ``batch`` whose key is new; (inserted, rejected).

        Of several rows with one key the first by ``order`` (default: all
        columns) is inserted, of equal rows one; a NULL key is rejected."""
        cols = batch.columns
        part = F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.parts)).cast("int")
        stored = scratch_path(self.spark, "keyed-batch")
        batch.withColumn(PART, part).withColumn("_row", F.monotonically_increasing_id()).write.parquet(stored)
        tagged = self.spark.read.parquet(stored)
        # at most ``parts`` numbers
        touched = [r[0] for r in tagged.filter(F.col(self.key).isNotNull()).select(PART).distinct().collect()]
        staged = scratch_path(self.spark, "keyed-stage")
        flag_present(tagged, self.key, self.known(touched, batch_id), cols, order).write.parquet(staged)
        flagged = self.spark.read.parquet(staged)
        (flagged.filter(~F.col("_present")).drop("_present").withColumn(BATCH, F.lit(batch_id)).hint("rebalance", PART)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART, BATCH).parquet(self.path))
        return (flagged.filter(~F.col("_present")).select(*cols), flagged.filter(F.col("_present")).select(*cols))
