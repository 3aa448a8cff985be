"""Helpers shared by the training-data operators.

Intermediate tables are written as Parquet below ``spark.checkpoint.dir``
(read from the session), which driver and executors share: a lost executor
loses nothing that a later step needs.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.session import checkpoint_root, scratch_path, shuffles_removed

# Character sets of the word definitions.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def write_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark resolves it to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint root, as a qualified URI."""
    return qualified(spark, f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}")


def open_folder(uri: str):
    """(file system, path) for use in tasks; any store that Arrow reaches."""
    from pyarrow import fs
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parsed.path)
    return fs.FileSystem.from_uri(uri)


class AtomicFile:
    """A file in a shared folder that appears under its name only when whole.

    Every attempt of a task writes a name of its own and moves it at the end,
    so a retried or speculative task never leaves a torn file.
    """

    def __init__(self, folder: str, name: str):
        self.fs, base = open_folder(folder)
        self.fs.create_dir(base, recursive=True)
        self.name = name
        self.final = f"{base}/{name}"
        self.attempt = f"{base}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.attempt, compression=None)

    def write(self, data: bytes) -> None:
        self.out.write(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.attempt, self.final)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def rows_per_task(df: DataFrame, rows: int) -> int:
    """Partitions that hold about ``rows`` rows each (at least the session's)."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))


def ascii_lower(c: Column) -> Column:
    """Lower case for A-Z alone."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): root is the smallest node reachable over ``edges`` (a, b).

    Alternates the large-star and small-star steps until the edge set is a
    forest of stars. Minima are partial aggregates and are stored before they
    are joined back, so both join sides are plain shuffles that AQE can split
    when one node has a large share of all edges. Null ends are ignored.
    """
    e = write_table(edges.filter("a is not null and b is not null and a <> b")
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    for _ in range(max_rounds):
        if _is_forest_of_stars(e):
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        both = e.union(e.select(F.col("b"), F.col("a")))
        low = write_table(both.groupBy("a").agg(F.min("b").alias("m"))
                          .select("a", F.least("a", "m").alias("m")), "cc-low")
        # from here on a hub is the smaller end of its edges, never the key
        large = (both.filter("b > a").join(low, "a").filter("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a")
        e = write_table(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                        .union(low2.select("a", F.col("m").alias("b"))).distinct(), "cc-edges")
    raise RuntimeError("components did not settle")


def _is_forest_of_stars(e: DataFrame) -> bool:
    """Every node points to one smaller node, which points to none."""
    several = e.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a")
    chained = e.join(e.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
    return several.union(chained).isEmpty()
