"""Splittable scan of quoted TSV records that hold line breaks.

A line break is part of a field if an odd number of quotes stands before it in
the file. The files are cut into physical lines by any number of tasks; quotes
per line and split, prefix sums over the splits (one small row each) and a
running sum within a split tell for every line whether it begins a record.
Lines that are a record by themselves, nearly all, stay where they are; only
the pieces of broken records are exchanged and joined. Records are parsed by
``from_csv``, with the rules of the multi-line reader.

Quotes are expected where the TSV sink writes them: around fields, doubled
within. The files need not be cut alike by two scans: lines are read once, into
a stored copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from doclake.functions.values import typed
from doclake.session import scratch_path
from doclake.sinks.tsv import TSV_OPTIONS

SPLIT = ["file_path", "blk"]


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file_path, blk, mid, value, quotes)``, stored: lines between LF, the
    split that holds them, and their order in it. A CR stays in the value."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("blk"),
        F.monotonically_increasing_id().alias("mid"), "value",
        F.length(F.regexp_replace("value", '[^"]', "")).alias("quotes"))
    stored = scratch_path(spark, "physical-lines")
    lines.write.parquet(stored)
    return spark.read.schema(lines.schema).parquet(stored)


def _running(df: DataFrame, what: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``what`` over the lines before this one in its
    file. Sums per split, prefix sums over the splits of a file, a running
    sum within each split (bounded by the split's size)."""
    per_split = df.groupBy(*SPLIT).agg(F.sum(what).alias("_s"))
    before = Window.partitionBy("file_path").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_split.select(*SPLIT, F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy(*SPLIT).orderBy("mid").rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn(name, F.coalesce(F.sum(what).over(within), F.lit(0)))
            .join(offsets, SPLIT).withColumn(name, F.col(name) + F.col("_off")).drop("_off"))


def numbered_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file_path, record_no, record)``: the records of each file, numbered
    from 0; line breaks within a record as they stand in the file. A last
    record whose quote is never closed reaches to the file's end."""
    lines = _running(physical_lines(spark, path), "quotes", "_q")
    begins = (F.col("_q") % 2 == 0)
    lines = _running(lines.withColumn("_b", begins.cast("int")), "_b", "_n")
    stored = scratch_path(spark, "record-lines")  # used twice below
    whole = F.col("_b").cast("boolean") & (F.col("quotes") % 2 == 0)
    lines.select("file_path", "blk", "mid", "value", (F.col("_n") + F.col("_b") - 1).alias("record_no"),
                 whole.alias("whole")).write.parquet(stored)
    lines = spark.read.parquet(stored)
    alone = lines.filter("whole").select("file_path", "record_no", F.col("value").alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("blk", "mid", "value")))
    joined = (lines.filter("not whole").groupBy("file_path", "record_no").agg(pieces.alias("p"))
              .select("file_path", "record_no", F.concat_ws("\n", F.col("p.value")).alias("record")))
    return alone.unionByName(joined)


def read_quoted_tsv(spark: SparkSession, path: str, ddl: str, header: bool = True, crlf: bool = False) -> DataFrame:
    """Like :func:`doclake.sources.tsv.read_tsv` with ``multiline=True``, but a
    file is shared among tasks. ``crlf``: records end with CR LF. Empty
    records are left out."""
    target = _parse_datatype_string(ddl)
    assert isinstance(target, StructType)
    raw = StructType([StructField(f.name, StringType(), True) for f in target.fields])
    records = numbered_records(spark, path)
    if header:
        records = records.filter("record_no > 0")
    record = F.regexp_replace("record", "\r$", "") if crlf else F.col("record")
    options = {**{k: v for k, v in TSV_OPTIONS.items() if k != "lineSep"}, "multiLine": "true", "maxCharsPerColumn": "-1"}
    parsed = (records.select(record.alias("record")).filter("record <> ''")
              .select(F.from_csv("record", raw.simpleString()[len("struct<"):-1].replace(":", " "), options).alias("r")))
    return parsed.select(*[
        (F.col(f"r.`{f.name}`") if isinstance(f.dataType, StringType)
         else typed(F.col(f"r.`{f.name}`"), f.dataType)).alias(f.name) for f in target.fields])
