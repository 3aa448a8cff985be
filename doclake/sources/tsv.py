"""Typed scan of TSV tables: read every field as text, then convert each
column to its declared type with ``try_cast`` (an empty field or a value
that does not convert gives NULL, the row is kept)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from doclake.functions.values import typed
from doclake.sinks.tsv import TSV_OPTIONS


def read_tsv(spark: SparkSession, path: str, ddl: str, header: bool = True,
             multiline: bool = False, line_sep: str | None = "\n") -> DataFrame:
    """``ddl``: ``"name type, ..."`` in column order. Large files are split
    among tasks. ``multiline`` allows quoted fields with line breaks; each
    file is then read whole by one task. Lines end with ``line_sep``; pass
    ``"\\r\\n"`` for files of other tools (None lets Spark guess, which can
    take a break inside a field for a line end)."""
    target = _parse_datatype_string(ddl)
    assert isinstance(target, StructType)
    raw_schema = StructType([StructField(f.name, StringType(), True) for f in target.fields])
    opts = {k: v for k, v in TSV_OPTIONS.items() if k != "lineSep"}
    if line_sep is not None:
        opts["lineSep"] = line_sep
    raw = (spark.read.options(**opts).option("header", str(header).lower())
           .option("multiLine", str(multiline).lower()).option("mode", "PERMISSIVE")
           .schema(raw_schema).csv(path))
    return raw.select(*[
        (F.col(f"`{f.name}`") if isinstance(f.dataType, StringType)
         else typed(F.col(f"`{f.name}`"), f.dataType)).alias(f.name)
        for f in target.fields])


def read_tsv_text(spark: SparkSession, path: str, columns: list[str], **options) -> DataFrame:
    """All-text scan: every column as string, no conversion."""
    return read_tsv(spark, path, ", ".join(f"`{c}` string" for c in columns), **options)
