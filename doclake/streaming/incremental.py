"""Incremental ingest of a folder of documents with Structured Streaming.

The file source's checkpoint records which files were already taken, so a
re-run picks up only files that arrived since (in place of listing the
folder and diffing it against logs). ``trigger(availableNow=True)`` processes
everything present in bounded micro-batches and stops: a batch job that
resumes where the previous run ended, and survives executor loss through
the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.packs import stream_packs

# A file is new when the checkpoint has not seen it, whatever its time: by
# default Spark skips files more than a week older than the newest one, which
# would lose copies that kept their times.
NO_AGE_LIMIT = "36500d"


def document_stream(spark: SparkSession, folder: str, name_regex: str | None = None,
                    max_files_per_trigger: int | None = None, packs: bool = False) -> DataFrame:
    """Streaming raw documents ``(file_name, body)`` of a folder: of its plain
    files, or (``packs``) of its packs (:mod:`doclake.packs`)."""
    options = {"maxFileAge": NO_AGE_LIMIT}
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if packs:
        df = stream_packs(spark, folder, **options)
    else:
        df = spark.readStream.options(**options).text(folder, wholetext=True).select(
            F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("body"))
    return df.filter(F.col("file_name").rlike(name_regex)) if name_regex else df


MAX_FILES_PER_BATCH = 100_000


def ingest_available(spark: SparkSession, folder: str, sink: str, checkpoint: str,
                     transform: Callable[[DataFrame], DataFrame], name_regex: str | None = None,
                     max_files_per_trigger: int | None = MAX_FILES_PER_BATCH, packs: bool = False) -> None:
    """Run ``transform`` over every document not yet ingested and append the
    rows to the parquet table ``sink``; returns when all available files are
    done. A backlog of any size is taken in micro-batches of at most
    ``max_files_per_trigger`` files, each committed to the checkpoint, so a
    run that is stopped resumes after the last committed batch."""
    rows = transform(document_stream(spark, folder, name_regex, max_files_per_trigger, packs))
    # Each micro-batch names its new files one by one; above a few dozen
    # paths Spark stats them with a parallel job of up to one task per file.
    # Bound that job to a few tasks per core for this run (the stream copies
    # the session's settings in its own thread), then restore the session.
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key, None)
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:
        cores = 64
    spark.conf.set(key, str(max(8, min(int(before or 10000), cores * 4))))
    try:
        q = (rows.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start(sink))
        q.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    if q.exception() is not None:
        raise q.exception()
