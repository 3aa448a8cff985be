"""Exact dedup against a persistent index of digests.

The index is a stored table (digest, keep_id, keep_row), bucketed and sorted
by the SHA-256 of the normalised text and partitioned by wave. A wave of new
rows is reduced to one row per digest, dealt into the index's buckets and
anti-joined with the index by sorting: the index itself is never exchanged.
What is left is new and is appended. A second table of the same buckets
counts the rows seen per digest and wave. A wave that is run again replaces
its own partition, so a broken run is repeated without harm. Native functions
only.

Defined cases: a null text counts as empty; equal texts are those whose
digests agree after every run of blanks and 0x09-0x0D became one blank (runs
at the ends, too); of equal texts the smallest doc_id of the first wave that
holds them stays, null ids last; of repeated rows with that id exactly one
stays; other columns are ignored by the decision and kept by ``keep_new``.
Waves are never joined by a row's position, so an index outlives its session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.llm.bucketed import BucketedTable
from doclake.llm.common import shared_folder, text_or_empty, write_table
from doclake.llm.groups import join_groups

BLANKS = r"[\x20\x09-\x0D]+"


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the normalised text in UTF-8."""
    return F.unhex(F.sha2(F.regexp_replace(text_or_empty(text), BLANKS, " "), 256))


def digest_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, row, digest) of every row, stored: the texts are read once."""
    return write_table(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text_digest().alias("digest")),
                       "dd-rows")


class DigestIndex:
    """Two bucketed tables below ``path`` (a folder on shared storage).

    ``buckets`` is fixed when the index is made; an index that exists is
    opened again, by any later session, with the number it was made with.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, id_type: str = "bigint"):
        make = lambda name, columns: BucketedTable(
            spark, f"{path.rstrip('/')}/{name}", f"digest BINARY, {columns}", ["digest"], buckets, "wave")
        self.digests = make("digests", f"keep_id {id_type}, keep_row BIGINT")
        self.sightings = make("sightings", "n BIGINT")

    def add(self, rows: DataFrame, wave: str) -> None:
        """Append what is new among ``rows`` (doc_id, row, digest) under the wave's name."""
        first = F.min(F.struct(F.col("doc_id").isNull().alias("u"), "doc_id", "row")).alias("r")
        groups = write_table(rows.groupBy("digest").agg(first, F.count(F.lit(1)).alias("n"))
                             .select("digest", "n", F.col("r.doc_id").alias("keep_id"), F.col("r.row").alias("keep_row")), "dd-groups")
        known = self.digests.read().filter(F.col("wave") != wave).select("digest").hint("merge")
        new = self.digests.dealt(groups).join(known, "digest", "left_anti")
        self.digests.put(write_table(new, "dd-new"), wave)  # stored: a table cannot be read and replaced at once
        self.sightings.put(groups, wave)

    def figures(self) -> DataFrame:
        """(digest, keep_id, keep_row, wave, group_size) of all that was seen; no exchange."""
        sizes = self.sightings.read().groupBy("digest").agg(F.sum("n").alias("group_size"))
        return self.digests.read().hint("merge").join(sizes, "digest")

    def decisions(self, rows: DataFrame, wave: Column) -> DataFrame:
        """``rows`` with keep_id, group_size and kept; ``wave`` names the wave of a row."""
        f = self.figures().withColumnRenamed("wave", "keep_wave")
        total = self.sightings.read().agg(F.sum("n")).first()[0] or 0
        return (join_groups(rows, f, "digest", "group_size", total)
                .withColumn("kept", (F.col("row") == F.col("keep_row")) & (wave == F.col("keep_wave")))
                .drop("keep_row", "keep_wave"))


def keep_new(index: DigestIndex, docs: DataFrame, wave: str) -> DataFrame:
    """Add a wave and return its rows that stay, with all their columns."""
    stored = write_table(docs.withColumn("__row", F.monotonically_increasing_id()), "dd-docs")
    rows = stored.select("doc_id", F.col("__row").alias("row"), text_digest().alias("digest"))
    index.add(rows, wave)
    mine = index.digests.only(wave).select(F.col("keep_row").alias("__row"))
    return stored.join(mine, "__row", "left_semi").drop("__row")


def exact_groups(docs: DataFrame, waves: int = 4, bucket_rows: int = 1_000_000) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row, through a new index.

    The rows go in as waves of ascending ids, so that the smallest id of all
    waves is the one that stays. The waves' bounds are approximate quantiles;
    any bounds give the same result.
    """
    spark = docs.sparkSession
    rows = digest_rows(docs)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // bucket_rows))
    index = DigestIndex(spark, shared_folder(spark, "dd-index"), buckets, rows.schema["doc_id"].dataType.simpleString())
    cut = rows.agg(F.percentile_approx("doc_id", [i / waves for i in range(1, waves)], 1000)).first()[0] or []
    cut = sorted(set(cut))
    # rows above i of the bounds are wave i; rows without an id come last
    number = sum((F.coalesce(F.col("doc_id") > c, F.lit(True)).cast("int") for c in cut), F.lit(0))
    wave = F.concat(F.lit("w"), number.cast("string"))
    for i in range(len(cut) + 1):
        index.add(rows.filter(number == i), f"w{i}")
    return (index.decisions(rows, wave)
            .select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")))


def op13_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: groups of equal texts over all documents."""
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
    row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY doc_id NULLS LAST)
"""
