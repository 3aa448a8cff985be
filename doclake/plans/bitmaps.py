"""Sets of 32-bit ids as bitmaps: one binary of 4 KB per 32,768 consecutive ids.

Tasks fold their ids into bitmaps before anything is exchanged, so a set costs
one row per touched bucket and task, not one per id; union, difference and
counts then work on buckets. Meant for ids that lie densely, as ids handed out
by a counter do; ids far apart cost one bitmap each. A NULL id is in no set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 1 << 15  # ids in one bucket, as Spark's bitmap functions have it


def id_bitmaps(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """``(bucket, bits)`` of the distinct ids."""
    c = F.col(id_col).cast("long")
    return (ids.filter(c.isNotNull()).groupBy(F.shiftright(c, 15).alias("bucket"))
            .agg(F.bitmap_construct_agg(c.bitwiseAND(F.lit(BITS - 1).cast("long"))).alias("bits")))


def union(*sets: DataFrame) -> DataFrame:
    """``(bucket, bits)`` of the ids that are in any of the sets."""
    both = sets[0]
    for s in sets[1:]:
        both = both.unionByName(s)
    return both.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def size(bitmaps: DataFrame) -> DataFrame:
    """One row: ``n``, the number of ids."""
    return bitmaps.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("n"))


def _is_set(position: Column) -> Column:
    byte = F.conv(F.hex(F.substring("bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def id_range_minus(spark: SparkSession, start: int, stop: int, *exclude: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids of ``[start, stop]`` (inclusive) in none of the ``exclude`` sets
    (id DataFrames, one column ``id_col``): the same rows as
    :func:`doclake.plans.planning.range_plan`. Buckets, not ids, are joined;
    the range's ids are made in the tasks that hold their bucket."""
    buckets = spark.range(start >> 15, (stop >> 15) + 1).withColumnRenamed("id", "bucket")
    if exclude:
        taken = union(*[id_bitmaps(e.select(F.col(id_col).alias("id"))) for e in exclude])
        buckets = buckets.join(taken, "bucket", "left")
    else:
        buckets = buckets.withColumn("bits", F.lit(None).cast("binary"))
    ids = (buckets.select("bucket", "bits", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("position"))
           .filter(F.col("bits").isNull() | ~_is_set(F.col("position"))))
    return (ids.select((F.col("bucket") * BITS + F.col("position")).alias(id_col))
            .filter(F.col(id_col).between(start, stop)))


def backlog_counts(listed: DataFrame, saved: DataFrame, key: str = "wine_id") -> DataFrame:
    """The numbers of :func:`doclake.plans.planning.backlog_stats` from
    bitmaps: rows of both inputs, and |listed minus saved| as
    |listed or saved| - |saved|. A NULL key counts as a row, and as one
    distinct id if only the listed side has it, as in ``EXCEPT DISTINCT``."""
    def side(df: DataFrame, name: str) -> DataFrame:
        c = F.col(key).cast("long")
        return (df.groupBy(F.shiftright(c, 15).alias("bucket"))
                .agg(F.bitmap_construct_agg(c.bitwiseAND(F.lit(BITS - 1).cast("long"))).alias("bits"),
                     F.count(F.lit(1)).alias("rows")).withColumn("side", F.lit(name)))
    both = side(listed, "l").unionByName(side(saved, "s"))
    of = lambda s, x: F.when(F.col("side") == s, x)
    per = both.groupBy("bucket").agg(
        F.sum(of("l", F.col("rows"))).alias("l"), F.sum(of("s", F.col("rows"))).alias("s"),
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("any"),
        F.sum(of("s", F.bitmap_count("bits"))).alias("saved"))
    null_only = F.col("bucket").isNull() & F.col("l").isNotNull() & F.col("s").isNull()
    left = F.when(null_only, F.lit(1)).when(F.col("bucket").isNotNull(), F.col("any") - F.coalesce("saved", F.lit(0)))
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per.agg(n("l").alias("rows_to_load"), n("s").alias("rows_saved"), n(left).alias("distinct_not_loaded"))
