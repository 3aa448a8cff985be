"""Work planning by set algebra over ids: what to fetch next, where to
resume, and the reports about it.

All inputs are DataFrames of ids (from file names, logs, work lists); every
"minus" is a left anti join and every "in" a left semi join, so no id set is
ever collected to the driver (the catalogue's planner held them in memory).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.operators.flatten import REVIEWS_FILE_RE


def range_plan(spark: SparkSession, start: int, stop: int, *exclude: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids of ``[start, stop]`` (inclusive) not present in any ``exclude``
    DataFrame (each with one id column named ``id_col``)."""
    ids = spark.range(start, stop + 1).withColumnRenamed("id", id_col)
    for ex in exclude:
        ids = ids.join(ex.select(F.col(id_col).cast("bigint").alias(id_col)), id_col, "left_anti")
    return ids


def minus_saved(items: DataFrame, saved_ids: DataFrame, key: str, distinct: bool = True) -> DataFrame:
    """Work items whose ``key`` is not among ``saved_ids``; ``distinct``
    de-duplicates the items on all their columns first (a work item is the
    pair of id and its list, not the id alone)."""
    base = items.distinct() if distinct else items
    return base.join(saved_ids.select(key), key, "left_anti")


def page_names(file_names: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Review page file names -> ``(wine_id, page)``; other names skipped."""
    n = F.col(name_col)
    # one anchored match validates the name; the numbers are then at fixed
    # places of ``wine-<id>-reviews-page-<page>[-].json`` split on '-' (a
    # one-character split, no regex), cheaper than one capture per field
    parts = F.split(n, "-")
    vals = F.struct(F.get(parts, 1).try_cast("int").alias("wine_id"),
                    F.substring_index(F.get(parts, 4), ".", 1).try_cast("int").alias("page"))
    # the values are materialised (one-element explode) before the range
    # filter, which cannot then be pushed below and recompute them
    return (file_names.filter(n.rlike(REVIEWS_FILE_RE)).select(vals.alias("v"))
            .select(F.explode(F.array("v")).alias("r"))
            .filter(F.col("r.wine_id").isNotNull() & F.col("r.page").isNotNull())
            .select("r.wine_id", "r.page"))


def last_pages(pages: DataFrame) -> DataFrame:
    """Highest saved page per wine (partial max per task, then merged)."""
    return pages.groupBy("wine_id").agg(F.max("page").alias("last_page"))


def resume_plan(work: DataFrame, done_ids: DataFrame, last: DataFrame) -> DataFrame:
    """Where to start fetching each work item ``(wine_id, vintage_ids)``.

    * wines with saved pages but not finished restart after their last page;
    * wines neither finished nor saved start at page 1;
    * finished wines are not planned.
    Output: the work item columns plus ``start_page``.

    One status row per wine (finished ids outer-joined to the last saved
    pages) is left-joined to the distinct work items, so every input is read
    once."""
    status = (done_ids.select("wine_id").distinct().withColumn("_done", F.lit(True))
              .join(last.select("wine_id", "last_page"), "wine_id", "full"))
    cols = work.columns
    return (work.distinct().join(status, "wine_id", "left")
            .filter(F.col("_done").isNull())
            .select(*cols, F.coalesce(F.col("last_page") + 1, F.lit(1)).alias("start_page")))


def plan_report(work: DataFrame, done_ids: DataFrame, last: DataFrame) -> DataFrame:
    """One row: list rows, distinct listed ids, finished ids, ids in the
    warehouse, ids with errors (saved, not finished), listed ids to resume,
    listed ids untouched. One status table per id (outer joins on the id),
    one aggregate."""
    listed = work.groupBy("wine_id").agg(F.count(F.lit(1)).alias("n_rows"))
    done = done_ids.select("wine_id").distinct().withColumn("is_done", F.lit(True))
    wh = last.select("wine_id").withColumn("in_wh", F.lit(True))
    s = listed.join(done, "wine_id", "full").join(wh, "wine_id", "full")
    is_listed = F.col("n_rows").isNotNull()
    is_done = F.coalesce("is_done", F.lit(False))
    in_wh = F.coalesce("in_wh", F.lit(False))
    return s.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_list_rows"),
        F.count_if(is_listed).alias("n_list_ids"),
        F.count_if(is_done).alias("n_done"),
        F.count_if(in_wh).alias("n_in_warehouse"),
        F.count_if(in_wh & ~is_done).alias("n_errors"),
        F.count_if(is_listed & in_wh & ~is_done).alias("n_to_resume"),
        F.count_if(is_listed & ~in_wh & ~is_done).alias("n_untouched"))


def backlog_stats(listed: DataFrame, saved: DataFrame, key: str = "wine_id") -> DataFrame:
    """Rows in the work list, rows in the saved log (each counted once) and
    the number of distinct listed ids not saved (EXCEPT DISTINCT).

    Both inputs are read once: their keys are tagged and united, counted per
    key (partial counts map-side, so a hot key costs one row per task), and
    one final aggregate derives the three numbers."""
    tagged = (listed.select(F.col(key).alias("_k"), F.lit(1).alias("_l"), F.lit(0).alias("_s"))
              .unionByName(saved.select(F.col(key).alias("_k"), F.lit(0).alias("_l"), F.lit(1).alias("_s"))))
    per_key = tagged.groupBy("_k").agg(F.sum("_l").alias("_nl"), F.sum("_s").alias("_ns"))
    return per_key.agg(
        F.coalesce(F.sum("_nl"), F.lit(0)).cast("bigint").alias("rows_to_load"),
        F.coalesce(F.sum("_ns"), F.lit(0)).cast("bigint").alias("rows_saved"),
        F.count_if((F.col("_nl") > 0) & (F.col("_ns") == 0)).alias("distinct_not_loaded"))
