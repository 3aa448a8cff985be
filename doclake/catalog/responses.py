"""Captured-response queries: outcomes and timings, page runs, raw landing,
insert-if-absent.

Stand-ins: ``events`` are responses (event type ``error`` = exception, the
value picks the status and is the response time in seconds); distinct
(order, line number) pairs are fetched review pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from doclake.catalog import register
from doclake.catalog.docs import QUARANTINE_SQL
from doclake.catalog.render import review_docs
from doclake.operators import responses as R
from doclake.operators.flatten import REVIEWS_FILE_RE
from doclake.session import scratch_path
from doclake.sinks.files import insert_if_absent, land_raw
from doclake.sinks.keyed import KeyedTable
from doclake.sources.tables import Tables
from doclake.streaming.page_state import runs_from_blocks, stored_blocks, update_page_state


def captured_responses(spark, root):
    ev = Tables(spark, root).events
    v = F.col("value")
    status = (F.when(v < 100, 200).when(v < 150, 301).when(v < 200, 302).when(v < 300, 404).otherwise(503))
    return ev.select(
        F.col("user_id").alias("wine_id"), F.col("event_id").alias("page_no"),
        F.format_string("/api/wines/%d/reviews?page=%d", "user_id", "event_id").alias("url"),
        F.when(F.col("event_type") != "error", status).alias("status"),
        F.when((status == 301) & (F.col("event_type") != "error"),
               F.concat(F.lit("/moved/"), F.col("event_id").cast("string"))).alias("location"),
        F.when(F.col("event_type") == "error", F.lit("connection timed out")).alias("error"),
        F.col("ts").alias("requested_at"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), v.cast("decimal(18,6)"))).alias("received_at"),
        F.lit(None).cast("string").alias("body"))


@register("response_outcomes", """
WITH r AS (
  SELECT CASE WHEN event_type = 'error' THEN 'ERROR' WHEN value < 100 THEN 'OK'
              WHEN value < 150 THEN 'REDIRECT' WHEN value < 200 THEN 'NO_REDIRECTION_HEADER'
              ELSE 'BAD_RESPONSE' END AS outcome,
         (epoch_us(ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT))) - epoch_us(ts)) // 1000000 AS el
  FROM events)
SELECT outcome, count(*) AS n_responses, CAST(sum(el) AS BIGINT) AS sum_elapsed_s,
       CAST(max(el) AS BIGINT) AS max_elapsed_s
FROM r GROUP BY outcome
""")
def q_response_outcomes(spark, root):
    return R.outcome_counts(captured_responses(spark, root))


def fetched_pages(spark, root):
    li = Tables(spark, root).lineitem
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    state = (F.when((ok + 3 * ln) % 11 == 0, F.lit("failed"))
             .when((ok + ln) % 5 == 0, F.lit("empty")).otherwise(F.lit("ok")))
    return (li.select(ok.alias("wine_id"), ln.alias("page_no"), state.alias("state"))
            .unionByName(li.filter(ok % 7 == 0).select(ok.alias("wine_id"), ln.alias("page_no"),
                                                       F.when(ln % 2 == 0, F.lit("failed")).otherwise(F.lit("empty"))
                                                       .alias("state"))))


PAGE_RUNS_SQL = """
WITH c AS (SELECT l_orderkey AS wine_id, l_linenumber AS page_no,
             CASE WHEN (l_orderkey + 3 * l_linenumber) % 11 = 0 THEN 2
                  WHEN (l_orderkey + l_linenumber) % 5 = 0 THEN 1 ELSE 0 END AS w
           FROM lineitem
           UNION ALL
           SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE 1 END
           FROM lineitem WHERE l_orderkey % 7 = 0),
p AS (SELECT wine_id, page_no, CASE min(w) WHEN 0 THEN 'ok' WHEN 1 THEN 'empty' ELSE 'failed' END AS state
      FROM c GROUP BY wine_id, page_no),
s AS (SELECT DISTINCT wine_id, CASE WHEN wine_id % 3 = 0 THEN 2 ELSE 1 END AS start_page FROM p),
q AS (SELECT p.*, s.start_page FROM p JOIN s ON p.wine_id = s.wine_id WHERE p.page_no >= s.start_page),
r AS (SELECT *, row_number() OVER (PARTITION BY wine_id ORDER BY page_no) AS i FROM q),
b AS (SELECT wine_id, min(i) FILTER (WHERE page_no <> start_page + i - 1 OR state <> 'ok') AS ib,
             count(*) AS n FROM r GROUP BY wine_id),
f AS (SELECT b.*, r.page_no AS bp, r.state AS bs FROM b LEFT JOIN r ON r.wine_id = b.wine_id AND r.i = b.ib)
SELECT s.wine_id,
       CAST(coalesce(f.ib - 1, f.n, 0) AS INTEGER) AS kept_pages,
       coalesce(f.bp = s.start_page + f.ib - 1 AND f.bs = 'empty', false) AS finished,
       CAST(coalesce(f.ib - 1, f.n, 0) + s.start_page - 1 AS INTEGER) AS n_pages
FROM s LEFT JOIN f ON s.wine_id = f.wine_id
"""


def page_starts(pages):
    starts = (pages.select("wine_id").distinct()
              .withColumn("start_page", F.when(F.col("wine_id") % 3 == 0, 2).otherwise(1)))
    # wines divisible by 4 are planned twice, the second time two pages later
    again = starts.filter(F.col("wine_id") % 4 == 0).withColumn("start_page", F.col("start_page") + 2)
    return starts.unionByName(again)


@register("page_runs", PAGE_RUNS_SQL)
def q_page_runs(spark, root):
    pages = fetched_pages(spark, root)
    return R.page_runs(pages, page_starts(pages))


@register("page_runs_state", PAGE_RUNS_SQL)
def q_page_runs_state(spark, root):
    """The same runs from state that three landings of captures update."""
    pages = fetched_pages(spark, root).select("wine_id", F.col("page_no").cast("int").alias("page_no"), "state")
    folder, sink, checkpoint = (scratch_path(spark, n) for n in ("captures", "page-state", "page-state-ckpt"))
    for i in (2, 0, 1):
        pages.filter(F.pmod(F.xxhash64("wine_id", "page_no", "state"), F.lit(3)) == i).write.mode("append").parquet(folder)
        update_page_state(spark, folder, sink, checkpoint)
    return runs_from_blocks(stored_blocks(spark, sink), page_starts(pages))


LAND_SQL = QUARANTINE_SQL.split("SELECT CASE l_orderkey")[0].replace(
    "pg AS (SELECT DISTINCT b.l_orderkey,", "pg AS (SELECT b.l_orderkey,") + """
SELECT 'wine-' || CAST(l_orderkey AS VARCHAR) || '-reviews-page-' || CAST(page + 1 AS VARCHAR) || '-.json' AS file_name,
       CAST(l_orderkey AS INTEGER) AS key, CAST(page + 1 AS INTEGER) AS page,
       CAST(CASE l_orderkey % 10 WHEN 0 THEN NULL WHEN 1 THEN count(*) + 1 ELSE count(*) END AS INTEGER) AS n_elements
FROM pg GROUP BY l_orderkey, page
"""


@register("land_raw", LAND_SQL)
def q_land_raw(spark, root):
    path = scratch_path(spark, "landed-reviews")
    land_raw(review_docs(spark, root), path, REVIEWS_FILE_RE, page_group=2)
    return spark.read.parquet(path).select("file_name", "key", "page", "n_elements")


@register("insert_if_absent", """
SELECT o_orderkey, o_orderstatus, o_orderpriority,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 2 END AS batch
FROM orders
""")
def q_insert_if_absent(spark, root):
    o = Tables(spark, root).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = scratch_path(spark, "orders-table")
    insert_if_absent(spark, path, o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
                     .withColumn("batch", F.lit(1)), "o_orderkey")
    # the second batch offers every order, those of status O twice, and rows without a key
    late = o.unionByName(o.filter(F.col("o_orderstatus") == "O").withColumn("o_orderpriority", F.lit("9-LATER")))
    none = o.withColumn("o_orderkey", F.lit(None).cast("bigint"))
    insert_if_absent(spark, path, late.unionByName(none).withColumn("batch", F.lit(2)), "o_orderkey",
                     order=["o_orderpriority"])
    return spark.read.parquet(path)


@register("keyed_insert", """
SELECT o_orderkey, o_orderstatus, o_orderpriority, batch, n_rejected
FROM (SELECT o_orderkey, o_orderstatus, o_orderpriority, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'first' ELSE 'second' END AS batch
      FROM orders),
     (SELECT 2 * count(*) + count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS n_rejected FROM orders)
""")
def q_keyed_insert(spark, root):
    """Every order by two batches that overlap, the second one sent twice."""
    o = Tables(spark, root).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    table = KeyedTable(spark, scratch_path(spark, "keyed-orders"), "o_orderkey", parts=16)
    table.insert(o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")), "first")
    # every order twice, once with another priority, and rows without a key
    late = o.unionByName(o.withColumn("o_orderpriority", F.lit("9-LATER"))).unionByName(
        o.withColumn("o_orderkey", F.lit(None).cast("bigint")))
    for _ in range(2):
        _, rejected = table.insert(late, "second", order=["o_orderpriority"])
    return table.read().withColumnRenamed("_batch", "batch").drop("_part").withColumn("n_rejected", F.lit(rejected.count()))
