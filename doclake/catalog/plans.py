"""Planning queries: range plan, price plan, winery plan, last page, resume
plan, plan report, backlog, round robin, request plan.

Stand-ins: order keys are wine ids; finished wines are orders with status F
(read back through the run log), 404 wineries are orders with status P,
saved review pages are (order, line number) pairs given as file names."""

from __future__ import annotations

from pyspark.sql import functions as F

from doclake.catalog import register
from doclake.catalog.docs import WINERY_SQL
from doclake.catalog.lines import run_log_lines, work_list_lines
from doclake.catalog.render import wines_docs
from doclake.operators.flatten import winery_info
from doclake.operators.indexing import round_robin
from doclake.plans import planning as P
from doclake.plans.bitmaps import backlog_counts, id_range_minus
from doclake.plans.requests import BASE_URL, prices_request, reviews_request, wines_request, winery_request
from doclake.sources import lines as L
from doclake.sources.tables import Tables


@register("range_plan", """
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) + 100 AS hi FROM orders),
r AS (SELECT unnest(generate_series(lo, hi)) AS id FROM b)
SELECT id FROM r
WHERE id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
  AND id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
""")
def q_range_plan(spark, root):
    o = Tables(spark, root).orders
    lo, hi = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    saved = o.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("id"))
    not_found = o.filter(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("id"))
    return P.range_plan(spark, int(lo), int(hi) + 100, saved, not_found)


def finished(spark, root):
    return L.parse_success_log(run_log_lines(spark, root)).select("wine_id")


def price_work(spark, root):
    return L.parse_work_list(work_list_lines(spark, root))


PRICE_PLAN_SQL = """
SELECT DISTINCT CAST(l_orderkey AS INTEGER) AS wine_id,
       CAST(l_partkey AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR) AS vintage_ids,
       l_partkey, l_suppkey
FROM lineitem WHERE (l_orderkey + l_linenumber) % 8 >= 5
  AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
"""


def price_plan(spark, root):
    saved = (Tables(spark, root).orders.filter(F.col("o_orderstatus") == "F")
             .select(F.col("o_orderkey").cast("int").alias("wine_id")))
    return P.minus_saved(price_work(spark, root), saved, "wine_id")


@register("price_plan", f"SELECT wine_id, vintage_ids FROM ({PRICE_PLAN_SQL})")
def q_price_plan(spark, root):
    return price_plan(spark, root).select("wine_id", F.array_join("vintage_ids", ",").alias("vintage_ids"))


@register("winery_plan", f"""
SELECT * FROM ({WINERY_SQL}) w
WHERE winery_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
""")
def q_winery_plan(spark, root):
    saved_html = (Tables(spark, root).supplier.filter(F.col("s_acctbal") > 0)
                  .select(F.col("s_suppkey").cast("int").alias("winery_id")))
    return P.minus_saved(winery_info(wines_docs(spark, root)), saved_html, "winery_id", distinct=False)


def saved_page_names(spark, root):
    """Saved review page names: one per (order, line), plus price-file names
    as noise."""
    t = Tables(spark, root)
    pages = t.lineitem.select(F.format_string("wine-%d-reviews-page-%d-.json", "l_orderkey",
                                              "l_linenumber").alias("file_name"))
    noise = t.orders.select(F.format_string("wine-%d-prices-.json", "o_orderkey").alias("file_name"))
    return pages.unionByName(noise)


def last(spark, root):
    return P.last_pages(P.page_names(saved_page_names(spark, root)))


@register("last_page", """
SELECT CAST(l_orderkey AS INTEGER) AS wine_id, max(l_linenumber) AS last_page
FROM lineitem GROUP BY l_orderkey
""")
def q_last_page(spark, root):
    return last(spark, root)


def resume_work(spark, root):
    """Work list of all orders: ``<order>=<customer>`` lines, parsed."""
    o = Tables(spark, root).orders
    lines = L.format_work_list(o.select(F.col("o_orderkey").alias("wine_id"),
                                        F.array(F.col("o_custkey")).alias("vintage_ids")))
    return L.parse_work_list(lines)


RESUME_CTE = """
w AS (SELECT DISTINCT CAST(o_orderkey AS INTEGER) AS wine_id, CAST(o_custkey AS VARCHAR) AS vintage_ids
      FROM orders),
done AS (SELECT o_orderkey AS wine_id FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 5 <> 0),
last AS (SELECT l_orderkey AS wine_id, max(l_linenumber) AS last_page FROM lineitem GROUP BY l_orderkey)
"""


@register("resume_plan", f"""
WITH {RESUME_CTE}
SELECT w.wine_id, w.vintage_ids, last.last_page + 1 AS start_page
FROM w JOIN last ON w.wine_id = last.wine_id
WHERE w.wine_id NOT IN (SELECT wine_id FROM done)
UNION ALL
SELECT w.wine_id, w.vintage_ids, 1 AS start_page FROM w
WHERE w.wine_id NOT IN (SELECT wine_id FROM done) AND w.wine_id NOT IN (SELECT wine_id FROM last)
""")
def q_resume_plan(spark, root):
    plan = P.resume_plan(resume_work(spark, root), finished(spark, root), last(spark, root))
    return plan.select("wine_id", F.array_join("vintage_ids", ",").alias("vintage_ids"), "start_page")


@register("plan_report", f"""
WITH {RESUME_CTE},
listed AS (SELECT o_orderkey AS wine_id, count(*) AS n_rows FROM orders GROUP BY o_orderkey),
d AS (SELECT DISTINCT wine_id, true AS is_done FROM done),
wh AS (SELECT wine_id, true AS in_wh FROM last),
s AS (SELECT * FROM listed FULL JOIN d USING (wine_id) FULL JOIN wh USING (wine_id))
SELECT CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS n_list_rows,
       count(*) FILTER (WHERE n_rows IS NOT NULL) AS n_list_ids,
       count(*) FILTER (WHERE coalesce(is_done, false)) AS n_done,
       count(*) FILTER (WHERE coalesce(in_wh, false)) AS n_in_warehouse,
       count(*) FILTER (WHERE coalesce(in_wh, false) AND NOT coalesce(is_done, false)) AS n_errors,
       count(*) FILTER (WHERE n_rows IS NOT NULL AND coalesce(in_wh, false)
                        AND NOT coalesce(is_done, false)) AS n_to_resume,
       count(*) FILTER (WHERE n_rows IS NOT NULL AND NOT coalesce(in_wh, false)
                        AND NOT coalesce(is_done, false)) AS n_untouched
FROM s
""")
def q_plan_report(spark, root):
    return P.plan_report(resume_work(spark, root), finished(spark, root), last(spark, root))


@register("backlog_stats", """
WITH listed AS (SELECT l_orderkey AS wine_id FROM lineitem WHERE (l_orderkey + l_linenumber) % 8 >= 5),
saved AS (SELECT o_orderkey AS wine_id FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 5 <> 0)
SELECT (SELECT count(*) FROM listed) AS rows_to_load,
       (SELECT count(*) FROM saved) AS rows_saved,
       (SELECT count(*) FROM (SELECT wine_id FROM listed EXCEPT SELECT wine_id FROM saved)) AS distinct_not_loaded
""")
def q_backlog_stats(spark, root):
    return P.backlog_stats(price_work(spark, root).select("wine_id"), finished(spark, root))


@register("backlog_bitmaps", """
WITH listed AS (SELECT l_orderkey AS wine_id FROM lineitem WHERE (l_orderkey + l_linenumber) % 8 >= 5),
saved AS (SELECT o_orderkey AS wine_id FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 5 <> 0)
SELECT (SELECT count(*) FROM listed) AS rows_to_load,
       (SELECT count(*) FROM saved) AS rows_saved,
       (SELECT count(*) FROM (SELECT wine_id FROM listed EXCEPT SELECT wine_id FROM saved)) AS distinct_not_loaded
""")
def q_backlog_bitmaps(spark, root):
    """The backlog from bitmaps of the listed and the saved ids."""
    return backlog_counts(price_work(spark, root).select("wine_id"), finished(spark, root))


@register("range_bitmaps", """
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) + 100 AS hi FROM orders),
r AS (SELECT unnest(generate_series(lo, hi)) AS id FROM b)
SELECT id FROM r
WHERE id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
  AND id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
""")
def q_range_bitmaps(spark, root):
    """The range plan from bitmaps of the saved and the 404 ids."""
    o = Tables(spark, root).orders
    lo, hi = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    taken = [o.filter(F.col("o_orderstatus") == s).select(F.col("o_orderkey").alias("id")) for s in ("F", "P")]
    return id_range_minus(spark, int(lo), int(hi) + 100, *taken)


@register("round_robin", """
WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders),
n AS (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS nidx, count(*) OVER () AS cnt FROM nation)
SELECT o.o_orderkey, n.n_name FROM o JOIN n ON o.idx % n.cnt = n.nidx
""")
def q_round_robin(spark, root):
    t = Tables(spark, root)
    out = round_robin(t.orders.select("o_orderkey"), ["o_orderkey"],
                      t.nation.select("n_nationkey", "n_name"), ["n_nationkey"])
    return out.select("o_orderkey", "n_name")


@register("request_plan", f"""
WITH pp AS ({PRICE_PLAN_SQL}),
o AS (SELECT *, row_number() OVER (ORDER BY wine_id, vintage_ids) - 1 AS idx FROM pp),
n AS (SELECT n_name, n_nationkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS nidx,
             count(*) OVER () AS cnt FROM nation)
SELECT o.wine_id, n.n_name AS proxy_host, n.n_nationkey + 8000 AS proxy_port,
       '{BASE_URL}/api/prices?vintage_ids[]=' || CAST(l_partkey AS VARCHAR)
       || '&vintage_ids[]=' || CAST(l_suppkey AS VARCHAR) AS url
FROM o JOIN n ON o.idx % n.cnt = n.nidx
""")
def q_request_plan(spark, root):
    plan = (price_plan(spark, root)
            .withColumn("ids_text", F.array_join("vintage_ids", ","))
            .withColumn("url", prices_request("vintage_ids")))
    proxies = Tables(spark, root).nation.select(
        F.col("n_name").alias("proxy_host"), "n_nationkey", (F.col("n_nationkey") + 8000).alias("proxy_port"))
    out = round_robin(plan, ["wine_id", "ids_text"], proxies, ["n_nationkey"])
    return out.select("wine_id", "proxy_host", "proxy_port", "url")


@register("request_forms", f"""
SELECT s_suppkey, '{BASE_URL}/api/wineries/' || CAST(s_suppkey AS VARCHAR) || '/wines?start_from='
         || CAST(s_nationkey AS VARCHAR) || '&limit=50' AS wines_url,
       '{BASE_URL}/api/wines/' || CAST(s_suppkey AS VARCHAR) || '/reviews?page=' || CAST(s_nationkey + 1 AS VARCHAR) AS reviews_url,
       '{BASE_URL}/wineries/' || lower(s_name) AS winery_url
FROM supplier
""")
def q_request_forms(spark, root):
    s = Tables(spark, root).supplier
    return s.select("s_suppkey", wines_request(F.col("s_suppkey"), F.col("s_nationkey"), F.lit(50)).alias("wines_url"),
                    reviews_request(F.col("s_suppkey"), F.col("s_nationkey") + 1).alias("reviews_url"),
                    winery_request(F.lower("s_name")).alias("winery_url"))
