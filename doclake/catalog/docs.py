"""Document queries: flatteners, quarantine, winery records, work-list export,
run counters. Documents come from :mod:`doclake.catalog.render`; the oracle
SQL computes the same flat rows straight from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from doclake.catalog import register
from doclake.catalog.render import price_docs, review_docs, wines_docs
from doclake.operators import flatten as FL

# ----------------------------------------------------------------- shared SQL

REVIEWS_BASE_SQL = """
  SELECT l.*, o.o_orderpriority, c.*, p.*, s.*, n.*, r.*, l.l_orderkey % 10 AS kind
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
  LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
  LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
"""

WINES_PAGES_SQL = """
  b AS (
    SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
           l.l_extendedprice, l.l_shipdate, p.*, s.*, n.*, r.*, s.s_suppkey % 6 AS kind
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
    JOIN supplier s ON s.s_suppkey = l.l_suppkey
    LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
    LEFT JOIN region r ON r.r_regionkey = n.n_regionkey),
  c AS (SELECT l_suppkey, count(*) AS cnt FROM b GROUP BY l_suppkey),
  pg AS (SELECT b.*, (b.l_orderkey + b.l_linenumber + b.l_partkey) % CAST(ceil(c.cnt / 1000.0) AS BIGINT) AS page
         FROM b JOIN c ON b.l_suppkey = c.l_suppkey),
  nw AS (SELECT l_suppkey AS nw_supp, page AS nw_page, count(DISTINCT l_partkey) AS n_wines
         FROM pg GROUP BY l_suppkey, page)
"""

WINE_FILE_SQL = ("'wines-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(page AS VARCHAR) || '-' "
                 "|| CAST(n_wines AS VARCHAR) || '-.json'")

# ----------------------------------------------------------------- reviews

REVIEWS_SQL = rf"""
WITH b AS ({REVIEWS_BASE_SQL})
SELECT
  CAST(l_linenumber AS INTEGER) AS review_id,
  CAST(l_quantity AS FLOAT) AS rating,
  CASE WHEN l_quantity >= 10 THEN regexp_replace(
    l_returnflag || chr(9) || l_linestatus || chr(10) || o_orderpriority || ' ' || chr(13) || chr(11) || '.',
    '[\t\n\x0B\f\r ]', ' ', 'g') END AS note,
  c_mktsegment AS language,
  CAST(l_shipdate AS DATE) AS created_at,
  CAST(c_custkey AS INTEGER) AS user_id,
  lower(c_name) AS user_seo_name,
  c_name AS user_alias,
  c_mktsegment AS user_visblty,
  c_nationkey AS user_followers_count,
  CAST(trunc(c_acctbal) AS INTEGER) AS user_following_count,
  CAST(c_custkey AS INTEGER) AS user_ratings_count,
  CAST(l_partkey AS INTEGER) AS vintage_id,
  lower(p_brand) AS vintage_seo_name,
  CASE WHEN p_size % 10 = 0 THEN 'N.V.' ELSE CAST(p_size + 1990 AS VARCHAR) END AS vintage_year,
  p_name AS vintage_name,
  p_size AS vintge_stats_ratings_count,
  CAST(coalesce(p_retailprice, 0) AS FLOAT) AS vintge_stats_ratings_average,
  p_size * 2 AS vintge_stats_labels_count,
  CAST(l_suppkey AS INTEGER) AS vintge_wine_id,
  s_name AS vintge_wine_name,
  CASE WHEN s_nationkey < 13 THEN n_nationkey ELSE -1 END AS vintge_wine_region_id,
  CASE WHEN s_nationkey < 13 THEN n_name ELSE '' END AS vintge_wine_rgn_name,
  CASE WHEN s_nationkey < 13 THEN lower(substr(r_name, 1, 2)) ELSE '' END AS vintge_wine_rgn_cntry_code,
  CASE WHEN s_nationkey < 13 THEN r_name ELSE '' END AS vintge_wine_rgn_cntry_name,
  CASE WHEN l_linenumber = 1 THEN -1 ELSE TRY_CAST(l_orderkey AS INTEGER) END AS activity_id,
  CASE WHEN l_linenumber = 1 THEN -1 ELSE l_linenumber END AS activity_stats_likes_count,
  CASE WHEN l_linenumber = 1 THEN -1 ELSE CAST(round(l_tax * 100) AS INTEGER) END
    AS activity_stats_comments_count
FROM b WHERE kind >= 5
"""


@register("reviews_flatten", REVIEWS_SQL)
def q_reviews_flatten(spark, root):
    return FL.flatten_reviews(review_docs(spark, root))


QUARANTINE_SQL = """
WITH b AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
c AS (SELECT l_orderkey, count(*) AS cnt FROM b GROUP BY l_orderkey),
pg AS (SELECT DISTINCT b.l_orderkey,
         (b.l_linenumber + b.l_partkey) % CAST(ceil(c.cnt / 50.0) AS BIGINT) AS page
       FROM b JOIN c ON b.l_orderkey = c.l_orderkey)
SELECT CASE l_orderkey % 10 WHEN 0 THEN 'not_json' WHEN 1 THEN 'null_review'
            WHEN 2 THEN 'null_user' WHEN 3 THEN 'null_wine'
            WHEN 4 THEN 'null_activity_statistics' ELSE 'ok' END AS reason,
       count(*) AS n_docs
FROM pg GROUP BY 1
"""


@register("doc_quarantine", QUARANTINE_SQL)
def q_doc_quarantine(spark, root):
    q = FL.quarantine(review_docs(spark, root), "reviews")
    return (q.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n_docs")))


# ----------------------------------------------------------------- vintages

VINTAGES_SQL = f"""
WITH {WINES_PAGES_SQL}
SELECT
  CAST(p_partkey AS INTEGER) AS wine_id,
  p_name AS wine_name,
  CAST(trunc(p_size / 10.0) AS INTEGER) AS wine_type_id,
  CASE WHEN p_size <= 40 THEN n_nationkey END AS rgn__id,
  CASE WHEN p_size <= 40 THEN n_name END AS rgn__name,
  CASE WHEN p_size <= 40 THEN lower(n_name) END AS rgn__seo_name,
  CASE WHEN p_size <= 40 THEN lower(substr(r_name, 1, 2)) END AS rgn__cntry__code,
  CASE WHEN p_size <= 40 THEN r_name END AS rgn__cntry__name,
  CASE WHEN p_size <= 40 THEN r_regionkey END AS rgn__cntry__regions_count,
  CASE WHEN p_size <= 40 THEN r_regionkey * 1000 END AS rgn__cntry__users_count,
  CASE WHEN p_size <= 40 THEN n_nationkey * 10 END AS rgn__cntry__wines_count,
  CAST(NULL AS INTEGER) AS rgn__cntry__wineries_count,
  CAST(s_suppkey AS INTEGER) AS winery__id,
  s_name AS winery__name,
  lower(s_name) AS winery__seo_name,
  s_nationkey AS winery__stats__ratings_count,
  CAST(s_acctbal AS FLOAT) AS winery__stats__ratings_average,
  CAST(NULL AS INTEGER) AS winery__stats__wines_count,
  CASE WHEN p_size % 7 <> 0 THEN p_size END AS stats__ratings_count,
  CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 7 = 1 THEN CAST(0 AS FLOAT)
       ELSE CAST(p_retailprice AS FLOAT) END AS stats__ratings_average,
  CASE WHEN p_size % 7 NOT IN (0, 1) THEN p_size * 3 END AS stats__labels_count,
  p_size % 2 = 0 AS hidden,
  TRY_CAST(l_orderkey AS INTEGER) AS vintages__id,
  'v' || CAST(l_orderkey AS VARCHAR) AS vintages__seo_name,
  CAST(year(l_shipdate) AS VARCHAR) AS vintages__year,
  p_name || ' ' || CAST(year(l_shipdate) AS VARCHAR) AS vintages__name,
  l_linenumber AS vintages__stats__ratings_count,
  CAST(l_extendedprice AS FLOAT) AS vintages__stats__ratings_average,
  CAST(l_quantity AS INTEGER) AS vintages__stats__labels_count,
  {WINE_FILE_SQL} AS wine_file
FROM pg JOIN nw ON pg.l_suppkey = nw.nw_supp AND pg.page = nw.nw_page
WHERE kind IN (0, 1, 2, 5) AND NOT (kind = 2 AND p_partkey % 4 = 1)
"""


@register("vintages_flatten", VINTAGES_SQL)
def q_vintages_flatten(spark, root):
    return FL.flatten_vintages(wines_docs(spark, root))


WINERY_SQL = f"""
WITH {WINES_PAGES_SQL},
d AS (
  SELECT l_suppkey, page, any_value(kind) AS kind, any_value(s_name) AS s_name,
         count(DISTINCT CASE WHEN kind = 2 AND p_partkey % 4 = 1 THEN l_suppkey + 1000000
                             ELSE l_suppkey END) AS n_w,
         min(CASE WHEN kind = 2 AND p_partkey % 4 = 1 THEN l_suppkey + 1000000
                  ELSE l_suppkey END) AS wid
  FROM pg GROUP BY l_suppkey, page)
SELECT CAST(wid AS INTEGER) AS winery_id, lower(s_name) AS seo_name, {WINE_FILE_SQL} AS file_name
FROM d JOIN nw ON d.l_suppkey = nw.nw_supp AND d.page = nw.nw_page
WHERE kind IN (0, 2, 4, 5) AND n_w = 1
"""


@register("winery_info", WINERY_SQL)
def q_winery_info(spark, root):
    return FL.winery_info(wines_docs(spark, root))


WORKLIST_SQL = f"""
WITH {WINES_PAGES_SQL}
SELECT {WINE_FILE_SQL} AS file_name, CAST(l_partkey AS INTEGER) AS wine_id,
       CAST(l_partkey AS VARCHAR) || '=' ||
       string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY l_orderkey) AS line
FROM pg JOIN nw ON pg.l_suppkey = nw.nw_supp AND pg.page = nw.nw_page
WHERE kind IN (0, 2, 3)
GROUP BY l_suppkey, page, n_wines, l_partkey
"""


@register("worklist_export", WORKLIST_SQL)
def q_worklist_export(spark, root):
    return FL.worklist_lines(wines_docs(spark, root))


# ----------------------------------------------------------------- prices

PRICES_SQL = """
WITH pr AS (SELECT l_partkey, l_suppkey, min(l_extendedprice) AS mn, max(l_extendedprice) AS mx,
                   max(l_discount) AS disc, count(*) AS n
            FROM lineitem GROUP BY l_partkey, l_suppkey)
SELECT CAST(l_partkey AS INTEGER) AS wine_id, CAST(l_suppkey AS INTEGER) AS vintage_id,
       CASE WHEN l_partkey % 9 <> 3 THEN '$' END AS currency,
       CASE WHEN l_partkey % 9 <> 3 THEN 'US Dollar' END AS currency_name,
       CAST(mn AS FLOAT) AS median__amount, 'median' AS median__type,
       CASE WHEN n % 3 <> 0 AND n % 5 <> 0 THEN CAST(mx AS VARCHAR) END AS price__amount,
       CASE WHEN n % 3 <> 0 THEN CAST(disc AS VARCHAR) END AS price__discounted_from,
       CASE WHEN n % 3 <> 0 THEN 'ppc' END AS price__type
FROM pr WHERE l_partkey % 9 < 4
"""


@register("prices_flatten", PRICES_SQL)
def q_prices_flatten(spark, root):
    return FL.flatten_prices(price_docs(spark, root))


RUN_METRICS_SQL = """
WITH pr AS (SELECT l_partkey, count(*) AS n_entries
            FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) GROUP BY l_partkey)
SELECT count(*) AS n_docs,
       count(*) FILTER (WHERE l_partkey % 9 IN (4, 7)) AS n_dropped,
       count(*) FILTER (WHERE l_partkey % 9 IN (5, 6, 8)) AS n_zero_row_docs,
       CAST(coalesce(sum(n_entries) FILTER (WHERE l_partkey % 9 < 4), 0) AS BIGINT) AS n_rows
FROM pr
"""


@register("run_metrics", RUN_METRICS_SQL)
def q_run_metrics(spark, root):
    return FL.prices_doc_stats(price_docs(spark, root))


REVIEWS_TSV_SQL = f"""
SELECT review_id, rating, note, language, created_at, user_id, user_seo_name, user_alias,
       TRY_CAST(user_visblty AS BOOLEAN) AS user_visblty, user_followers_count, user_following_count,
       user_ratings_count, vintage_id, vintage_seo_name, vintage_year, vintage_name,
       vintge_stats_ratings_count, vintge_stats_ratings_average, vintge_stats_labels_count, vintge_wine_id,
       vintge_wine_name, vintge_wine_region_id, NULLIF(vintge_wine_rgn_name, '') AS vintge_wine_rgn_name,
       NULLIF(vintge_wine_rgn_cntry_code, '') AS vintge_wine_rgn_cntry_code,
       NULLIF(vintge_wine_rgn_cntry_name, '') AS vintge_wine_rgn_cntry_name,
       activity_id, activity_stats_likes_count, activity_stats_comments_count
FROM ({REVIEWS_SQL})
"""


@register("reviews_tsv", REVIEWS_TSV_SQL)
def q_reviews_tsv(spark, root):
    """Flat reviews exported as TSV and loaded back with the table's typed
    schema (empty text becomes NULL, non-boolean visibility becomes NULL)."""
    from doclake.functions.schemas import REVIEWS_DDL
    return _tsv_round_trip(spark, FL.flatten_reviews(review_docs(spark, root)), "reviews-tsv", REVIEWS_DDL)


def _tsv_round_trip(spark, df, name: str, ddl: str):
    from doclake.session import scratch_path
    from doclake.sinks.tsv import write_tsv
    from doclake.sources.tsv import read_tsv
    path = scratch_path(spark, name)
    write_tsv(df, path)
    return read_tsv(spark, path, ddl)


@register("vintages_tsv", VINTAGES_SQL)
def q_vintages_tsv(spark, root):
    """Flat vintages exported as TSV and loaded back with their typed schema."""
    from doclake.functions.schemas import VINTAGES_DDL
    return _tsv_round_trip(spark, FL.flatten_vintages(wines_docs(spark, root)), "vintages-tsv", VINTAGES_DDL)


@register("prices_tsv", PRICES_SQL)
def q_prices_tsv(spark, root):
    """Flat prices exported as TSV and loaded back with their typed schema."""
    from doclake.functions.schemas import PRICES_DDL
    return _tsv_round_trip(spark, FL.flatten_prices(price_docs(spark, root)), "prices-tsv", PRICES_DDL)


@register("duplicate_vintage_keys", f"""
WITH v AS ({VINTAGES_SQL})
SELECT winery__id, wine_id, vintages__id, count(*) AS n_rows
FROM (SELECT * FROM v UNION ALL SELECT * FROM v WHERE wine_file LIKE 'wines-%' AND CAST(split_part(wine_file, '-', 2) AS INTEGER) % 4 = 1)
GROUP BY winery__id, wine_id, vintages__id HAVING count(*) > 1
""")
def q_duplicate_vintage_keys(spark, root):
    """The flat vintages table checked for repeated (winery, wine, vintage):
    every fourth winery's documents were fetched twice."""
    from doclake.operators.wide import duplicate_keys
    docs = wines_docs(spark, root)
    again = F.split("file_name", "-")[1].cast("int") % 4 == 1
    fetched = docs.withColumn("_fetch", F.explode(F.when(again, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_fetch")
    return duplicate_keys(FL.flatten_vintages(fetched), ["winery__id", "wine_id", "vintages__id"])


@register("export_counters", f"""
SELECT count(*) AS n_lines, count(DISTINCT wine_id) AS n_wines,
       CAST(sum(length(line) - length(replace(line, ',', '')) + 1) AS BIGINT) AS n_vintages
FROM ({WORKLIST_SQL})
""")
def q_export_counters(spark, root):
    """Counters of the work-list export: lines written, distinct wines,
    vintage ids listed (one aggregate over the export)."""
    lines = FL.worklist_lines(wines_docs(spark, root))
    n_ids = F.size(F.split(F.regexp_extract("line", "=(.*)$", 1), ","))
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("wine_id").alias("n_wines"),
                     F.sum(n_ids).cast("bigint").alias("n_vintages"))


STRAY_SQL = """
UNION ALL SELECT 'bad_file_name', count(*) FROM region
UNION ALL SELECT 'not_json', count(*) FROM nation
"""


def stray_docs(spark, root, name_format: str):
    """Documents that do not belong: a wrong name per region, a body that is
    no JSON under a right name per nation."""
    from doclake.sources.tables import Tables
    t = Tables(spark, root)
    wrong = t.region.select(F.format_string("other-%d.json", "r_regionkey").alias("file_name"), F.lit("{}").alias("body"))
    return wrong.unionByName(t.nation.select(F.format_string(name_format, "n_nationkey").alias("file_name"),
                                             F.concat(F.lit("<html>"), "n_name").alias("body")))


@register("wines_quarantine", f"""
WITH {WINES_PAGES_SQL}
SELECT CASE kind WHEN 3 THEN 'null_winery' WHEN 4 THEN 'null_vintages' ELSE 'ok' END AS reason,
       count(*) AS n_docs
FROM (SELECT DISTINCT l_suppkey, page, kind FROM pg) GROUP BY 1
{STRAY_SQL}
""")
def q_wines_quarantine(spark, root):
    docs = wines_docs(spark, root).unionByName(stray_docs(spark, root, "wines-%d-0-0-.json"))
    q = FL.quarantine(docs, "wines")
    return (q.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n_docs")))


@register("prices_quarantine", f"""
SELECT CASE l_partkey % 9 WHEN 4 THEN 'no_currency' WHEN 7 THEN 'no_vintages' ELSE 'ok' END AS reason,
       count(*) AS n_docs
FROM (SELECT DISTINCT l_partkey FROM lineitem) GROUP BY 1
{STRAY_SQL}
""")
def q_prices_quarantine(spark, root):
    docs = price_docs(spark, root).unionByName(stray_docs(spark, root, "wine-%d-prices-.json"))
    q = FL.quarantine(docs, "prices")
    return (q.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n_docs")))
