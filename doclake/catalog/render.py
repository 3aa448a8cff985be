"""Raw documents rendered from the driver's tables, in the catalogue's shapes.

The flatteners read documents; the test tables are flat. These functions
build the nested JSON documents from the tables with Spark (joins, grouping,
``to_json``), under the catalogue's file names, with bad documents injected
by key class, so every document query works on data that grows with the
tables. Output: ``(file_name, body)`` like :func:`doclake.sources.files.read_documents`.

Documents are pages of bounded size: the rows of one key are counted, split
into ``ceil(n / page_rows)`` pages by a key-derived spread column, and only
then grouped. The fact is exchanged narrow, for the columns of its other keys
(supplier, part), then by the document's key, where its rows are counted, paged,
joined to what the key owns and grouped without another exchange: a wide row is
never exchanged, whether a dimension is broadcast or not. Large facts are dealt
by the document's key into tasks of ``TASK_ROWS`` rows, which sort and group in
memory whatever the session's number of shuffle partitions. Keys with very many
rows (a bounded number) are counted before and exchanged by (key, page): a key
holding a third of all rows becomes many pages spread over many tasks, never
one unbounded group.

Stand-ins: order = wine with review pages (lines = reviews, customer = user,
part = vintage, supplier = wine, nation = region, region = country);
supplier = winery with wines documents (parts = wines, lines = vintages);
part = wine with a price document keyed by supplier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.sources.tables import Tables

REVIEW_PAGE_ROWS = 50
WINES_PAGE_ROWS = 1000
HEAVY_ROWS = 100_000  # rows of a key that one task may hold before they are paged
TASK_ROWS = 200_000  # rows of a large fact in one task


def task_count(fact: DataFrame, task_rows: int = TASK_ROWS) -> int | None:
    """Number of tasks for a stored fact (its rows are counted from the file
    footers); None for one that is small enough to be left to Spark."""
    n = -(-fact.count() // task_rows)
    return n if n > fact.sparkSession.sparkContext.defaultParallelism else None


def dealt(rows: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    return rows.repartition(tasks, *keys) if tasks else rows


def heavy_keys(rows: DataFrame, key: str, page_rows: int, heavy_rows: int = HEAVY_ROWS, among: DataFrame | None = None) -> DataFrame:
    """``(_heavy, _pages)``: keys with more than ``heavy_rows`` rows (there are
    fewer than rows / ``heavy_rows``) and their number of pages. With
    ``among`` (a part key column) only rows of these parts are counted."""
    many = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > heavy_rows)
    if among is not None:
        many = (rows.join(F.broadcast(many.select(key)), key, "left_semi").join(among, among.columns, "left_semi")
                .groupBy(key).agg(F.count(F.lit(1)).alias("_n")))
    return many.select(F.col(key).alias("_heavy"), F.ceil(F.col("_n") / F.lit(page_rows)).alias("_pages"))


def with_pages(df: DataFrame, key: str, page_rows: int, spread: Column, heavy: DataFrame | None = None,
               weight: Column | None = None, tasks: int | None = None) -> DataFrame:
    """Add ``page`` = spread mod ceil(rows of the key / page_rows), and
    ``_deal``: the page of a heavy key, else 0. The rows lie by (key,
    ``_deal``), in ``tasks`` partitions if given. ``weight``: 0 for rows that are copies of a counted one."""
    heavy = heavy_keys(df, key, page_rows) if heavy is None else heavy
    early = F.pmod(spread, F.col("_pages"))
    rows = Window.partitionBy(key, "_deal")
    late = F.pmod(spread, F.ceil(F.sum(F.lit(1) if weight is None else weight).over(rows) / F.lit(page_rows)))
    placed = (df.filter(F.col(key).isNotNull()).join(F.broadcast(heavy), F.col(key) == F.col("_heavy"), "left")
              .withColumn("_deal", F.coalesce(early, F.lit(0).cast("bigint"))))
    return (dealt(placed, tasks, key, "_deal")
            .withColumn("page", F.when(F.col("_heavy").isNull(), late).otherwise(early))
            .drop("_heavy", "_pages"))


def numbered(rows: DataFrame, key: str, *columns: str, once: str = "_once") -> DataFrame:
    """Rows with ``once``: 1 for one row of each key, 0 for its other rows."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return rows.select(key, *columns).filter(F.col(key).isNotNull()).withColumn(once, (nth == 1).cast("int"))


def with_deals(rows: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """The rows a document's key owns, once per ``_deal`` of :func:`with_pages`:
    a heavy key's row once per page, any other once."""
    deals = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_pages", F.lit(1)) - 1)
    return (rows.filter(F.col(key).isNotNull()).join(F.broadcast(heavy), F.col(key) == F.col("_heavy"), "left")
            .withColumn("_deal", F.explode(deals)).drop("_heavy", "_pages"))


# --------------------------------------------------------------------------- review pages

def review_docs(spark, root: str, page_rows: int = REVIEW_PAGE_ROWS, heavy_rows: int = HEAVY_ROWS,
                task_rows: int = TASK_ROWS, wanted: Column | None = None) -> DataFrame:
    """One review page per (order, page); with ``wanted`` (a condition on
    ``l_orderkey``) of these orders only. Kind = order key mod 10:
    0 not JSON, 1 a NULL review appended, 2 user NULL, 3 vintage.wine NULL,
    4 activity without statistics; 5-9 good. In every kind the region is
    missing for suppliers of nations 13+ and the activity for line 1."""
    t = Tables(spark, root)
    key = F.col("l_orderkey")
    wanted = F.lit(True) if wanted is None else wanted
    heavy = heavy_keys(t.lineitem.filter(wanted), "l_orderkey", page_rows, heavy_rows)
    tasks = task_count(t.lineitem, task_rows)
    parts = numbered(t.part, "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    suppliers = numbered(t.supplier, "s_suppkey", "s_name", "s_nationkey", once="_s_once")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag",
                              "l_linestatus", "l_shipdate").filter(key.isNotNull() & wanted)
    lines = (lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left").drop("s_suppkey")
             .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").drop("p_partkey"))
    lines = with_pages(lines, "l_orderkey", page_rows, F.col("l_linenumber") + F.col("l_partkey"), heavy,
                       F.coalesce("_once", F.lit(1)) * F.coalesce("_s_once", F.lit(1)), tasks)
    # the customer's columns travel once per order; a heavy order's row once per page
    orders = with_deals(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority").filter(wanted)
                        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").drop("o_custkey"), "l_orderkey", heavy)
    base = (lines.join(dealt(orders, tasks, "l_orderkey", "_deal"), ["l_orderkey", "_deal"])
            .join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .withColumn("kind", F.pmod(F.col("l_orderkey"), F.lit(10))))
    kind = F.col("kind")
    year = F.when(F.col("p_size") % 10 == 0, F.lit("N.V.")).otherwise((F.col("p_size") + 1990).cast("string"))
    region = F.when(F.col("s_nationkey") < 13, F.struct(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.struct(F.lower(F.substring("r_name", 1, 2)).alias("code"), F.col("r_name").alias("name")).alias("country")))
    review = F.struct(
        F.col("l_linenumber").alias("id"),
        F.col("l_quantity").alias("rating"),
        F.when(F.col("l_quantity") >= 10,
               F.concat("l_returnflag", F.lit("\t"), "l_linestatus", F.lit("\n"), "o_orderpriority",
                        F.lit(" \r\x0b."))).alias("note"),
        F.col("c_mktsegment").alias("language"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"),
        F.when(kind != 2, F.struct(
            F.col("c_custkey").alias("id"), F.lower("c_name").alias("seo_name"), F.col("c_name").alias("alias"),
            F.col("c_mktsegment").alias("visibility"), F.col("c_nationkey").alias("followers_count"),
            F.col("c_acctbal").alias("following_count"),
            F.col("c_custkey").cast("string").alias("ratings_count"))).alias("user"),
        F.struct(
            F.col("l_partkey").alias("id"), F.lower("p_brand").alias("seo_name"), year.alias("year"),
            F.translate("p_name", " ", "\t").alias("name"),  # tabs become spaces again
            F.struct(F.col("p_size").alias("ratings_count"), F.col("p_retailprice").alias("ratings_average"),
                     (F.col("p_size") * 2).alias("labels_count")).alias("statistics"),
            F.when(kind != 3, F.struct(F.col("l_suppkey").alias("id"), F.col("s_name").alias("name"),
                                       region.alias("region"))).alias("wine")).alias("vintage"),
        F.when((F.col("l_linenumber") == 1) & (kind != 4), F.lit(None)).otherwise(F.struct(
            F.col("l_orderkey").alias("id"),
            F.when(kind != 4, F.struct(
                F.col("l_linenumber").alias("likes_count"),
                F.round(F.col("l_tax") * 100).cast("int").alias("comments_count"))).alias("statistics"))
        ).alias("activity"),
        F.lit(True).alias("unknown_field"),
    )
    pages = (base.groupBy("l_orderkey", "_deal", "page", "kind")
             .agg(F.collect_list(review).alias("reviews")))
    reviews = F.when(F.col("kind") == 1, F.array_append("reviews", F.lit(None))).otherwise(F.col("reviews"))
    body = F.when(F.col("kind") == 0, F.concat(F.lit("<html>not json "), F.col("l_orderkey").cast("string")))\
        .otherwise(F.to_json(F.struct(reviews.alias("reviews"))))
    return pages.select(
        F.format_string("wine-%d-reviews-page-%d-.json", "l_orderkey", F.col("page") + 1).alias("file_name"),
        body.alias("body"))


# --------------------------------------------------------------------------- wines documents

def wines_docs(spark, root: str, page_rows: int = WINES_PAGE_ROWS, heavy_rows: int = HEAVY_ROWS,
               task_rows: int = TASK_ROWS) -> DataFrame:
    """One wines document per (supplier, page); wines = parts, vintages =
    lines. Kind = supplier key mod 6: 0 good, 1 a NULL wine appended, 2 wines
    of parts with key mod 4 = 1 carry another winery id, 3 winery NULL,
    4 vintages NULL, 5 a NULL vintage appended to each wine. The region is
    missing for part sizes over 40; wine statistics are missing for sizes
    divisible by 7 and lack the average for sizes 1 mod 7."""
    t = Tables(spark, root)
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                           "l_extendedprice", "l_shipdate")
    heavy = heavy_keys(li, "l_suppkey", page_rows, heavy_rows, t.part.select(F.col("p_partkey").alias("l_partkey")))
    tasks = task_count(t.lineitem, task_rows)
    parts = numbered(t.part, "p_partkey", "p_name", "p_size", "p_retailprice")
    paged = with_pages(li.filter(F.col("l_suppkey").isNotNull()).join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey"),
                       "l_suppkey", page_rows, F.col("l_orderkey") + F.col("l_linenumber") + F.col("p_partkey"), heavy, F.col("_once"), tasks)
    wineries = with_deals(t.supplier.withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey", heavy)
    base = (paged.join(dealt(wineries, tasks, "l_suppkey", "_deal"), ["l_suppkey", "_deal"])
            .join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .withColumn("kind", F.pmod(F.col("l_suppkey"), F.lit(6))))
    year = F.year("l_shipdate").cast("string")
    vintage = F.struct(
        F.col("l_orderkey").alias("id"), F.concat(F.lit("v"), F.col("l_orderkey").cast("string")).alias("seo_name"),
        year.alias("year"), F.concat_ws(" ", "p_name", year).alias("name"),
        F.struct(F.col("l_linenumber").alias("ratings_count"), F.col("l_extendedprice").alias("ratings_average"),
                 F.col("l_quantity").alias("labels_count")).alias("statistics"))
    wine_cols = ["p_name", "p_size", "p_retailprice", "s_name", "s_nationkey", "s_acctbal",
                 "n_nationkey", "n_name", "r_regionkey", "r_name"]
    per_wine = (base.groupBy("l_suppkey", "_deal", "page", "kind", "p_partkey")
                .agg(F.sort_array(F.collect_list(vintage)).alias("vintages"),
                     *[F.any_value(c).alias(c) for c in wine_cols]))
    kind, size = F.col("kind"), F.col("p_size")
    vintages = (F.when(kind == 4, F.lit(None))
                .when(kind == 5, F.array_append("vintages", F.lit(None)))
                .otherwise(F.col("vintages")))
    region = F.when(size <= 40, F.struct(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lower("n_name").alias("seo_name"),
        F.struct(F.lower(F.substring("r_name", 1, 2)).alias("code"), F.col("r_name").alias("name"),
                 F.col("r_regionkey").alias("regions_count"), (F.col("r_regionkey") * 1000).alias("users_count"),
                 (F.col("n_nationkey") * 10).alias("wines_count")).alias("country")))
    winery_id = F.when((kind == 2) & (F.col("p_partkey") % 4 == 1), F.col("l_suppkey") + 1000000)\
        .otherwise(F.col("l_suppkey"))
    winery = F.when(kind != 3, F.struct(
        winery_id.alias("id"), F.col("s_name").alias("name"), F.lower("s_name").alias("seo_name"),
        F.struct(F.col("s_nationkey").alias("ratings_count"),
                 F.col("s_acctbal").alias("ratings_average")).alias("statistics")))
    stats = F.when(size % 7 != 0, F.struct(
        size.alias("ratings_count"),
        F.when(size % 7 != 1, F.col("p_retailprice")).alias("ratings_average"),
        F.when(size % 7 != 1, size * 3).alias("labels_count")))
    wine = F.struct(
        F.col("p_partkey").alias("id"), F.translate("p_name", " ", "\t").alias("name"), (size / 10.0).alias("type_id"),
        region.alias("region"), winery.alias("winery"), stats.alias("statistics"),
        (size % 2 == 0).alias("hidden"), vintages.alias("vintages"))
    docs = (per_wine.groupBy("l_suppkey", "_deal", "page", "kind")
            .agg(F.sort_array(F.collect_list(wine)).alias("wines")))
    wines = F.when(F.col("kind") == 1, F.array_append("wines", F.lit(None))).otherwise(F.col("wines"))
    return docs.select(
        F.format_string("wines-%d-%d-%d-.json", "l_suppkey", "page",
                        F.size("wines")).alias("file_name"),
        F.to_json(F.struct(wines.alias("wines"))).alias("body"))


# --------------------------------------------------------------------------- price documents

def price_docs(spark, root: str, heavy_rows: int = HEAVY_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """One price document per part, ``vintages`` keyed by supplier id.
    Entries come from distinct (part, supplier) pairs, so a document has at
    most one entry per supplier, however often a part is sold; the catalogue
    knows one document per wine, so these are not paged. A large fact is
    exchanged once, by part, and paired and grouped where it lies; parts with
    very many lines are paired before they are exchanged by part.
    Kind = part key mod 9: 0-3 good (3 with a JSON null as currency), 4 currency missing, 5 ``{}``,
    6 ``[]``, 7 ``vintages`` missing, 8 JSON null. Entry with n lines: no
    price when n mod 3 = 0, no price amount when n mod 5 = 0."""
    lines = Tables(spark, root).lineitem.select("l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
    tasks = task_count(lines, task_rows)
    if not tasks:
        return _price_docs(lines)
    heavy = F.broadcast(heavy_keys(lines, "l_partkey", heavy_rows, heavy_rows))
    is_heavy = F.col("l_partkey").eqNullSafe(F.col("_heavy"))
    return (_price_docs(dealt(lines.join(heavy, is_heavy, "left_anti"), tasks, "l_partkey"))
            .unionByName(_price_docs(lines.join(heavy, is_heavy, "left_semi"))))


def _price_docs(lines: DataFrame) -> DataFrame:
    pairs = (lines.groupBy("l_partkey", "l_suppkey")
             .agg(F.min("l_extendedprice").alias("mn"), F.max("l_extendedprice").alias("mx"),
                  F.max("l_discount").alias("disc"), F.count(F.lit(1)).alias("n")))
    n = F.col("n")
    entry = F.struct(
        F.struct(F.col("mn").alias("amount"), F.lit("median").alias("type")).alias("median"),
        F.when(n % 3 != 0, F.struct(F.when(n % 5 != 0, F.col("mx")).alias("amount"),
                                    F.col("disc").alias("discounted_from"),
                                    F.lit("ppc").alias("type"))).alias("price"))
    per_part = (pairs.groupBy("l_partkey")
                .agg(F.map_from_entries(F.collect_list(F.struct(
                    F.col("l_suppkey").cast("string").alias("key"), entry.alias("value")))).alias("m"))
                .withColumn("kind", F.pmod(F.col("l_partkey"), F.lit(9))))
    kind = F.col("kind")
    market = F.when(kind == 3, F.lit('{"currency":null}')).otherwise(F.to_json(F.struct(
        F.when(kind != 4, F.struct(F.lit("$").alias("prefix"), F.lit("US\tDollar").alias("name"))).alias("currency"))))
    vint = (F.when(kind == 5, F.lit("{}")).when(kind == 6, F.lit("[]")).when(kind == 8, F.lit("null"))
            .otherwise(F.to_json("m")))
    body = F.when(kind == 7, F.concat(F.lit('{"prices":{"market":'), market, F.lit("}}")))\
        .otherwise(F.concat(F.lit('{"prices":{"market":'), market, F.lit(',"vintages":'), vint, F.lit("}}")))
    return per_part.select(F.format_string("wine-%d-prices-.json", "l_partkey").alias("file_name"),
                           body.alias("body"))
