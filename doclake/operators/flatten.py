"""Flatteners of the catalogue's nested JSON documents into wide flat tables.

Input of every operator is a *raw documents* DataFrame with at least
``file_name`` (the bare name, ids are encoded in it) and ``body`` (the whole
JSON text). See :mod:`doclake.sources.files` for reading it from a folder.

A document is treated as a whole: when any of its rows cannot be built the
document yields no row at all and the run goes on. This is expressed as a
validity predicate per document (no exceptions, no Python): bad documents can
be routed to a quarantine table with a reason.

Plan shape: scan -> from_json -> filter(valid) -> explode -> project. One
narrow stage, no shuffle; the work is spread by the scan's splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.functions import schemas as S
from doclake.functions.json import present as json_present
from doclake.functions.values import clean_ws, map_entries_last_wins, primitive_float, tab_to_space, to_float, to_int

# File-name patterns (fixed values, anchored; the dot before the extension is literal).
WINES_FILE_RE = r"^wines-(\d+)-(\d+)-(\d+)-\.json$"
WINES_FILE_LOOSE_RE = r"^wines-(\d+)-(\d+)-(\d+)-?\.json$"
REVIEWS_FILE_RE = r"^wine-(\d+)-reviews-page-(\d+)-?\.json$"
PRICES_FILE_RE = r"^wine-(\d+)-prices-?\.json$"
HTML_FILE_RE = r"^winary-(\d+)-(.*)\.html$"


def _json_present(body: str, path: str) -> Column:
    """True when ``path`` exists in the document, also when its value is
    JSON null or an empty array (not when the field is missing)."""
    return json_present(body, path)


def _all(arr: Column, pred) -> Column:
    """forall() that is false, not NULL, for a NULL array or a NULL result."""
    return F.coalesce(F.forall(arr, lambda x: F.coalesce(pred(x), F.lit(False))), F.lit(False))


def _each(rows: DataFrame, kept: list, array: str, name: str) -> DataFrame:
    """``kept`` columns and one row ``name`` per element of ``array`` that is
    not NULL.

    An inner ``explode`` would get a filter on the array's size, which is pushed
    below the projection that makes the array, so that every document would be
    parsed again for the filter; the outer form with a filter above does not."""
    return rows.select(*kept, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def _first_failing(checks: list[tuple[str, Column]]) -> Column:
    expr = F.lit(None).cast("string")
    for reason, ok in reversed(checks):
        expr = F.when(~ok, F.lit(reason)).otherwise(expr)
    return expr


# --------------------------------------------------------------------------- reviews

def parse_reviews(docs: DataFrame) -> DataFrame:
    return docs.withColumn("doc", F.from_json("body", S.REVIEWS_SCHEMA))


def reviews_checks(doc: Column) -> list[tuple[str, Column]]:
    revs = doc["reviews"]
    return [
        ("no_reviews", revs.isNotNull()),
        ("null_review", _all(revs, lambda r: r.isNotNull())),
        ("null_user", _all(revs, lambda r: r["user"].isNotNull())),
        ("null_vintage", _all(revs, lambda r: r["vintage"].isNotNull())),
        ("null_vintage_statistics", _all(revs, lambda r: r["vintage"]["statistics"].isNotNull())),
        ("null_wine", _all(revs, lambda r: r["vintage"]["wine"].isNotNull())),
        ("null_country", _all(revs, lambda r: r["vintage"]["wine"]["region"].isNull()
                              | r["vintage"]["wine"]["region"]["country"].isNotNull())),
        ("null_activity_statistics", _all(revs, lambda r: r["activity"].isNull()
                                          | r["activity"]["statistics"].isNotNull())),
    ]


def _review_ok(r: Column) -> Column:
    v, act = r["vintage"], r["activity"]
    region = v["wine"]["region"]
    return (r.isNotNull() & r["user"].isNotNull() & v.isNotNull() & v["statistics"].isNotNull()
            & v["wine"].isNotNull() & (region.isNull() | region["country"].isNotNull())
            & (act.isNull() | act["statistics"].isNotNull()))


def reviews_valid(doc: Column) -> Column:
    """All rules of :func:`reviews_checks` in one pass over the array (one
    lambda evaluation per review instead of one per rule)."""
    return doc["reviews"].isNotNull() & _all(doc["reviews"], _review_ok)


def flatten_reviews(docs: DataFrame) -> DataFrame:
    """Review pages -> one row per review, 28 columns.

    A missing region gives id -1 and empty names, a missing activity gives
    -1 for its three numbers (present objects with NULL fields stay NULL).
    Notes have every whitespace character replaced by a space, all other
    texts their tabs. A number that is none gives NULL, see quarantine."""
    parsed = parse_reviews(docs)
    r = F.col("r")
    region, activity = r["vintage"]["wine"]["region"], r["activity"]
    stats = r["vintage"]["statistics"]

    def reg(field, default):
        return F.when(region.isNull(), F.lit(default)).otherwise(field)

    def act(field):
        return F.when(activity.isNull(), F.lit(-1)).otherwise(to_int(field))

    cols = [
        to_int(r["id"]).alias("review_id"),
        primitive_float(r["rating"]).alias("rating"),
        clean_ws(r["note"]).alias("note"),
        tab_to_space(r["language"]).alias("language"),
        F.substring(r["created_at"], 1, 10).try_cast("date").alias("created_at"),
        to_int(r["user"]["id"]).alias("user_id"),
        tab_to_space(r["user"]["seo_name"]).alias("user_seo_name"),
        tab_to_space(r["user"]["alias"]).alias("user_alias"),
        tab_to_space(r["user"]["visibility"]).alias("user_visblty"),
        to_int(r["user"]["followers_count"]).alias("user_followers_count"),
        to_int(r["user"]["following_count"]).alias("user_following_count"),
        to_int(r["user"]["ratings_count"]).alias("user_ratings_count"),
        to_int(r["vintage"]["id"]).alias("vintage_id"),
        tab_to_space(r["vintage"]["seo_name"]).alias("vintage_seo_name"),
        tab_to_space(r["vintage"]["year"]).alias("vintage_year"),
        tab_to_space(r["vintage"]["name"]).alias("vintage_name"),
        to_int(stats["ratings_count"]).alias("vintge_stats_ratings_count"),
        primitive_float(stats["ratings_average"]).alias("vintge_stats_ratings_average"),
        to_int(stats["labels_count"]).alias("vintge_stats_labels_count"),
        to_int(r["vintage"]["wine"]["id"]).alias("vintge_wine_id"),
        tab_to_space(r["vintage"]["wine"]["name"]).alias("vintge_wine_name"),
        reg(to_int(region["id"]), -1).alias("vintge_wine_region_id"),
        reg(tab_to_space(region["name"]), "").alias("vintge_wine_rgn_name"),
        reg(tab_to_space(region["country"]["code"]), "").alias("vintge_wine_rgn_cntry_code"),
        reg(tab_to_space(region["country"]["name"]), "").alias("vintge_wine_rgn_cntry_name"),
        act(activity["id"]).alias("activity_id"),
        act(activity["statistics"]["likes_count"]).alias("activity_stats_likes_count"),
        act(activity["statistics"]["comments_count"]).alias("activity_stats_comments_count"),
    ]
    # Validity gates the array that is exploded (an invalid document gives no
    # rows) instead of a filter: a filter would get the parse inlined into its
    # condition and the document would be parsed twice. The gate is a projection
    # below the generator, which would prepare regexes and lambdas for each row.
    doc = F.col("doc")
    return _each(parsed.select(F.when(reviews_valid(doc), doc["reviews"]).alias("rs")), [], "rs", "r").select(*cols)


# --------------------------------------------------------------------------- wines / vintages

def parse_wines(docs: DataFrame) -> DataFrame:
    return docs.withColumn("doc", F.from_json("body", S.WINES_SCHEMA))


def wines_checks(doc: Column, file_name: Column, name_re: str = WINES_FILE_RE) -> list[tuple[str, Column]]:
    wines = doc["wines"]
    return [
        ("bad_file_name", file_name.rlike(name_re)),
        ("no_wines", wines.isNotNull()),
        ("null_winery", _all(wines, lambda w: w.isNull() | w["winery"].isNotNull())),
        ("null_vintages", _all(wines, lambda w: w.isNull() | w["vintages"].isNotNull())),
    ]


def wines_valid(doc: Column, file_name: Column, name_re: str = WINES_FILE_RE) -> Column:
    """All rules of :func:`wines_checks`, one pass over the array."""
    wines = doc["wines"]
    return (file_name.rlike(name_re) & wines.isNotNull()
            & _all(wines, lambda w: w.isNull() | (w["winery"].isNotNull() & w["vintages"].isNotNull())))


def flatten_vintages(docs: DataFrame) -> DataFrame:
    """Wines documents -> one row per (wine, vintage), 30 columns.

    NULL wines and NULL vintages are skipped; wines whose winery id differs
    from the id in the file name are skipped (row level); missing objects on a
    path give NULL fields."""
    file_name, doc = F.col("file_name"), F.col("doc")
    parsed = parse_wines(docs)
    file_winery = F.regexp_extract(file_name, WINES_FILE_RE, 1).try_cast("int")
    ws = parsed.select("file_name", file_winery.alias("file_winery"), F.when(wines_valid(doc, file_name), doc["wines"]).alias("ws"))
    w = _each(ws, ["file_name", "file_winery"], "ws", "w").filter(to_int(F.col("w.winery.id")) == F.col("file_winery"))
    # the wine is carried into each of its vintage rows without its vintage
    # list (carrying the list would copy it once per vintage: quadratic)
    v = _each(w, ["file_name", F.col("w").dropFields("vintages").alias("w")], "w.vintages", "v")
    wc, vc = F.col("w"), F.col("v")
    region, country, winery = wc["region"], wc["region"]["country"], wc["winery"]
    wstats = winery["statistics"]
    cols = [
        to_int(wc["id"]).alias("wine_id"),
        tab_to_space(wc["name"]).alias("wine_name"),
        to_int(wc["type_id"]).alias("wine_type_id"),
        to_int(region["id"]).alias("rgn__id"),
        tab_to_space(region["name"]).alias("rgn__name"),
        tab_to_space(region["seo_name"]).alias("rgn__seo_name"),
        tab_to_space(country["code"]).alias("rgn__cntry__code"),
        tab_to_space(country["name"]).alias("rgn__cntry__name"),
        to_int(country["regions_count"]).alias("rgn__cntry__regions_count"),
        to_int(country["users_count"]).alias("rgn__cntry__users_count"),
        to_int(country["wines_count"]).alias("rgn__cntry__wines_count"),
        to_int(country["wineries_count"]).alias("rgn__cntry__wineries_count"),
        to_int(winery["id"]).alias("winery__id"),
        tab_to_space(winery["name"]).alias("winery__name"),
        tab_to_space(winery["seo_name"]).alias("winery__seo_name"),
        to_int(wstats["ratings_count"]).alias("winery__stats__ratings_count"),
        primitive_float(wstats["ratings_average"], wstats).alias("winery__stats__ratings_average"),
        to_int(wstats["wines_count"]).alias("winery__stats__wines_count"),
        to_int(wc["statistics"]["ratings_count"]).alias("stats__ratings_count"),
        primitive_float(wc["statistics"]["ratings_average"], wc["statistics"]).alias("stats__ratings_average"),
        to_int(wc["statistics"]["labels_count"]).alias("stats__labels_count"),
        F.coalesce(wc["hidden"], F.lit(False)).alias("hidden"),
        to_int(vc["id"]).alias("vintages__id"),
        tab_to_space(vc["seo_name"]).alias("vintages__seo_name"),
        tab_to_space(vc["year"]).alias("vintages__year"),
        tab_to_space(vc["name"]).alias("vintages__name"),
        to_int(vc["statistics"]["ratings_count"]).alias("vintages__stats__ratings_count"),
        primitive_float(vc["statistics"]["ratings_average"], vc["statistics"]).alias("vintages__stats__ratings_average"),
        to_int(vc["statistics"]["labels_count"]).alias("vintages__stats__labels_count"),
        F.col("file_name").alias("wine_file"),
    ]
    return v.select(*cols)


def winery_info(docs: DataFrame) -> DataFrame:
    """One ``(winery_id, seo_name, file_name)`` per wines document whose wines
    all belong to one winery. Documents with a NULL wine, with several
    distinct wineries, or whose only winery is NULL give no record; a document
    without wines gives none either."""
    parsed = parse_wines(docs.filter(F.col("file_name").rlike(WINES_FILE_RE)))
    wines = F.col("doc.wines")
    wineries = F.array_distinct(F.transform(wines, lambda w: w["winery"]))
    first = F.get(wineries, 0)
    ok = (wines.isNotNull() & _all(wines, lambda w: w.isNotNull())
          & (F.size(wineries) == 1) & first.isNotNull())
    # zero or one record per document, produced inside the parsing projection
    rec = F.when(F.coalesce(ok, F.lit(False)), F.array(F.struct(
        to_int(first["id"]).alias("winery_id"), first["seo_name"].alias("seo_name"))))
    return (_each(parsed.select("file_name", rec.alias("rec")), ["file_name"], "rec", "w")
            .select("w.winery_id", "w.seo_name", "file_name"))


def worklist_lines(docs: DataFrame) -> DataFrame:
    """Work list export: per wines document, wines grouped by id, their
    vintage ids concatenated in document order -> ``"<wine_id>=<v1>,<v2>"``.

    Grouping is per document (an id in two documents gives two lines). The
    arrays are exploded with their positions and grouped by (document, id), so
    the work grows with the number of vintages. Documents that break a rule of
    :func:`worklist_checks` give no lines."""
    parsed = (parse_wines(docs.filter(F.col("file_name").rlike(WINES_FILE_LOOSE_RE)))
              .withColumn("_doc", F.monotonically_increasing_id()))  # a name may occur twice
    wines = F.col("doc.wines")
    ok = F.lit(True)
    for _, c in worklist_checks(F.col("doc"), F.col("file_name")):
        ok = ok & c
    w = (parsed.select("file_name", "_doc", F.when(ok, wines).alias("ws"))
         .select("file_name", "_doc", F.posexplode_outer("ws").alias("pos", "w")).filter(F.col("pos").isNotNull())  # see _each
         .select("file_name", "_doc", to_int("w.id").alias("wine_id"),
                 F.struct("pos", F.transform("w.vintages", lambda x: to_int(x["id"])).alias("ids")).alias("v")))
    ids = F.flatten(F.transform(F.sort_array(F.collect_list("v")), lambda x: x["ids"]))
    return (w.groupBy("file_name", "_doc", "wine_id").agg(ids.alias("vintage_ids"))
            .select("file_name", "wine_id", F.concat(F.col("wine_id").cast("string"), F.lit("="),
                                                     F.array_join("vintage_ids", ",")).alias("line")))


def worklist_checks(doc: Column, file_name: Column) -> list[tuple[str, Column]]:
    """Rules a wines document must meet to be exported as work list lines."""
    wines = doc["wines"]
    return [
        ("bad_file_name", file_name.rlike(WINES_FILE_LOOSE_RE)),
        ("no_wines", wines.isNotNull()),
        ("null_wine", _all(wines, lambda w: w.isNotNull())),
        ("null_vintages", _all(wines, lambda w: w["vintages"].isNotNull()
                               & F.forall(w["vintages"], lambda x: x.isNotNull()))),
        ("null_id", _all(wines, lambda w: to_int(w["id"]).isNotNull())),
    ]


# --------------------------------------------------------------------------- prices

def parse_prices(docs: DataFrame) -> DataFrame:
    return docs.withColumn("doc", F.from_json("body", S.PRICES_SCHEMA))


def prices_checks(doc: Column, body: Column, file_name: Column) -> list[tuple[str, Column]]:
    p = doc["prices"]
    return [
        ("bad_file_name", file_name.rlike(PRICES_FILE_RE)),
        # a JSON null currency keeps the document, only a missing one drops it
        ("no_currency", p["market"]["currency"].isNotNull() | _json_present(body, "$.prices.market.currency")),
        ("no_vintages", p["vintages"].isNotNull() | _json_present("body", "$.prices.vintages")),
    ]


def prices_valid(doc: Column, body: Column, file_name: Column) -> Column:
    ok = F.lit(True)
    for _, c in prices_checks(doc, body, file_name):
        ok = ok & F.coalesce(c, F.lit(False))
    return ok


def flatten_prices(docs: DataFrame) -> DataFrame:
    """Price documents -> one row per vintage key of ``prices.vintages``,
    9 columns. A repeated key keeps its last value. ``{}``, ``[]`` and JSON
    null give zero rows but keep the document; a missing currency or
    ``vintages`` drops it."""
    fn, body = F.col("file_name"), F.col("body")
    parsed = parse_prices(docs)
    valid = prices_valid(F.col("doc"), body, fn)
    entries = F.when(valid, map_entries_last_wins(F.col("doc.prices.vintages")))
    e = F.col("e")
    return (parsed
            .select(F.regexp_extract(fn, PRICES_FILE_RE, 1).try_cast("int").alias("wine_id"),
                    F.col("doc.prices.market.currency").alias("cur"), entries.alias("es"))
            .transform(_each, ["wine_id", "cur"], "es", "e")
            .select("wine_id",
                    e["key"].try_cast("int").alias("vintage_id"),
                    tab_to_space(F.col("cur.prefix")).alias("currency"),
                    tab_to_space(F.col("cur.name")).alias("currency_name"),
                    to_float(e["value"]["median"]["amount"]).alias("median__amount"),
                    tab_to_space(e["value"]["median"]["type"]).alias("median__type"),
                    tab_to_space(e["value"]["price"]["amount"]).alias("price__amount"),
                    tab_to_space(e["value"]["price"]["discounted_from"]).alias("price__discounted_from"),
                    tab_to_space(e["value"]["price"]["type"]).alias("price__type")))


def prices_doc_stats(docs: DataFrame) -> DataFrame:
    """Run counters of a price export: documents, dropped documents,
    documents with zero rows, rows written. One aggregate, one pass."""
    fn, body = F.col("file_name"), F.col("body")
    parsed = parse_prices(docs)
    valid = prices_valid(F.col("doc"), body, fn)
    n = F.size(F.coalesce(map_entries_last_wins(F.col("doc.prices.vintages")),
                          F.array()))
    return (parsed.select(valid.alias("ok"), n.alias("n"))
            .agg(F.count(F.lit(1)).alias("n_docs"),
                 F.count_if(~F.col("ok")).alias("n_dropped"),
                 F.count_if(F.col("ok") & (F.col("n") == 0)).alias("n_zero_row_docs"),
                 F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0)).cast("bigint").alias("n_rows")))


# --------------------------------------------------------------------------- quarantine

def _numbers(*fields: Column) -> Column:
    """True unless a field holds text that is no number."""
    ok = F.lit(True)
    for f in fields:
        ok = ok & (f.isNull() | f.try_cast("double").isNotNull())
    return ok


def _review_numbers(r: Column) -> Column:
    v, u, a = r["vintage"], r["user"], r["activity"]
    return _numbers(r["id"], r["rating"], u["id"], u["followers_count"], u["following_count"], u["ratings_count"],
                    v["id"], *[v["statistics"][c] for c in ("ratings_count", "ratings_average", "labels_count")],
                    v["wine"]["id"], v["wine"]["region"]["id"], a["id"], a["statistics"]["likes_count"],
                    a["statistics"]["comments_count"])


def _wine_numbers(w: Column) -> Column:
    stats = ("ratings_count", "ratings_average", "labels_count")
    per_vintage = F.forall(w["vintages"], lambda x: _numbers(x["id"], *[x["statistics"][c] for c in stats]))
    country, winery = w["region"]["country"], w["winery"]
    return (_numbers(w["id"], w["type_id"], w["region"]["id"], winery["id"], *[w["statistics"][c] for c in stats],
                     *[country[c] for c in ("regions_count", "users_count", "wines_count", "wineries_count")],
                     *[winery["statistics"][c] for c in ("ratings_count", "ratings_average", "wines_count")])
            & F.coalesce(per_vintage, F.lit(True)))


def quarantine(docs: DataFrame, kind: str) -> DataFrame:
    """Every document with the first rule it breaks (``reason`` NULL = good).

    ``kind``: reviews | wines | prices | worklist. ``not_json`` is told apart
    from a valid JSON without the expected content. ``bad_number`` reports a
    number field that holds something else; such a document's rows are kept,
    with NULL in the field."""
    fn, body = F.col("file_name"), F.col("body")
    if kind == "reviews":
        parsed = parse_reviews(docs)
        checks = [*reviews_checks(F.col("doc")), ("bad_number", _all(F.col("doc.reviews"), _review_numbers))]
        top = F.col("doc.reviews")
    elif kind == "wines":
        parsed = parse_wines(docs)
        checks = [*wines_checks(F.col("doc"), fn), ("bad_number", _all(F.col("doc.wines"), _wine_numbers))]
        top = F.col("doc.wines")
    elif kind == "worklist":
        parsed, checks = parse_wines(docs), worklist_checks(F.col("doc"), fn)
        top = F.col("doc.wines")
    elif kind == "prices":
        parsed, checks = parse_prices(docs), prices_checks(F.col("doc"), body, fn)
        top = F.col("doc.prices")
    else:
        raise ValueError(kind)
    not_json = top.isNull() & F.expr("try_parse_json(body)").isNull()
    reason = F.when(not_json, F.lit("not_json")).otherwise(_first_failing(checks))
    return parsed.select("file_name", reason.alias("reason"))
