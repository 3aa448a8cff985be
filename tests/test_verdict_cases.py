"""Inputs that once went wrong: late files, line breaks, bad pages, repeated
keys and captures, colliding column names, documents that break a rule."""

import json
import os
import time

import pytest
from conftest import docs_df, rows
from pyspark.sql import functions as F

from doclake.functions.schemas import ADDRESSES_COLUMNS, PRICES_DDL, REVIEWS_DDL, VINTAGES_DDL
from doclake.operators import flatten as FL
from doclake.operators import responses as R
from doclake.operators.html import extract_fields, html_quarantine, winery_addresses, winery_pages
from doclake.operators.indexing import dense_index
from doclake.operators.wide import wide_coverage, wide_join
from doclake.sinks.files import insert_if_absent, land_raw, write_documents
from doclake.sinks.tsv import write_lines, write_tsv
from doclake.sources import lines as L
from doclake.sources.tsv import read_tsv, read_tsv_text
from doclake.streaming.incremental import ingest_available


def test_late_files_with_old_times_are_ingested(spark, tmp):
    os.makedirs(f"{tmp}/in")

    def put(name, age_days):
        with open(f"{tmp}/in/{name}", "w") as f:
            f.write(name)
        old = time.time() - age_days * 86400
        os.utime(f"{tmp}/in/{name}", (old, old))

    def run():
        ingest_available(spark, f"{tmp}/in", f"{tmp}/out", f"{tmp}/ckpt", lambda d: d.select("file_name"))
        return sorted(r[0] for r in spark.read.parquet(f"{tmp}/out").collect())
    put("a", 0)
    assert run() == ["a"]
    put("old", 30)
    put("older", 4000)
    put("new", 0)
    assert run() == ["a", "new", "old", "older"]
    assert run() == ["a", "new", "old", "older"]


@pytest.mark.parametrize("header", [True, False])
@pytest.mark.parametrize("value", ["a\rb", "a\r\nb", "a\nb", "a\tb", 'a"b', '"', "\\", "a\\"])
def test_tsv_keeps_rows_and_breaks(spark, tmp, header, value):
    df = spark.createDataFrame([(1, value, "c"), (2, "x", value)], "i int, a string, b string")
    write_tsv(df, f"{tmp}/k", header=header, line_breaks="keep")
    back = read_tsv(spark, f"{tmp}/k", "i int, a string, b string", header=header, multiline=True)
    assert rows(back, "i") == rows(df, "i")
    write_tsv(df, f"{tmp}/s", header=header)
    flat = value.replace("\r", " ").replace("\n", " ")
    back = read_tsv_text(spark, f"{tmp}/s", ["i", "a", "b"], header=header)
    assert [tuple(r.values()) for r in rows(back, "i")] == [("1", flat, "c"), ("2", "x", flat)]


def test_tsv_files_are_split_by_default(spark, tmp):
    write_tsv(spark.range(20000).select(F.col("id"), F.lit("x" * 50).alias("t")).coalesce(1), f"{tmp}/t")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "128k")
    try:
        back = read_tsv(spark, f"{tmp}/t", "id long, t string")
        assert back.rdd.getNumPartitions() > 4 and back.count() == 20000
    finally:
        spark.conf.set(key, before)


def test_flat_tables_match_their_schemas(spark):
    docs = docs_df(spark, [("x", "{}")])
    for flat, ddl in ((FL.flatten_reviews, REVIEWS_DDL), (FL.flatten_vintages, VINTAGES_DDL), (FL.flatten_prices, PRICES_DDL)):
        assert flat(docs).columns == [c.split()[0] for c in ddl.split(", ")]
    empty = spark.createDataFrame([], "winery_id int, seo_name string, html string")
    assert winery_addresses(empty).columns == list(ADDRESSES_COLUMNS)


def test_one_bad_page_does_not_stop_the_others(spark):
    docs = docs_df(spark, [("winary-1-a.html", "<![foo[bar]]><p>x</p>"),
                           ("winary-2-b.html", '<span class="winery-page__header__winemaker">Winemaker: W</span>'),
                           ("other.txt", "text"), ("winary-3-c.html", None)])
    got = [(r["winery_id"], r["winemaker"]) for r in rows(winery_addresses(winery_pages(docs)), "winery_id")]
    assert got == [(2, "W"), (3, "")]
    q = {r["file_name"]: r["reason"] for r in rows(html_quarantine(docs))}
    assert q == {"winary-1-a.html": "not_html", "winary-2-b.html": None, "other.txt": "bad_file_name", "winary-3-c.html": None}
    hits = extract_fields(docs, "body", {"p": ("p", None)}, ["file_name"])
    assert {r["file_name"]: r["p"] for r in rows(hits)}["winary-2-b.html"] == []


def test_insert_if_absent_with_repeated_and_null_keys(spark, tmp):
    first = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n"), (2, "x"), (2, "x")], "k int, v string")
    ins, rej = insert_if_absent(spark, f"{tmp}/t", first.repartition(3), "k")
    assert sorted(map(tuple, ins.collect())) == [(1, "a"), (2, "x")]
    assert sorted(map(str, map(tuple, rej.collect()))) == sorted(map(str, [(1, "b"), (2, "x"), (None, "n")]))
    later = spark.createDataFrame([(3, "q"), (3, "p"), (1, "z"), (None, "n")], "k int, v string")
    ins, rej = insert_if_absent(spark, f"{tmp}/t", later, "k")
    assert [tuple(r) for r in ins.collect()] == [(3, "p")] and rej.count() == 3
    assert sorted(map(tuple, spark.read.parquet(f"{tmp}/t").collect())) == [(1, "a"), (2, "x"), (3, "p")]
    assert sorted(os.listdir(tmp)) == ["t"]  # nothing is left beside the table


def test_page_runs_do_not_depend_on_the_order_of_captures(spark):
    pages = [(1, 1, "failed"), (1, 1, "ok"), (1, 2, "empty"), (1, 2, "failed"), (2, 1, "empty"), (2, 1, "ok"), (2, 2, "odd")]
    starts = spark.createDataFrame([(1, 1), (1, 3), (2, 1)], "wine_id int, start_page int")
    for order in (pages, pages[::-1]):
        df = spark.createDataFrame(order, "wine_id int, page_no int, state string").coalesce(1)
        assert sorted(map(tuple, R.page_runs(df, starts).collect())) == [(1, 1, True, 1), (2, 1, False, 1)]


def test_wide_names_of_the_catalogues_tables(spark):
    r = spark.createDataFrame([(1, 7, "n")], "review_id int, vintage_id int, note string")
    p = spark.createDataFrame([(5, 7, "1")], "wine_id int, vintage_id int, price__amount string")
    v = spark.createDataFrame([(6, 7)], "wine_id int, vintages__id int")
    keys = dict(fact_price_key="vintage_id", price_key="vintage_id", fact_vintage_key="vintage_id", vintage_key="vintages__id")
    w = wide_join(r, p, v, **keys)
    assert w.columns == ["review_id", "note", "price_wine_id", "price__amount", "wine_id", "vintages__id"]
    every = {c: [c] for c in w.columns}
    got = {x["metric"]: x["n"] for x in wide_coverage(r, p, v, **keys, measures=every).collect()}
    assert got == {**{c: 1 for c in w.columns}, "all": 1}
    with pytest.raises(ValueError, match="unknown"):
        wide_coverage(r, p, v, **keys, measures={"x": ["vintage_id"]})


def test_tabs_null_currency_and_junk_numbers(spark):
    def price(currency):
        return json.dumps({"prices": {"market": currency, "vintages": {"5": {"median": {"amount": 1, "type": "a\tb"}}}}})
    docs = docs_df(spark, [("wine-1-prices-.json", price({"currency": None})), ("wine-2-prices-.json", price({})),
                           ("wine-3-prices.json", price({"currency": {"prefix": "a\tb", "name": "c"}}))])
    got = {r["wine_id"]: (r["currency"], r["median__type"]) for r in rows(FL.flatten_prices(docs))}
    assert got == {1: (None, "a b"), 3: ("a b", "a b")}
    wine = {"id": 1, "name": "A\tB", "winery": {"id": 4, "name": "x\ty"}, "vintages": [{"id": "zz", "name": "v\tw"}]}
    bad = docs_df(spark, [("wines-4-0-1-.json", json.dumps({"wines": [wine]}))])
    r = FL.flatten_vintages(bad).first()
    assert (r["wine_name"], r["winery__name"], r["vintages__name"], r["vintages__id"]) == ("A B", "x y", "v w", None)
    assert FL.quarantine(bad, "wines").first()["reason"] == "bad_number"


def test_work_list_export_rejects_null_ids_and_merges_equal_ones(spark):
    def doc(*ids):
        return json.dumps({"wines": [{"id": i, "vintages": [{"id": 10 + n}]} for n, i in enumerate(ids)]})
    docs = docs_df(spark, [("wines-1-0-1-.json", doc(1, None)), ("wines-2-0-1-.json", doc(1, 1.0, "1", 2)),
                           ("wines-2-0-1-.json", doc(1))])
    assert sorted(r["line"] for r in rows(FL.worklist_lines(docs))) == ["1=10", "1=10,11,12", "2=13"]
    q = [r["reason"] for r in rows(FL.quarantine(docs, "worklist"), "file_name")]
    assert q == ["null_id", None, None]


def test_work_list_export_grows_in_step_with_one_document(spark):
    def seconds(n):
        body = json.dumps({"wines": [{"id": i, "vintages": [{"id": i}]} for i in range(n)]})
        docs = docs_df(spark, [("wines-1-0-1-.json", body)])
        t = time.perf_counter()
        assert FL.worklist_lines(docs).count() == n
        return time.perf_counter() - t
    seconds(1000)
    assert seconds(64_000) < 16 * max(1.0, seconds(16_000))


def test_numbered_lines_scan_the_text_once(spark, tmp):
    write_lines(spark.createDataFrame([("a",), ("b",)], "value string"), f"{tmp}/l")
    df = L.numbered_lines(spark, f"{tmp}/l")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "FileScan parquet" in plan
    assert sorted(r["value"] for r in L.read_lines(spark, f"{tmp}/l").collect()) == ["a", "b"]


def test_dense_index_splits_equal_order_keys(spark):
    df = spark.range(6000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id")
    got = dense_index(df, ["k"], n_partitions=6)
    assert sorted(r["idx"] for r in got.collect()) == list(range(6000))
    assert got.filter("k = 0").agg(F.max("idx")).first()[0] == 3999


def test_landed_rows_come_from_the_table(spark, tmp):
    docs = docs_df(spark, [("wine-1-reviews-page-1-.json", json.dumps({"reviews": []})), ("wine-2-reviews-page-1-.json", None)])
    land_raw(docs, f"{tmp}/raw", FL.REVIEWS_FILE_RE, page_group=2)
    again = land_raw(docs.limit(1), f"{tmp}/raw", FL.REVIEWS_FILE_RE, page_group=2)
    assert again.count() == 1 and spark.read.parquet(f"{tmp}/raw").count() == 3
    assert write_documents(docs, f"{tmp}/files") == 2


def test_a_hot_order_is_spread_over_wines_pages(spark, tmp):
    """One order holds a third of a supplier's lines: pages stay bounded."""
    from doclake.catalog.render import with_pages
    li = spark.range(9000).select(
        F.lit(1).alias("s"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("o"), (F.col("id") % 400).alias("p"),
        (F.col("id") % 7).alias("l"))
    sizes = [r["count"] for r in with_pages(li, "s", 1000, F.col("o") + F.col("l") + F.col("p")).groupBy("page").count().collect()]
    assert len(sizes) == 9 and max(sizes) < 2000


def test_distinct_keys_approximately(spark):
    from doclake.operators.wide import distinct_keys
    df = spark.range(40_000).select((F.col("id") % 5000).alias("k"))
    assert distinct_keys(df, "k").first()[0] == 5000
    assert abs(distinct_keys(df, "k", approx=True).first()[0] - 5000) < 250
