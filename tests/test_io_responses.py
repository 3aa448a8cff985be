"""Responses, sinks and sources: TSV, documents on disk, landing,
insert-if-absent, incremental ingest, HTML extraction, wide join."""

import json

from pyspark.sql import functions as F

from conftest import docs_df, rows
from doclake.functions.html import extract
from doclake.operators import responses as R
from doclake.operators.flatten import REVIEWS_FILE_RE, flatten_reviews
from doclake.operators.html import winery_addresses
from doclake.operators.names import duplicate_docs, name_ids
from doclake.operators.wide import coverage_counts, wide_join
from doclake.sinks.files import insert_if_absent, land_raw, write_documents
from doclake.sinks.tsv import write_tsv
from doclake.sources.files import list_files, read_documents
from doclake.sources.tsv import read_tsv
from doclake.streaming.incremental import ingest_available


def test_outcomes(spark):
    df = spark.createDataFrame([
        (200, None, None), (301, "/x", None), (302, None, None), (404, None, None), (None, None, "boom")],
        "status int, location string, error string")
    got = [r[0] for r in df.select(R.outcome(F.col("status"), F.col("location"), F.col("error"))).collect()]
    assert got == ["OK", "REDIRECT", "NO_REDIRECTION_HEADER", "BAD_RESPONSE", "ERROR"]


def test_elapsed_seconds_truncates(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00.9", "2024-01-01 00:00:07.5")], "a string, b string")
    assert df.select(R.elapsed_seconds(F.col("a").cast("timestamp"), F.col("b").cast("timestamp"))).first()[0] == 6


def test_page_runs_cases(spark):
    pages = spark.createDataFrame([
        (1, 1, "ok"), (1, 2, "ok"), (1, 3, "ok"), (1, 4, "empty"),          # finished, 3 pages
        (2, 1, "ok"), (2, 2, "ok"), (2, 3, "failed"),                       # 404 on 3: pages 1-2 kept
        (3, 4, "ok"), (3, 5, "ok"), (3, 6, "ok"), (3, 7, "empty"),          # resumed at 4: 6 pages
        (4, 1, "ok"), (4, 3, "ok"),                                         # gap: 1 page
        (5, 2, "ok"),                                                       # start page missing
    ], "wine_id int, page_no int, state string")
    starts = spark.createDataFrame([(1, 1), (2, 1), (3, 4), (4, 1), (5, 1)], "wine_id int, start_page int")
    got = {r["wine_id"]: (r["kept_pages"], r["finished"], r["n_pages"]) for r in R.page_runs(pages, starts).collect()}
    assert got == {1: (3, True, 3), 2: (2, False, 2), 3: (3, True, 6), 4: (1, False, 1), 5: (0, False, 0)}


def test_tsv_round_trip_exact(spark, tmp):
    vals = [(1, "a\tb", 'say "hi"'), (2, "line1\nline2\r\nline3", "back\\slash"), (3, "  edges  ", None),
            (4, None, "ünï code")]
    df = spark.createDataFrame(vals, "id int, a string, b string")
    write_tsv(df, f"{tmp}/t", line_breaks="keep")
    back = read_tsv(spark, f"{tmp}/t", "id int, a string, b string", multiline=True)
    assert sorted(map(tuple, back.collect())) == sorted(vals)


def test_tsv_typed_scan_bad_values_become_null(spark, tmp):
    raw = spark.createDataFrame([("1", "2.5", "2019-03-01", "true"), ("x", "n/a", "2019-13-45", "all")],
                                "a string, b string, c string, d string")
    write_tsv(raw, f"{tmp}/t")
    got = rows(read_tsv(spark, f"{tmp}/t", "a int, b float, c date, d boolean"), "a")
    assert [tuple(r.values()) for r in got][0] == (None, None, None, None)
    assert got[1]["a"] == 1 and got[1]["b"] == 2.5 and got[1]["d"] is True


def test_documents_on_disk_and_names(spark, tmp):
    docs = docs_df(spark, [("wine-1-reviews-page-1-.json", '{"reviews":[]}'), ("wines-2-0-1-.json", "{}"),
                           ("winary-3-some-place.html", "<p>x</p>\n<p>y</p>"), ("wine-4-prices.json", "{}"),
                           ("wine-4-prices-.json", "{}"), ("notes.txt", "n")])
    assert write_documents(docs, f"{tmp}/d") == 6
    back = {r["file_name"]: r["body"] for r in read_documents(spark, f"{tmp}/d").collect()}
    assert back["winary-3-some-place.html"] == "<p>x</p>\n<p>y</p>" and len(back) == 6
    only = read_documents(spark, f"{tmp}/d", name_regex=REVIEWS_FILE_RE)
    assert [r["file_name"] for r in only.collect()] == ["wine-1-reviews-page-1-.json"]
    kinds = {r["file_name"]: (r["kind"], r["id"], r["page"]) for r in name_ids(list_files(spark, f"{tmp}/d")).collect()}
    assert kinds["wine-1-reviews-page-1-.json"] == ("reviews", 1, 1)
    assert kinds["winary-3-some-place.html"] == ("html", 3, None)
    assert kinds["notes.txt"] == ("other", None, None)
    dup = rows(duplicate_docs(list_files(spark, f"{tmp}/d"), r"^wine-(\d+)-prices-?\.json$"))
    assert dup == [{"id": 4, "n_files": 2, "keep_file": "wine-4-prices-.json"}]


def test_land_raw_counts_elements(spark, tmp):
    docs = docs_df(spark, [("wine-1-reviews-page-2-.json", '{"reviews":[{"id":1},null,{"id":2}]}'),
                           ("wine-1-reviews-page-3-.json", "oops")])
    land_raw(docs, f"{tmp}/raw", REVIEWS_FILE_RE, page_group=2)
    got = {r["page"]: r["n_elements"] for r in spark.read.parquet(f"{tmp}/raw").collect()}
    assert got == {2: 3, 3: None}


def test_insert_if_absent(spark, tmp):
    b1 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b2 = spark.createDataFrame([(2, "x"), (3, "c")], "k int, v string")
    insert_if_absent(spark, f"{tmp}/t", b1, "k")
    ins, rej = insert_if_absent(spark, f"{tmp}/t", b2, "k")
    assert [tuple(r) for r in ins.collect()] == [(3, "c")] and [tuple(r) for r in rej.collect()] == [(2, "x")]
    assert sorted(map(tuple, spark.read.parquet(f"{tmp}/t").collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_incremental_ingest_takes_only_new_files(spark, tmp):
    def page(i):
        return json.dumps({"reviews": [{"id": i, "user": {"id": 1}, "vintage": {
            "id": 2, "statistics": {}, "wine": {"id": 3}}}]})
    write_documents(docs_df(spark, [(f"wine-{i}-reviews-page-1-.json", page(i)) for i in (1, 2)]), f"{tmp}/in")
    ingest_available(spark, f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck", flatten_reviews, REVIEWS_FILE_RE)
    assert spark.read.parquet(f"{tmp}/out").count() == 2
    write_documents(docs_df(spark, [("wine-3-reviews-page-1-.json", page(3)), ("junk.txt", "x")]), f"{tmp}/in")
    ingest_available(spark, f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck", flatten_reviews, REVIEWS_FILE_RE)
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp}/out").select("review_id").collect()) == [1, 2, 3]


WINERY_PAGE = """<html><body><span class="winery-page__header__winemaker">Winemaker: A. Person</span>
<div class="winery-page__contact__content__column">1 Street<br>Town &amp; Co</div>
<div class="winery-page__contact__content__column">www.example.org</div>
<div class="winery-page__contact__content__column"><p>a@example.org<p>b@example.org</div></body></html>"""


def test_winery_addresses(spark):
    pages = spark.createDataFrame([(1, "s1", WINERY_PAGE),
                                   (2, "s2", '<div class="winery-page__contact__content__column">only</div>'),
                                   (3, "s3", None)], "winery_id int, seo_name string, html string")
    got = {r["winery_id"]: tuple(r)[2:] for r in winery_addresses(pages).collect()}
    assert got[1] == ("A. Person", "1 Street Town & Co", "www.example.org", "a@example.org b@example.org")
    assert got[2] == ("", "only", "", "")
    assert got[3] == ("", "", "", "")


def test_html_text_skips_script_and_handles_unclosed(spark):
    html = '<title>A &amp; B</title><script>var t="</p>";</script><nav><ul><li>x<li>y</ul></nav><p>1<p>2'
    assert extract(html, ["title", "nav li", "p", "script"]) == [["A & B"], ["x", "y"], ["1", "2"], [""]]


def test_wide_join_and_coverage_invariant(spark):
    fact = spark.createDataFrame([(1, 10, 100, "n1"), (2, 10, 101, None), (3, None, 100, "n3"), (4, 11, 102, "n4")],
                                 "id int, vid int, sid int, note string")
    prices = spark.createDataFrame([(10, 1.5, "x"), (10, 2.5, "y")], "vid int, amount double, note string")
    vint = spark.createDataFrame([(100, "a"), (101, "b")], "sid int, name string")
    w = wide_join(fact, prices, vint, fact_price_key="vid", price_key="vid", fact_vintage_key="sid",
                  vintage_key="sid")
    assert w.columns == ["id", "sid", "note", "amount", "price_note", "vintage_sid", "name"]
    assert w.count() == 5  # row 3 dropped (NULL key), rows 1 and 2 fanned out to 2 prices each
    c = {r["metric"]: r["n"] for r in coverage_counts(w, {
        "a": F.col("amount").isNotNull(), "b": F.col("note").isNotNull(),
        "ab": F.col("amount").isNotNull() & F.col("note").isNotNull()}).collect()}
    assert c == {"a": 4, "b": 3, "ab": 2, "all": 5}
    assert c["ab"] <= min(c["a"], c["b"]) <= c["all"]


def test_html_legacy_entities_without_semicolon():
    assert extract("<title>A &amp B &lt C&amp;</title>", ["title"]) == [["A & B < C&"]]


def test_wide_coverage_matches_the_built_table(spark):
    from doclake.operators.wide import wide_coverage, wide_distinct_vintage_keys
    fact = spark.createDataFrame([(1, 10, 100, "n1"), (2, 10, 101, None), (3, None, 100, "n3"), (4, 11, 102, "n4"),
                                  (5, 10, None, "n5"), (6, 12, 100, None)],
                                 "id int, vid int, sid int, note string")
    prices = spark.createDataFrame([(10, 1.5), (10, None), (12, 3.0)], "pvid int, amount double")
    vint = spark.createDataFrame([(100, "a"), (101, None), (100, "c")], "vsid int, name string")
    keys = dict(fact_price_key="vid", price_key="pvid", fact_vintage_key="sid", vintage_key="vsid")
    measures = {"amount": ["amount"], "name": ["name"], "note": ["note"], "all3": ["amount", "name", "note"]}
    built = wide_join(fact, prices, vint, **keys)
    want = {r["metric"]: r["n"] for r in coverage_counts(built, {
        k: __import__("functools").reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cs])
        for k, cs in measures.items()}).collect()}
    got = {r["metric"]: r["n"] for r in wide_coverage(fact, prices, vint, **keys, measures=measures).collect()}
    assert got == want
    n = wide_distinct_vintage_keys(fact, vint, fact_price_key="vid", fact_vintage_key="sid",
                                   vintage_key="vsid").first()[0]
    assert n == built.select("vsid").distinct().dropna().count()


def test_tsv_reader_accepts_crlf_files(spark, tmp):
    with open(f"{tmp}/crlf.tsv", "w", newline="") as f:
        f.write('a\tb\r\n1\tx\r\n2\t"multi\r\nline"\r\n')
    got = sorted(map(tuple, read_tsv(spark, f"{tmp}/crlf.tsv", "a int, b string", multiline=True,
                                           line_sep=None).collect()))
    assert got[0] == (1, "x") and got[1][0] == 2 and got[1][1].startswith("multi")


def test_wide_join_keep_key(spark):
    fact = spark.createDataFrame([(1, 10, 100)], "id int, vid int, sid int")
    prices = spark.createDataFrame([(10, "x")], "vid int, p string")
    vint = spark.createDataFrame([(100, "a")], "sid int, name string")
    w = wide_join(fact, prices, vint, fact_price_key="vid", price_key="vid", fact_vintage_key="sid",
                  vintage_key="sid", keep_key=True)
    assert w.columns == ["id", "vid", "sid", "price_vid", "p", "vintage_sid", "name"]


def test_save_table_round_trip(spark, tmp):
    from doclake.sinks.tables import save_table
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "x")], "id int, v string, p string")
    back = save_table(df, f"{tmp}/t", partition_by=["p"])
    assert sorted((r["id"], r["v"], r["p"]) for r in back.collect()) == [(1, "a", "x"), (2, "b", "y"), (3, "c", "x")]


def test_wide_join_both_dimensions_on_the_same_fact_key(spark):
    from doclake.operators.wide import wide_coverage
    fact = spark.createDataFrame([(1, 70, "a"), (2, 70, None), (3, 71, "c"), (4, None, "d"), (5, 72, "e")],
                                 "review_id int, vintage_id int, note string")
    prices = spark.createDataFrame([(70, 1.0), (70, 2.0), (71, None)], "vintage_id int, amount double")
    vint = spark.createDataFrame([(70, "v70"), (72, "v72")], "vintages__id int, name string")
    keys = dict(fact_price_key="vintage_id", price_key="vintage_id", fact_vintage_key="vintage_id",
                vintage_key="vintages__id")
    w = wide_join(fact, prices, vint, **keys)
    assert w.columns == ["review_id", "note", "amount", "vintages__id", "name"]
    got = sorted(tuple(r) for r in w.collect())
    assert got == [(1, "a", 1.0, 70, "v70"), (1, "a", 2.0, 70, "v70"), (2, None, 1.0, 70, "v70"),
                   (2, None, 2.0, 70, "v70"), (3, "c", None, None, None), (5, "e", None, 72, "v72")]
    measures = {"amount": ["amount"], "note": ["note"], "both": ["amount", "note"]}
    c = {r["metric"]: r["n"] for r in wide_coverage(fact, prices, vint, **keys, measures=measures).collect()}
    assert c == {"amount": 4, "note": 4, "both": 2, "all": 6}


def test_batch_ingest_skips_landed_documents(spark, tmp):
    first = docs_df(spark, [("a.json", "{}"), ("b.json", "{}")])
    second = docs_df(spark, [("b.json", "{}"), ("c.json", "{}")])
    insert_if_absent(spark, f"{tmp}/raw", first, "file_name")
    new, seen = insert_if_absent(spark, f"{tmp}/raw", second, "file_name")
    assert [r[0] for r in new.select("file_name").collect()] == ["c.json"]
    assert [r[0] for r in seen.select("file_name").collect()] == ["b.json"]


def test_page_runs_fold_captures_before_the_exchange(spark):
    """Against a plain walk over pages, at block borders, with long, negative
    and unknown pages; repeated captures and the next page need no exchange."""
    import random
    rng, caps, starts = random.Random(9), [], []
    for wine in range(60):
        at = rng.choice([1, 1, 30, 31, 32, 33, 64, -40, -1, 0, 2 ** 30 - 2])
        n = rng.choice([0, 1, 2, 30, 31, 32, 33, 63, 64, 65, 100])
        caps += [(wine, at + i, "ok") for i in range(n)] + [(wine, at + i, "failed") for i in range(0, n, 3)]
        caps += [(wine, at + n + rng.choice([0, 0, 0, 1, 32]), rng.choice(["ok", "empty", "failed", None]))]
        caps += [(wine, at + n + 40 + i, rng.choice(["ok", "empty"])) for i in range(rng.choice([0, 5]))]
        starts += [(wine, at + rng.choice([0, 0, 0, 5, 31, 32, -1]))]
    caps += [(None, 1, "ok"), (70, None, "ok"), (71, 1, "ok")]
    starts += [(70, 1), (71, None), (72, 4), (None, 1), (0, 2 ** 41)]
    rng.shuffle(caps)
    best, rank = {}, {"ok": 0, "empty": 1}
    for wine, page_no, state in caps:
        best[wine, page_no] = min(best.get((wine, page_no), 2), rank.get(state, 2))
    want = {72: (0, False), 70: (0, False), 71: (None, False), None: (0, False)}
    for wine, begin in starts[:60]:
        end = begin
        while best.get((wine, end)) == 0:
            end += 1
        want[wine] = (end - begin, best.get((wine, end)) == 1)
    got = R.page_runs(spark.createDataFrame(caps, "wine_id long, page_no long, state string"),
                    spark.createDataFrame(starts, "wine_id long, start_page long"))
    plan = got._jdf.queryExecution().explainString(got.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert plan.count("Exchange hashpartitioning(wine_id") + plan.count("Exchange hashpartitioning(block") <= 4
    assert {r["wine_id"]: (r["kept_pages"], r["finished"]) for r in got.collect()} == want
