"""Documents are rendered with one exchange by their key, heavy keys by page."""

import io
from contextlib import redirect_stdout

import pytest

from doclake.catalog import docs as D
from doclake.catalog.render import price_docs, review_docs, wines_docs

LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    from datetime import datetime
    out = str(tmp_path_factory.mktemp("render"))
    day = datetime(1996, 3, 2)
    lines = [(o, p, s, i, float(5 + i), 10.0 * i, 0.1, 0.05, "N", "O", day)
             for o, n in ((5, 40), (6, 3), (7, 1), (8, 2), (99, 2)) for i in range(1, n + 1)
             for p, s in [(i % 5, (o + i) % 3 if o != 5 else 6)]]
    lines += [(None, 1, 1, 1, 1.0, 1.0, 0.1, 0.0, "N", "O", day), (5, None, None, None, 1.0, 1.0, 0.1, 0.0, "N", "O", day)]
    tables = {
        "lineitem": (lines, LINES),
        "orders": ([(o, o and o % 3, "F", 1.0, day, "1-URGENT") for o in (5, 6, 7, 8, 8, None)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "customer": ([(c, f"c{c}", c, 2.5, "AUTO") for c in (0, 1, 1)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(p, f"p {p}", "b", "t", p and p * 7, 3.5) for p in (0, 1, 2, 2, 3, None)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "supplier": ([(s, f"s{s}", s, 1.5) for s in (0, 1, 2, 6)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": ([(n, f"n{n}", 0) for n in range(7)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "r0")], "r_regionkey int, r_name string")}
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.mark.parametrize("make, n_pages", [(review_docs, 9), (wines_docs, 7)])
def test_heavy_keys_give_the_same_documents(spark, root, make, n_pages):
    # element order within a review page is free
    def found(**kw):
        return sorted((r["file_name"], "".join(sorted(r["body"]))) for r in make(spark, root, page_rows=5, **kw).collect())
    plain = found()
    assert plain == found(heavy_rows=4) and len({n for n, _ in plain if "-5-" in n or "-6-" in n}) >= n_pages


@pytest.mark.parametrize("make", [review_docs, wines_docs])
def test_pages_are_grouped_where_their_rows_were_counted(spark, root, make):
    text = io.StringIO()
    with redirect_stdout(text):
        make(spark, root).explain()
    moved = [x for x in text.getvalue().splitlines() if "Exchange hashpartitioning(" in x]
    assert not [x for x in moved if "page#" in x]  # neither paged rows nor structs are exchanged
    assert len([x for x in moved if "_deal#" in x]) == 1


def test_second_fetches_do_not_render_twice(spark, root):
    text = io.StringIO()
    with redirect_stdout(text):
        D.q_duplicate_vintage_keys(spark, root).explain()
    assert "Union" not in text.getvalue()


@pytest.mark.parametrize("make", [review_docs, wines_docs])
def test_large_facts_are_dealt_by_their_rows(spark, root, make):
    def found(df):
        return sorted((r["file_name"], "".join(sorted(r["body"]))) for r in df.collect())
    fact = spark.read.parquet(f"{root}/lineitem.parquet").count()
    docs = make(spark, root, page_rows=5, task_rows=2)
    # sorts and groups hold few rows, whatever the number of shuffle partitions
    assert docs.rdd.getNumPartitions() == -(-fact // 2) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found(docs) == found(make(spark, root, page_rows=5)) == found(make(spark, root, page_rows=5, task_rows=2, heavy_rows=4))


@pytest.mark.parametrize("make", [review_docs, wines_docs])
def test_customers_and_wineries_do_not_move_the_fact(spark, root, make):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = io.StringIO()
        with redirect_stdout(text):
            make(spark, root, task_rows=2).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # below the grouping: nation and region (fixed and tiny), the rows dealt by their key, once each side
    moved = [x for x in text.getvalue().splitlines() if "Exchange hashpartitioning(" in x]
    assert len([x for x in moved if "_deal#" in x and "REPARTITION_BY_NUM" in x]) == 2
    assert not [x for x in moved if "kind#" in x or "page#" in x]


def test_price_documents_of_a_large_fact_lie_where_their_lines_do(spark, tmp_path):
    """The same documents, with one exchange of the lines by part; parts with
    many lines are paired before the exchange."""
    import json
    from datetime import datetime
    day = datetime(1996, 3, 2)
    lines = [(o, p, s, 1, 1.0, 10.0 * o, 0.1 * (o % 3), 0.05, "N", "O", day)
             for p, n in ((0, 40), (1, 3), (2, 7), (3, 1), (None, 6)) for o in range(n) for s in [o % 4]]
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")

    def found(docs):
        return sorted((r["file_name"], json.dumps(json.loads(r["body"]), sort_keys=True)) for r in docs.collect())
    plain = found(price_docs(spark, str(tmp_path)))
    assert len(plain) == 5
    for heavy_rows in (2, 5, 6, 1000):
        assert found(price_docs(spark, str(tmp_path), task_rows=2, heavy_rows=heavy_rows)) == plain
    text = io.StringIO()
    with redirect_stdout(text):
        price_docs(spark, str(tmp_path), task_rows=2).explain()
    light = text.getvalue().split("LeftAnti")[0]
    assert light.count("Exchange hashpartitioning(") == 1 and "REPARTITION_BY_NUM" in light
