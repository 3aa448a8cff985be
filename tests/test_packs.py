"""Documents kept many to a file: the same rows as one file each, by every reader."""

import os
import tempfile
import time
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from doclake import packs
from doclake.sinks.files import write_documents
from doclake.sinks.landing import Landing
from doclake.sources.files import read_documents
from doclake.sources.listing import list_tree, read_listed
from doclake.streaming.incremental import ingest_available


def some_docs(spark, lo, hi):
    body = F.when(F.col("id") % 7 != 0, F.concat(F.lit("é\r\n𝛼 "), F.col("id").cast("string")))
    return spark.range(lo, hi, 1, 3).select(F.format_string("wine-%d-%%20 -.json", "id").alias("file_name"), body.alias("body"))


def found(folder):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if not f.startswith("."))


def filled(docs):
    return rows(docs.select("file_name", F.coalesce("body", F.lit("")).alias("body")), "file_name")


@pytest.mark.parametrize("fan_out", [0, 4])
def test_few_files_hold_all_documents(spark, tmp, fan_out):
    docs = some_docs(spark, 0, 500)
    assert write_documents(docs, f"{tmp}/f", fan_out=fan_out, packed=True) == 500
    assert len(found(f"{tmp}/f")) == 3  # one per task, not one per document
    write_documents(spark.createDataFrame([("plain.txt", "x")], "file_name string, body string"), f"{tmp}/f", fan_out=fan_out)
    listing = list_tree(spark, f"{tmp}/f")
    want = filled(docs) + [{"file_name": "plain.txt", "body": "x"}]
    want.sort(key=lambda r: r["file_name"])
    assert filled(read_listed(spark, f"{tmp}/f", listing)) == want
    sizes = {r["file_name"]: r["length"] for r in listing.collect()}
    assert sizes == {r["file_name"]: len(r["body"].encode()) for r in want}
    assert list_tree(spark, f"{tmp}/f", r"^wine-7-").count() == 1
    if not fan_out:
        assert filled(read_documents(spark, f"{tmp}/f", packs=True)) == want
        assert read_documents(spark, f"{tmp}/f", glob="wine-1[0-9]-*.json", packs=True).count() == 10
        assert read_documents(spark, f"{tmp}/f", name_regex="^plain|^wine-3-", packs=True).count() == 2


def test_packs_are_bounded():
    some = [(str(i), b"x" * 10) for i in range(10)]
    assert [n for n, _ in packs.packed(some, files=4)] == [4, 4, 2]
    assert [n for n, _ in packs.packed(some, size=25)] == [3, 3, 3, 1]
    assert list(packs.packed([])) == []


def test_what_is_not_a_whole_pack_is_not_read(spark, tmp):
    write_documents(some_docs(spark, 0, 20), f"{tmp}/f", packed=True)
    with open(f"{tmp}/f/.half", "wb") as f:  # a task that did not end
        f.write(b"PK")
    os.makedirs(f"{tmp}/f/real.docs.zip")
    with open(f"{tmp}/f/real.docs.zip/a", "wb") as f:  # a folder of that name
        f.write(b"b")
    listing = list_tree(spark, f"{tmp}/f")
    assert listing.count() == 21
    assert {r["file_name"]: r["body"] for r in read_listed(spark, f"{tmp}/f", listing).collect()}["a"] == "b"


def test_landing_takes_packed_documents_once(spark, tmp):
    for i in range(2):
        write_documents(some_docs(spark, 30 * i, 30 * i + 30), f"{tmp}/f", fan_out=2, packed=True, age_days=90 * i)
        landing = Landing(spark, f"{tmp}/f", f"{tmp}/store", buckets=2)
        assert landing.run() is not None
    assert landing.run() is None
    assert filled(landing.documents()) == filled(some_docs(spark, 0, 60))


def test_stream_takes_packs_once_whatever_their_age(spark, tmp):
    for i in range(3):
        write_documents(some_docs(spark, 30 * i, 30 * i + 30), f"{tmp}/f", packed=True, age_days=90 * i)
        if i:
            assert min(os.path.getmtime(p) for p in found(f"{tmp}/f")) < time.time() - 80 * i * 86400
        ingest_available(spark, f"{tmp}/f", f"{tmp}/out", f"{tmp}/ck", lambda d: d, "json$", packs=True)
    assert filled(spark.read.parquet(f"{tmp}/out")) == filled(some_docs(spark, 0, 90))


def test_catalogue_lands_json_documents_in_packs(spark, tmp):
    from datetime import datetime

    from doclake.catalog.misc import q_doc_scan, q_filename_ids
    from doclake.session import checkpoint_root
    day = datetime(1996, 3, 2)
    tables = {
        "lineitem": ([(o, o % 9, o % 4, i, 5.0, 10.0, 0.1, 0.05, "N", "O", day) for o in range(1, 61) for i in (1, 2)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": ([(o, 1, "F", 1.0, day, "1-URGENT") for o in range(1, 61)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "customer": ([(1, "c1", 1, 2.5, "AUTO")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(p, f"p {p}", "b", "t", p, 3.5) for p in range(9)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "supplier": ([(s, f"s{s}", 0, s - 1.5) for s in range(4)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": ([(0, "n0", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "r0")], "r_regionkey int, r_name string"),
        "pages": ([(7, "http://h.x/a", "<p>seven")], "page_id long, url string, html string")}
    for name, (values, ddl) in tables.items():
        spark.createDataFrame(values, ddl).write.parquet(f"{tmp}/{name}.parquet")
    base = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(base))
    got = {r["kind"]: (r["n_files"], r["html_chars"]) for r in q_doc_scan(spark, tmp).collect()}
    assert got == {"reviews": (60, None), "wines": (4, None), "prices": (9, None), "html": (1, 8), "wines_loose": (2, None),
                   "other": (1, None)}
    ids = q_filename_ids(spark, tmp)
    assert ids.count() == 60 + 4 + 9 + 1 + 2 + 1 and ids.filter("kind = 'reviews' and max_page = 1").count() == 60
    for folder in (f"{base}/{d}" for d in set(os.listdir(base)) - before if d.startswith("mixed-")):
        loose = [p for p in found(folder) if not p.endswith(packs.SUFFIX)]
        names = [n for p in found(folder) if p.endswith(packs.SUFFIX) for n in zipfile.ZipFile(p).namelist()]
        assert len(loose) == 4 and len(names) == len(set(names)) == 73


def test_documents_are_compressed_together_and_read_alone():
    import io
    import random

    import pyarrow.fs as pafs
    draw = random.Random(4)
    some = [(f"wine-{i}.json", "".join(f'{{"rating": {draw.random()}, "language": "en", "vintage": null}}' for _ in range(8)).encode())
            for i in range(3000)]  # several blocks
    (n, data), = packs.packed([*some, ("empty", b"")])
    assert n == 3001
    alone = io.BytesIO()
    with zipfile.ZipFile(alone, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in some:
            z.writestr(name, body)
    assert len(data) < 0.9 * len(alone.getvalue())
    pack = packs.Pack(data)
    names = [name for name, _ in some]
    draw.shuffle(names)
    assert {name: pack.read(name) for name in names} == dict(some) and pack.read("empty") == b""
    assert pack.in_order(names) == [name for name, _ in some]
    plain = packs.Pack(alone.getvalue())  # any zip file is a pack
    assert [(name, plain.read(name)) for name in plain.names()] == some
    for got in (data, alone.getvalue()):
        with open(f"{tempfile.mkdtemp(prefix='packs-')}/x.docs.zip", "wb") as f:
            f.write(got)
        lengths = dict(packs.entries(pafs.LocalFileSystem(), f.name))
        assert all(lengths[name] == len(body) for name, body in some)


def test_shuffle_files_go_with_the_written_step(spark, tmp):
    from pyspark.sql import functions as F

    from doclake.session import REMOVE_SHUFFLES, shuffles_removed
    before, seen = spark.conf.get(REMOVE_SHUFFLES, None), []
    statuses = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    for inside in (False, True):
        rows = spark.range(2000).repartition(3, F.col("id") % 7)
        held = statuses.getAllFiles().size()
        if inside:
            with shuffles_removed(spark):
                rows.write.parquet(f"{tmp}/{inside}")
        else:
            rows.write.parquet(f"{tmp}/{inside}")
        for _ in range(50):  # files go in the background
            seen.append(statuses.getAllFiles().size() - held)
            if inside == (seen[-1] <= 0):
                break
            time.sleep(0.1)
        assert inside == (seen[-1] <= 0)
        assert spark.read.parquet(f"{tmp}/{inside}").count() == 2000
    assert spark.conf.get(REMOVE_SHUFFLES, None) == before


def test_a_wave_of_documents_holds_the_wanted_orders_alone(spark, tmp):
    from datetime import datetime

    from doclake.catalog.render import review_docs
    from doclake.sinks.tables import save_table
    day = datetime(1996, 3, 2)
    tables = {
        "lineitem": ([(o, (o or 5) % 9, (o or 5) % 4, i, 5.0, 0.05, "N", "O", day) for o in [*range(1, 41), None] for i in range(1, 8) if o is not None or i < 3],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_tax double, "
                     "l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": ([(o, 1, "1-URGENT") for o in range(1, 41)], "o_orderkey long, o_custkey long, o_orderpriority string"),
        "customer": ([(1, "c1", 1, 2.5, "AUTO")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(p, f"p {p}", "b", p, 3.5) for p in range(9)],
                 "p_partkey long, p_name string, p_brand string, p_size int, p_retailprice double"),
        "supplier": ([(s, f"s{s}", 0) for s in range(4)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": ([(0, "n0", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "r0")], "r_regionkey int, r_name string")}
    for name, (values, ddl) in tables.items():
        spark.createDataFrame(values, ddl).write.parquet(f"{tmp}/{name}.parquet")

    def docs(**params):
        return {r["file_name"]: sorted(r["body"]) for r in review_docs(spark, tmp, page_rows=3, **params).collect()}
    every = docs()
    waves = [docs(heavy_rows=heavy, wanted=F.pmod("l_orderkey", F.lit(2)) == w) for w, heavy in ((0, 100), (1, 5))]
    assert len(waves[0]) + len(waves[1]) == len(every) and waves[0] | waves[1] == every
    assert all(int(name.split("-")[1]) % 2 == w for w in (0, 1) for name in waves[w])
    none = save_table(spark.range(0).withColumn("wave", F.lit(1)), f"{tmp}/none", partition_by=["wave"])
    assert none.filter("wave = 1").count() == 0
