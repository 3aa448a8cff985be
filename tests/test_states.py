"""Stored states, id bitmaps and compaction against the plain operators."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from doclake.operators.states import CoverageStates, error_bound
from doclake.plans.bitmaps import backlog_counts, id_bitmaps, id_range_minus, size, union
from doclake.plans.planning import backlog_stats, range_plan
from doclake.sinks.landing import Landing
from doclake.sources.listing import list_tree
from test_landing import Broken, put


def test_states_merge_landings(spark, tmp):
    df = spark.range(20_000).select((F.col("id") % 7000).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    states = CoverageStates(spark, f"{tmp}/s", {"v": F.col("v").isNotNull()}, {"k": "k", "v ids": "v"}, lg=11)
    for i in range(4):
        states.add(f"l{i}", df.filter(F.pmod(F.xxhash64("v", "k"), F.lit(4)) == i))
    states.add("l2", df.filter(F.pmod(F.xxhash64("v", "k"), F.lit(4)) == 2))  # again: replaced
    got = {r["metric"]: r["n"] for r in rows(states.report())}
    v = df.filter("v is not null").count()
    assert got["all"] == 20_000 and got["v"] == v
    assert abs(got["k"] - 7000) <= error_bound(11) * 7000 and abs(got["v ids"] - v) <= error_bound(11) * v
    states.add("empty", df.limit(0))
    assert {r["metric"]: r["n"] for r in rows(states.report())} == got


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def test_bitmaps_hold_sets(spark):
    rng = random.Random(1)
    a = [rng.randrange(-70_000, 200_000) for _ in range(3000)] + [None, -2**31, 2**31 - 1, 0, -1, 32767, 32768]
    b = [rng.randrange(0, 100_000) for _ in range(3000)]
    assert size(id_bitmaps(ids(spark, a))).first()[0] == len({x for x in a if x is not None})
    both = union(id_bitmaps(ids(spark, a)), id_bitmaps(ids(spark, b)))
    assert size(both).first()[0] == len({x for x in a + b if x is not None})
    assert size(id_bitmaps(ids(spark, []))).first()[0] == 0


@pytest.mark.parametrize("lo,hi", [(1, 70_000), (-40_000, 40_000), (5, 5), (32767, 32768), (9, 8)])
def test_range_minus_equals_the_range_plan(spark, lo, hi):
    rng = random.Random(2)
    taken = [[rng.randrange(-50_000, 80_000) for _ in range(20_000)] + [None], [5, 32768]]
    sets = [ids(spark, t) for t in taken]
    got = sorted(r[0] for r in id_range_minus(spark, lo, hi, *sets).collect())
    assert got == sorted(r[0] for r in range_plan(spark, lo, hi, *sets).collect())
    assert id_range_minus(spark, lo, hi).count() == max(0, hi - lo + 1)


@pytest.mark.parametrize("listed,saved", [
    ([1, 1, 2, 70_000, None, None], [2, 2, 9]), ([None, 3], [None]), ([], [1]), ([1], []), ([], []), ([4, 5], [5, 4, 4])])
def test_backlog_counts_equal_the_stats(spark, listed, saved):
    frame = lambda v: ids(spark, v).withColumnRenamed("id", "wine_id")
    assert backlog_counts(frame(listed), frame(saved)).first() == backlog_stats(frame(listed), frame(saved)).first()


def test_bitmaps_exchange_buckets_not_ids(spark):
    plan = id_bitmaps(spark.range(10))._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan


def landings(spark, tmp, n):
    landing = Landing(spark, f"{tmp}/in", f"{tmp}/store", buckets=2)
    for i in range(n):
        for j in range(3):
            put(f"{tmp}/in", f"f{i}-{j}", b"%d" % (i * 10 + j))
        landing.run()
    return landing


def content(landing, *names):
    return sorted((r["path"], r["body"]) for r in rows(landing.documents(*names)))


def test_compaction_keeps_rows_and_lowers_files(spark, tmp, monkeypatch):
    landing = landings(spark, tmp, 4)
    want, names = content(landing), landing.finished()
    second = content(landing, names[1])
    before = list_tree(spark, f"{tmp}/store/documents", r"parquet$").count()
    with monkeypatch.context() as m:  # broken before the switch
        def fail(*a):
            raise Broken
        m.setattr("doclake.sinks.landing.make_folder", fail)
        with pytest.raises(Broken):
            landing.compact()
    assert content(landing) == want
    reader = landing.documents()  # a reader that began before the switch
    assert landing.compact() == [f"{names[0]}_{names[-1]}"] and landing.compact() == []
    assert content(landing) == want and content(landing, names[1]) == second
    assert sorted((r["path"], r["body"]) for r in rows(reader)) == want
    assert landing.vacuum() == names and content(landing) == want
    assert list_tree(spark, f"{tmp}/store/ranges", r"parquet$").count() == 1 < before
    put(f"{tmp}/in", "late", b"x")
    assert landing.run() is not None and len(content(landing)) == len(want) + 1
    assert landing.run() is None  # the manifest still knows the compacted files
    assert len(landing.export(f"{tmp}/out", lambda d: d.select("path"))) == 5
    assert spark.read.parquet(f"{tmp}/out").count() == len(want) + 1


def test_compaction_fills_bins_by_bytes(spark, tmp):
    landing = landings(spark, tmp, 5)
    sizes = {r["l"]: r["b"] for r in rows(list_tree(spark, f"{tmp}/store/documents").groupBy(
        F.substring_index("path", "/", 1).alias("l")).agg(F.sum("length").alias("b")))}
    names = landing.finished()
    made = landing.compact(target_bytes=sizes[names[0]] + sizes[names[1]])
    assert made[0] == f"{names[0]}_{names[1]}" and all(m.split("_")[0] >= names[2] for m in made[1:])
    assert len(content(landing)) == 15
