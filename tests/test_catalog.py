"""Every catalogue query against its SQL oracle (DuckDB) on the smallest
data set, and the driver entry points."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import duck, frame_hash  # noqa: E402

import __spark_entry__ as entry_mod  # noqa: E402
from doclake import catalog  # noqa: E402

ROOT = "/root/testdata/sf0.001"
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(f"{ROOT}/lineitem.parquet"):
        pytest.skip("test data not present")
    return duck(ROOT)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry_mod.queries())


def test_entry(spark, con):
    df = entry_mod.entry(spark)
    got = {r["metric"]: r["n"] for r in df.collect()}
    assert set(got) == {"p_retailprice", "s_name", "s_name and p_retailprice", "all"}
    assert got["s_name and p_retailprice"] <= min(got["p_retailprice"], got["s_name"]) <= got["all"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = catalog.queries()[name](spark, ROOT)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(catalog.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = [tuple(r) for r in res.fetchall()]
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert frame_hash(srows, scols) == frame_hash(drows, dcols)
