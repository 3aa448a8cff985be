"""Registered queries of the training-data operators against their SQL."""

import duckdb
import pytest
from .conftest import SF

from doclake.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = Q.queries()[name](spark, SF)
    res = con.execute(Q.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = sorted(map(str, res.fetchall()))
    assert sorted(df.columns) == sorted(cols)
    assert sorted(str(tuple(r)) for r in df.select(*cols).collect()) == want
