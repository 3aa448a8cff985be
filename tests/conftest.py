import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from doclake.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="doclake-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def docs_df(spark, items):
    """Raw documents table from (file_name, body) pairs."""
    return spark.createDataFrame(items, "file_name string, body string")


def rows(df, *order):
    out = df.orderBy(*order).collect() if order else df.collect()
    return [r.asDict() for r in out]
