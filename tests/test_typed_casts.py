"""Guarded conversions equal plain ``try_cast``; generators get ready values."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from doclake.functions.values import to_int, typed
from doclake.plans.planning import page_names
from doclake.sources import lines as L

TEXTS = ["", " ", "1", " 1 ", "\t+7\n", "-0", "+", "-", ".", "1.", ".5", "1.9", "-1.9", "12.0", "1e3", "1E400", "5d", "5f", "0x10", "x1", "1x",
         "n/a", "NaN", "nan", "+nan", "-NaN", "Infinity", "-infinity", "+inf", "inf", "info", "2147483647", "2147483648", "-2147483649",
         "9223372036854775808", "99999999999999999999", "true", " T", "YES\t", "y", "no", "0", "all", "off", "2019-13-45", "2019-02-30",
         "2019", "2019-1", "2019-01-2", "2019-01-02T10:00", "2019-01-02 x", " 2019-12-31 ", "+2019-01-01", "-0001-01-01", "12019-01-01",
         "20190101", "2019-00-01", "2019-1-00", "2019-01-01\n", "2019-01-02T\n1", "\x7f3", " 1", "١", None]


@pytest.mark.parametrize("to", ["int", "bigint", "smallint", "float", "double", "decimal(10,2)", "date", "boolean", "timestamp"])
def test_typed_equals_try_cast(spark, to):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", typed("t", to).cast("string").alias("got"),
                                                                          F.col("t").try_cast(to).cast("string").alias("want"))
    assert not [r for r in df.collect() if r["got"] != r["want"]]


def test_to_int_equals_both_casts(spark):
    c = F.col("t")
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").select(
        "t", to_int("t").alias("got"), F.coalesce(c.try_cast("int"), c.try_cast("double").try_cast("int")).alias("want"))
    assert not [r for r in df.collect() if r["got"] != r["want"]]


def test_ids_of_log_digits(spark):
    df = spark.createDataFrame([(d,) for d in ("", "7", "2147483647", "2147483648", "10000000005", "9" * 30)], "d string")
    assert [r[0] for r in df.select(L.id_of(F.col("d"))).collect()] == [None, 7, 2147483647, None, None, None]


def test_generators_match_no_regexes(spark):
    lines = spark.range(4).select(F.concat(F.lit("wine ["), "id", F.lit("] HANDLED with 3 review pages")).alias("value"))
    names = lines.withColumnRenamed("value", "file_name")
    for df in (L.parse_success_log(lines), L.parse_not_found_log(lines), L.parse_work_list(lines), page_names(names)):
        text = io.StringIO()
        with redirect_stdout(text):
            df.explain()
        generators = [x for x in text.getvalue().splitlines() if "Generate explode" in x]
        assert generators and not [x for x in generators if any(f in x.lower() for f in ("regexp", "rlike", "split(", "cast("))]
