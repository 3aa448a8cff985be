"""Quoted records with line breaks, read by several tasks."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from doclake.sinks.tsv import write_tsv
from doclake.sources.records import numbered_records, read_quoted_tsv
from doclake.sources.tsv import read_tsv

DDL = "i int, a string, b string"


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def table(spark, n=400):
    rng = random.Random(2)
    bits = ["a", "é日", "\n", "\r\n", "\r", "\t", '"', '""', "\n\n", " ", "\\", "end\\", '"\n"', "x" * 300]
    value = lambda: None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randrange(1, 12)))
    return spark.createDataFrame([(i, value(), value()) for i in range(n)], DDL)


@pytest.mark.parametrize("header", [True, False])
def test_several_tasks_equal_the_multi_line_read(spark, tmp, small_splits, header):
    df = table(spark)
    write_tsv(df.coalesce(2), f"{tmp}/t", header=header, line_breaks="keep")
    got = read_quoted_tsv(spark, f"{tmp}/t", DDL, header=header)
    assert spark.read.text(f"{tmp}/t").rdd.getNumPartitions() > 4
    want = rows(read_tsv(spark, f"{tmp}/t", DDL, header=header, multiline=True), "i")
    assert rows(got, "i") == want and len(want) == 400
    assert [r["a"] for r in want] == [r["a"] for r in rows(df, "i")]


@pytest.mark.parametrize("header", [True, False])
def test_records_that_end_with_cr_lf(spark, tmp, small_splits, header):
    """Files of another tool: CR LF after records, line breaks of all kinds within."""
    lines, want = [], []
    for i in range(300):
        a = random.Random(i).choice(["plain", "two\r\nlines", "lf\nonly", 'say ""x""\r\n\r\n', "\r\n", "tab\there"])
        want.append((i, a.replace('""', '"'), "z"))
        lines.append(f'{i}\t"{a}"\tz')
    text = ("i\ta\tb\r\n" if header else "") + "\r\n".join(lines) + "\r\n"
    import os
    os.makedirs(f"{tmp}/t")
    with open(f"{tmp}/t/one.tsv", "w", newline="") as f:
        f.write(text)
    got = rows(read_quoted_tsv(spark, f"{tmp}/t", DDL, header=header, crlf=True), "i")
    assert [tuple(r.values()) for r in got] == want
    multi = rows(read_tsv(spark, f"{tmp}/t", DDL, header=header, multiline=True, line_sep="\r\n"), "i")
    assert got == multi


def test_records_longer_than_splits(spark, tmp, small_splits):
    df = spark.createDataFrame([(1, "x\n" * 20_000, "y"), (2, "z", "\n" * 9000), (3, None, "q")], DDL)
    write_tsv(df.coalesce(1), f"{tmp}/t", line_breaks="keep")
    assert rows(read_quoted_tsv(spark, f"{tmp}/t", DDL), "i") == rows(df, "i")


def test_odd_files(spark, tmp):
    import os
    os.makedirs(f"{tmp}/t")
    for name, text in (("empty", ""), ("header", "i\ta\tb\n"), ("no-end", "i\ta\tb\n1\tx\ty"), ("open", 'i\ta\tb\n2\t"x\ny'),
                       ("short", "i\ta\tb\n3\n\n4\tx\ty\tmore\n")):
        with open(f"{tmp}/t/{name}", "w", newline="") as f:
            f.write(text)
    got = rows(read_quoted_tsv(spark, f"{tmp}/t", DDL).select("i", "a"), "i")
    assert [(r["i"], r["a"]) for r in got] == [(1, "x"), (2, "x\ny"), (3, None), (4, "x")]


def test_single_lines_are_not_exchanged(spark, tmp):
    write_tsv(table(spark, 50), f"{tmp}/t", line_breaks="keep")
    numbered = numbered_records(spark, f"{tmp}/t")
    alone = numbered.filter(~F.col("record").contains("\n"))
    assert alone.count() > 0
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the pieces of broken records
