"""One key holding a large share of the rows: results stay exact."""

from pyspark.sql import functions as F

from doclake.operators import responses as R
from doclake.operators.wide import coverage_counts, wide_coverage, wide_join
from doclake.plans import planning as P


def test_page_runs_with_one_wine_owning_most_pages(spark):
    hot = spark.range(1, 30001).select(F.lit(1).alias("wine_id"), F.col("id").cast("int").alias("page_no"),
                                       F.when(F.col("id") == 30000, "empty").otherwise("ok").alias("state"))
    cold = spark.range(2, 1002).select(F.col("id").cast("int").alias("wine_id"), F.lit(1).alias("page_no"),
                                       F.lit("failed").alias("state"))
    got = {r["wine_id"]: (r["kept_pages"], r["finished"]) for r in R.page_runs(hot.unionByName(cold)).collect()}
    assert got[1] == (29999, True)
    assert all(got[w] == (0, False) for w in range(2, 1002))


def test_coverage_with_a_hot_fact_key(spark):
    fact = spark.range(0, 30000).select(
        F.col("id").alias("rid"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") % 500).cast("int")).alias("vid"),
        F.when(F.col("id") % 3 == 0, F.lit(70)).otherwise((F.col("id") % 40).cast("int")).alias("sid"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.lit("n")).alias("note"))
    prices = spark.range(0, 500).select(F.col("id").cast("int").alias("pvid"),
                                        F.when(F.col("id") % 2 == 0, F.lit(1.0)).alias("amount"))
    vint = spark.range(0, 80).select(F.col("id").cast("int").alias("vsid"), F.lit("x").alias("name"))
    keys = dict(fact_price_key="vid", price_key="pvid", fact_vintage_key="sid", vintage_key="vsid")
    measures = {"a": ["amount"], "n": ["note"], "b": ["name"], "all3": ["amount", "note", "name"]}
    built = wide_join(fact, prices, vint, **keys)
    want = {r["metric"]: r["n"] for r in coverage_counts(built, {
        "a": F.col("amount").isNotNull(), "n": F.col("note").isNotNull(), "b": F.col("name").isNotNull(),
        "all3": F.col("amount").isNotNull() & F.col("note").isNotNull() & F.col("name").isNotNull()}).collect()}
    got = {r["metric"]: r["n"] for r in wide_coverage(fact, prices, vint, **keys, measures=measures).collect()}
    assert got == want and got["all"] == 30000


def test_backlog_with_a_hot_id(spark):
    listed = spark.range(0, 20000).select(F.when(F.col("id") % 3 == 0, F.lit(1))
                                          .otherwise(F.col("id").cast("int")).alias("wine_id"))
    saved = spark.range(0, 100).select(F.col("id").cast("int").alias("wine_id"))
    got = P.backlog_stats(listed, saved).first()
    distinct_listed = {1 if i % 3 == 0 else i for i in range(20000)}
    assert (got["rows_to_load"], got["rows_saved"]) == (20000, 100)
    assert got["distinct_not_loaded"] == len(distinct_listed - set(range(100)))
