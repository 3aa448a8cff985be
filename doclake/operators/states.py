"""Coverage counts and distinct-id sketches kept per landing and merged.

A landing's rows are read once, when they arrive; a report adds up the stored
counts and unions the stored sketches (HyperLogLog), a few kilobytes per
landing, instead of reading the table again. Counts are exact. A sketch of
2^lg registers estimates distinct ids with a relative standard error of about
1.04 / sqrt(2^lg), after a union too; :func:`error_bound` is three times that.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def error_bound(lg: int) -> float:
    """Relative error that an estimate exceeds in about 1 of 400 cases."""
    return 3 * 1.04 / (1 << lg) ** 0.5


class CoverageStates:
    """States below ``path``, one partition per landing, replaced if a landing is added again.

    ``measures``: label -> predicate; ``ids``: label -> id column (integer,
    text or binary; NULL ids are not counted)."""

    def __init__(self, spark: SparkSession, path: str, measures: Mapping[str, Column], ids: Mapping[str, str], lg: int = 12):
        self.spark, self.path, self.measures, self.ids, self.lg = spark, path.rstrip("/"), dict(measures), dict(ids), lg

    def add(self, landing: str, rows: DataFrame) -> None:
        """One pass over the landing's rows; one small row is stored."""
        counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(f"n{i}") for i, c in enumerate(self.measures.values())]
        sketches = [F.hll_sketch_agg(c, F.lit(self.lg)).alias(f"h{i}") for i, c in enumerate(self.ids.values())]
        (rows.agg(*counts, F.count(F.lit(1)).alias("n"), *sketches)
         .write.mode("overwrite").parquet(f"{self.path}/landing={landing}"))

    def report(self, all_label: str = "all") -> DataFrame:
        """``(metric, n)``: the counts of all landings, all rows, and the estimates."""
        merged = self.spark.read.parquet(self.path).agg(
            *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(self.measures))], F.sum("n").alias("n"),
            *[F.hll_sketch_estimate(F.hll_union_agg(f"h{i}")).alias(f"h{i}") for i in range(len(self.ids))])
        names = [*[(m, f"n{i}") for i, m in enumerate(self.measures)], (all_label, "n"),
                 *[(m, f"h{i}") for i, m in enumerate(self.ids)]]
        return merged.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("bigint").alias("n"))
                                                for m, c in names])))
