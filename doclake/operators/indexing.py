"""Dense row index and round-robin assignment without a single-partition
window.

``row_number() over (order by k)`` with no partition moves every row into one
task. Here the rows are range-partitioned on the order key (sampled bounds,
many tasks), sorted inside each partition, counted per partition (one row per
partition), and the prefix sums of those counts give each partition's first
index: the classic two-pass zip-with-index, on DataFrames.

The range-partitioned rows are checkpointed (reliable checkpoint in the
shared ``spark.checkpoint.dir``) before the two passes: the sampled bounds of
a shuffled input are not reproducible between two evaluations, a stored copy
is, and it also survives the loss of executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doclake.session import checkpoint_root


def dense_index(df: DataFrame, order_cols: list[str], index_col: str = "idx",
                n_partitions: int | None = None) -> DataFrame:
    """Add a 0-based index following ``order_cols``; rows with equal order
    values follow a hash of the whole row, so that they, too, are spread over
    the tasks and get a reproducible order (equal rows are interchangeable)."""
    spark = df.sparkSession
    n = n_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_root(spark)
    order = [*order_cols, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    ranged = (df.repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    # ``offsets`` has one row per partition: a bounded broadcast.
    return (ranged.join(F.broadcast(offsets.select("_pid", "_off", "_m0")), "_pid")
            .withColumn(index_col, F.col("_off") + F.col("_mid") - F.col("_m0"))
            .drop("_pid", "_mid", "_off", "_m0"))


def round_robin(plan: DataFrame, plan_order: list[str], targets: DataFrame, target_order: list[str],
                slot_col: str = "slot") -> DataFrame:
    """Assign plan rows to targets cyclically: the i-th plan row (by
    ``plan_order``) gets the (i mod n)-th target (by ``target_order``).

    The target list is indexed densely and counted (one scalar action); the
    assignment is an equi-join on the slot number, which Spark plans as a
    broadcast when the list is small and a shuffle join otherwise."""
    t = dense_index(targets, target_order, slot_col)
    n_targets = t.count()
    if n_targets == 0:  # nothing to assign to: no rows, same columns
        return plan.limit(0).select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                                           for f in targets.schema.fields])
    p = dense_index(plan, plan_order, "_i").withColumn(slot_col, F.pmod(F.col("_i"), F.lit(n_targets)))
    return p.join(t, slot_col).drop("_i", slot_col)
