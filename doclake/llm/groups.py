"""Joining rows with figures of their group when a few groups hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most this many groups can hold more than 1 / MOST of all rows each.
MOST = 10_000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int,
                null_keys: bool = False) -> DataFrame:
    """``rows`` with the other columns of ``groups`` (one row per key).

    ``null_keys``: null is a key like any other (else it must not occur; plain
    equality lets a bucketed table of groups stay where it is).
    Groups of more than ``total / MOST`` rows, of which there are fewer than
    ``MOST`` whatever the data, are broadcast; the others are joined by
    sorting, where no key can weigh more than that share. ``size`` names the
    groups' row count, ``total`` is the sum of it.
    """
    others = [c for c in groups.columns if c != key]
    g = groups.withColumnRenamed(key, f"{key}__group")
    hot = F.broadcast(g.filter(F.col(size) * MOST > total))
    same = F.col(key).eqNullSafe(F.col(f"{key}__group")) if null_keys else F.col(key) == F.col(f"{key}__group")
    many = rows.join(hot, same).select(*rows.columns, *others)
    few = (rows.join(hot.select(f"{key}__group"), same, "left_anti")
           .join(g.filter(F.col(size) * MOST <= total).hint("merge"), same).select(*rows.columns, *others))
    return many.unionByName(few)
