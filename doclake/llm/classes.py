"""Texts of chosen classes of documents, read again instead of shuffled."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import write_table

BITS = 27  # a bitmap of a fixed 16 MB; false hits only cost work


def row_key() -> object:
    """The row that stands for a class is known by its text's hash and id."""
    return F.xxhash64("th", "doc_id")


def representatives(rows: DataFrame) -> DataFrame:
    """(c, k) of each class in ``rows`` (doc_id, th, c): the smallest id's row."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("u"), "doc_id", "th")).alias("r")
    return rows.groupBy("c").agg(first).select("c", F.xxhash64("r.th", "r.doc_id").alias("k"))


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of the hashes ``k``, or-ed by words in Spark."""
    at = F.pmod("k", F.lit(1 << BITS))
    words = (keys.select(F.floor(at / 64).cast("int").alias("w"), (at % 64).cast("int").alias("b"))
             .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("v")).collect())
    out = np.zeros(1 << (BITS - 6), np.int64)
    for r in words:
        out[r["w"]] = r["v"]
    return out.view(np.uint64)


def items_of(docs: DataFrame, reps: DataFrame, classes: DataFrame,
             make: Callable[[list], tuple[list, np.ndarray, np.ndarray]], name: str) -> DataFrame:
    """(c, items), stored, for the rows that stand for ``classes`` (c).

    ``make(texts, text hashes)`` gives class ids, flat items and their bounds.
    A class may come more than once (equal rows in several tasks, false hits).
    """
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(reps.join(classes, "c").select("k")))

    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa
        seen, bits = set(), shared.value
        for b in batches:
            k = b.column("k").to_numpy()
            at = np.mod(k, 1 << BITS).astype(np.uint64)
            hit = np.flatnonzero((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1))
            hit = [i for i in hit.tolist() if not (k[i] in seen or seen.add(k[i]))]
            if len(seen) > 1 << 20:
                seen.clear()
            for i in range(0, len(hit), 256):
                part = b.take(pa.array(hit[i: i + 256]))
                c, flat, bounds = make(part.column("text").to_pylist(), part.column("th").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                                                       pa.array(flat.view(np.int64)))], names=["c", "items"])
    t = docs.select(F.xxhash64("text").alias("th"), "doc_id", "text").select("th", row_key().alias("k"), "text")
    return write_table(t.mapInArrow(task, "c long, items array<long>"), name)
