"""Sharding by histogram sort.

Rows are ordered by a 128-bit key: the hash of the text, so equal texts lie
side by side, then a hash of the id, and a few bits that tell repeated rows
apart; how the input is partitioned does not matter. Only the narrow keys and sizes are
scanned while splitters are looked for: in each round every task counts the
exact bytes and rows below a set of probe keys, and the probes close in on
those splitters whose byte count is not yet within the tolerance. The same
rounds find finer cuts that bound the rows of a sort task. Then rows are
exchanged once, by range, and numbered in key order.

Defined cases: null text has 0 bytes; rows with equal text and id are told
apart by position and are interchangeable; an empty table gives an empty result; a shard without
rows is possible when there are fewer rows than shards. Other columns of the
input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import write_table

KEY_BITS = 128


def keyed_rows(docs: DataFrame) -> DataFrame:
    """(key, rid, doc_id, size, text_crc32): stored, one narrow row per document."""
    return keys_of(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text"))


def keys_of(rows: DataFrame) -> DataFrame:
    """``keyed_rows`` of numbered rows (rid, doc_id, text)."""
    t = rows.select("rid", "doc_id", F.coalesce("text", F.lit("")).alias("t"))
    part = lambda h, digits: F.substring(F.lpad(F.hex(h), 16, "0"), 1, digits)
    # big-endian unsigned: 64 bits of the text, 48 of the id, 16 of the row
    key = F.unhex(F.concat(part(F.xxhash64("t"), 16), part(F.xxhash64("doc_id", F.lit(7)), 12), part(F.xxhash64("rid", F.lit(9)), 4)))
    return write_table(t.select(key.alias("key"), "rid", "doc_id", (F.octet_length("t") + 16).cast("long").alias("size"),
                                F.crc32(F.encode("t", "utf-8")).alias("text_crc32")), "shard-keys")


def _as_key(value: int) -> bytes:
    return value.to_bytes(KEY_BITS // 8, "big")


def _pairs(keys: np.ndarray) -> np.ndarray:
    """16-byte keys as two unsigned numbers, in a form that sorts like the bytes."""
    raw = np.frombuffer(keys.tobytes(), dtype=">u8").reshape(-1, 2)
    out = np.empty(len(raw), dtype=[("a", "u8"), ("b", "u8")])
    out["a"], out["b"] = raw[:, 0], raw[:, 1]
    return out


def bucket_of(keys: list[bytes], probes: np.ndarray) -> np.ndarray:
    """Number of probes at or below each key (probes ascending, as _pairs)."""
    k = _pairs(np.frombuffer(b"".join(keys), dtype="V16"))
    lo, hi = np.searchsorted(probes["a"], k["a"], "left"), np.searchsorted(probes["a"], k["a"], "right")
    for i in np.flatnonzero(lo < hi):  # probes that share the key's first half
        lo[i] += np.searchsorted(probes["b"][lo[i]:hi[i]], k["b"][i], "right")
    return lo


def histogram(rows: DataFrame, probes: list[int]) -> tuple[list[int], list[int]]:
    """Exact (bytes, rows) below each probe, over all rows; one scan of the narrow table."""
    packed = _pairs(np.frombuffer(b"".join(map(_as_key, probes)), dtype="V16"))
    n = len(probes) + 1

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        size, number = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for b in batches:
            at = bucket_of(b.column("key").to_pylist(), packed)
            np.add.at(size, at, b.column("size").to_numpy())
            number += np.bincount(at, minlength=n)
        used = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(size[used]), pa.array(number[used])],
                                         names=["bucket", "size", "number"])
    got = (rows.select("key", "size").mapInArrow(count, "bucket long, size long, number long")
           .groupBy("bucket").agg(F.sum("size").alias("size"), F.sum("number").alias("number")).collect())
    size, number = np.zeros(n, object), np.zeros(n, object)
    for r in got:
        size[r["bucket"]], number[r["bucket"]] = r["size"], r["number"]
    return list(np.cumsum(size)[:-1]), list(np.cumsum(number)[:-1])


def find_splitters(rows: DataFrame, targets: list[int], tolerance: int, by: str = "size",
                   probes: int = 31) -> list[int]:
    """Keys with about ``targets[i]`` bytes (or rows) below them.

    A splitter is settled when a probe is within ``tolerance`` of its target
    or when no row lies between its two nearest probes. Every round cuts the
    open brackets by ``probes`` + 1, so there are at most 128 / 5 rounds.
    """
    top = 1 << KEY_BITS
    lo, hi = [0] * len(targets), [top] * len(targets)
    lo_n, hi_n = [0] * len(targets), [None] * len(targets)
    done: list[int | None] = [0 if t <= 0 else None for t in targets]
    while any(d is None for d in done):
        tried = sorted({lo[i] + (hi[i] - lo[i]) * j // (probes + 1) for i, d in enumerate(done) if d is None
                        for j in range(1, probes + 1)} - {0})
        size, number = histogram(rows, tried)
        below = dict(zip(tried, size if by == "size" else number, strict=True))
        count = dict(zip(tried, number, strict=True)) | {0: 0}
        for i, t in enumerate(targets):
            if done[i] is not None:
                continue
            inside = [p for p in tried if lo[i] < p < hi[i]]
            best = min(inside, key=lambda p: abs(below[p] - t), default=None)
            if best is not None and abs(below[best] - t) <= tolerance:
                done[i] = best
                continue
            for p in inside:
                if below[p] <= t:
                    lo[i], lo_n[i] = p, count[p]
                else:
                    hi[i], hi_n[i] = p, count[p]
                    break
            if hi[i] - lo[i] <= 1 or (hi_n[i] is not None and hi_n[i] - lo_n[i] <= 1):
                # at most one row in between: the nearer side
                ends = [p for p in (lo[i], hi[i]) if p in below]
                done[i] = min(ends, key=lambda p: abs(below[p] - t), default=hi[i])
    return sorted(min(d, top - 1) for d in done)


def shard_rows(rows: DataFrame, n_shards: int = 40, tolerance: float = 0.0005,
               rows_per_task: int = 200_000) -> DataFrame:
    """``keyed_rows`` with shard and slot (position in the shard, from 0)."""
    total = rows.agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).first()
    if not total["n"]:
        return rows.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long"))
    mean = total["s"] / n_shards
    cuts = find_splitters(rows, [round(mean * i) for i in range(1, n_shards)], int(mean * tolerance))
    tasks = max(n_shards * 2, -(-total["n"] // rows_per_task))
    fine = find_splitters(rows, [total["n"] * i // tasks for i in range(1, tasks)],
                          max(1, total["n"] // tasks // 4), by="rows")
    all_cuts = sorted({*cuts, *fine} - {0})
    _, below = histogram(rows, all_cuts)
    shard_of = [sum(1 for c in cuts if c <= k) for k in (0, *all_cuts)]
    starts = [0, *map(int, below)]
    first = {}
    for s, b in zip(shard_of, starts, strict=True):
        first.setdefault(s, b)
    packed = _pairs(np.frombuffer(b"".join(map(_as_key, all_cuts)), dtype="V16"))
    offset = np.array([b - first[s] for s, b in zip(shard_of, starts, strict=True)], np.int64)
    shard = np.array(shard_of, np.int32)

    def deal(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            at = bucket_of(b.column("key").to_pylist(), packed)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(at.astype(np.int32)), pa.array(shard[at]), pa.array(offset[at])],
                names=[*b.schema.names, "bin", "shard", "off"])
    kinds = "key binary, rid long, doc_id long, size long, text_crc32 long, bin int, shard int, off long"
    dealt = rows.mapInArrow(deal, kinds)
    # the only exchange of rows: by bin, a key range with a bounded number of rows
    w = Window.partitionBy("bin").orderBy("key")
    return dealt.withColumn("slot", F.col("off") + F.row_number().over(w) - 1).drop("bin", "off")


def write_shards(docs: DataFrame, path: str, **params) -> None:
    """Write the documents, one sorted folder per shard, as planned: columns
    ``shard`` (the folders) and ``slot`` are added; where the documents have
    such a column, it stays and the added one is called ``__shard`` or ``__slot``."""
    stored = write_table(docs.withColumn("__row", F.monotonically_increasing_id()), "shard-docs")
    shard, slot = ("__shard" if "shard" in docs.columns else "shard"), ("__slot" if "slot" in docs.columns else "slot")
    plan = shard_rows(keys_of(stored.select(F.col("__row").alias("rid"), "doc_id", "text")), **params)
    plan = write_table(plan.select(F.col("rid").alias("__row"), F.col("shard").alias(shard), F.col("slot").alias(slot)), "shard-plan")
    (stored.join(plan.hint("merge"), "__row").drop("__row").repartitionByRange(shard, slot).sortWithinPartitions(shard, slot)
     .write.partitionBy(shard).parquet(path))


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    """Query: all documents in 40 shards of nearly equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard_rows(keyed_rows(docs)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
