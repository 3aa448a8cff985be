"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are put in a hashed order and their words are cut
into blocks of equal size. Slot i of the mix takes the golden-ratio point
frac(i * phi); the cumulative target weights map it to a source, so every
prefix of the schedule follows the weights closely. The slots of a source
are ranked, and rank r takes block r mod (number of blocks): blocks repeat
only when all have been taken, at most ``max_passes`` times.

Defined cases: null text has no words; documents without words are in no
block and are taken 0 times; a null source is a source of its own, behind
the others; identical rows count as often as they occur; other columns are
ignored. The table of sources (one row each) is planning data held by the
driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import write_table

PHI = (5 ** 0.5 - 1) / 2
WEIGHTS = (5, 2, 1)  # fixed values: weights of the sources in order, repeating


def word_count(text: Column) -> Column:
    """Runs of characters other than blank and 0x09-0x0D."""
    inner = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     ")
    return F.size(F.array_remove(F.split(inner, " +"), "")).cast("long")


def targets(sizes: list[int], weights: list[float], total: float, max_passes: int) -> list[float]:
    """Shares of ``total`` by weight; a share stops at ``max_passes`` times its
    source's size and the excess is shared again by weight."""
    out = [0.0] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s > 0], float(total)
    while open_:
        w = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / w >= max_passes * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        for i in full:
            out[i] = float(max_passes * sizes[i])
        left -= sum(max_passes * sizes[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h), stored: ``h`` orders the documents of a source."""
    return write_table(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.xxhash64("doc_id", "text", F.lit(17)).alias("h")), "mix-docs")


def plan_sources(rows: DataFrame, block_words: int, min_blocks: int, max_passes: int) -> list[dict]:
    """One entry per source: size, rows, target, blocks, expected slots."""
    got = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    got = sorted(got, key=lambda r: (r["source"] is None, r["source"] or ""))  # text sorts by code point
    sizes = [r["size"] for r in got]
    want = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(got))], sum(sizes), max_passes)
    out = []
    for i, r in enumerate(got):
        block = max(1, min(block_words, r["size"] // min_blocks))
        blocks = -(-r["size"] // block)
        out.append({"src": i, "source": r["source"], "source_size": r["size"], "n": r["n"], "target": want[i],
                    "blocks": blocks, "slots": want[i] * blocks / r["size"] if r["size"] else 0.0})
    return out


def schedule(spark, plan: list[dict], max_passes: int, chunk: int = 1 << 16) -> DataFrame:
    """(slot, src, rank, block): the golden-ratio schedule.

    Chunks of slots are counted per source, the counts are summed up before
    each chunk, and ranks follow without a task that sees a whole source.
    """
    n = round(sum(p["slots"] for p in plan))
    edges = np.cumsum([p["slots"] for p in plan])
    edges = edges / edges[-1] if n else edges
    blocks = np.array([p["blocks"] for p in plan], np.int64)

    def sources(c: int) -> np.ndarray:
        i = np.arange(c * chunk, min((c + 1) * chunk, n), dtype=np.int64)
        hi, lo = i >> 20, i & ((1 << 20) - 1)  # keeps the fraction exact for many slots
        u = np.mod(hi * np.mod(PHI * (1 << 20), 1.0) + np.mod(lo * PHI, 1.0), 1.0)
        return np.minimum(np.searchsorted(edges, u, "right"), len(edges) - 1)

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            for c in b.column("id").to_pylist():
                k = np.bincount(sources(c), minlength=len(plan))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(plan), c)), pa.array(np.arange(len(plan))),
                                                  pa.array(k.astype(np.int64))], names=["c", "src", "k"])
    chunks = spark.range(0, -(-n // chunk))
    counts = write_table(chunks.mapInArrow(count, "c long, src long, k long"), "mix-counts")
    before = F.sum("k").over(Window.partitionBy("src").orderBy("c").rowsBetween(Window.unboundedPreceding, -1))
    starts = (counts.withColumn("at", F.coalesce(before, F.lit(0)))
              .groupBy("c").agg(F.collect_list(F.struct("src", "at")).alias("at")))

    def rank(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            for c, at in zip(b.column("c").to_pylist(), b.column("at").to_pylist(), strict=True):
                src = sources(c)
                base = np.zeros(len(plan), np.int64)
                for x in at:
                    base[x["src"]] = x["at"]
                order = np.argsort(src, kind="stable")
                s = src[order]
                first = np.searchsorted(s, s, "left")
                r = base[s] + np.arange(len(s)) - first
                ok = r < max_passes * blocks[s]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((order + c * chunk)[ok]), pa.array(s[ok].astype(np.int64)), pa.array(r[ok]),
                     pa.array((r % np.maximum(blocks[s], 1))[ok])], names=["slot", "src", "rank", "block"])
    return starts.mapInArrow(rank, "slot long, src long, rank long, block long")


def placed(rows: DataFrame, plan: list[dict], rows_per_bucket: int = 5_000) -> DataFrame:
    """Documents with ``src`` and ``at``, their first word's place in the
    source's hashed order; buckets of the hash keep a hot source in many tasks."""
    spark = rows.sparkSession
    meta = spark.createDataFrame(
        [(p["src"], p["source"], p["source_size"], p["target"], p["blocks"], max(1, -(-p["n"] // rows_per_bucket)))
         for p in plan], "src long, m_source string, source_size long, target double, blocks long, buckets long")
    d = (rows.join(meta, F.col("source").eqNullSafe(F.col("m_source"))).drop("m_source")
         .withColumn("bucket", F.expr("cast(floor((h / 18446744073709551616D + 0.5D) * buckets) as long)")))
    d = write_table(d, "mix-placed")
    sums = d.groupBy("src", "bucket").agg(F.sum("size").alias("sum"))
    prior = F.sum("sum").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    base = write_table(sums.select("src", "bucket", F.coalesce(prior, F.lit(0)).alias("base")), "mix-base")
    inner = F.sum("size").over(Window.partitionBy("src", "bucket").orderBy("h", "doc_id", "size")
                               .rowsBetween(Window.unboundedPreceding, -1))
    inside = d.withColumn("inner", F.coalesce(inner, F.lit(0)))
    return inside.join(base, ["src", "bucket"]).withColumn("at", F.col("base") + F.col("inner")).drop(
        "base", "inner", "bucket", "buckets")


def mix(docs: DataFrame, block_words: int = 4096, min_blocks: int = 512, max_passes: int = 3) -> tuple[DataFrame, DataFrame]:
    """(documents with size, source_size, target, taken; the mix: one row per
    slot and piece of a document, with the piece's words)."""
    rows = measured(docs)
    plan = plan_sources(rows, block_words, min_blocks, max_passes)
    if not plan:
        empty = rows.select("doc_id", "size", F.col("size").alias("source_size"), F.lit(0.0).alias("target"),
                            F.lit(0).cast("long").alias("taken"), "source", "h")
        return empty, rows.select(F.lit(0).alias("slot"), "doc_id", F.lit(0).alias("words"))
    d = write_table(placed(rows, plan), "mix-at")
    cut = lambda b: F.expr(f"cast({b} as decimal(38,0)) * source_size div blocks")
    # block b holds the words floor(b * size / blocks) up to the next block's first
    first = F.expr("cast(at as decimal(38,0)) * blocks div source_size")
    last = F.expr("cast(at + size - 1 as decimal(38,0)) * blocks div source_size")
    pieces = (d.filter("size > 0").withColumn("block", F.explode(F.sequence(first, last + 1)))
              .withColumn("lo", F.greatest("at", cut("block"))).withColumn("hi", F.least(F.expr("at + size"), cut("block + 1")))
              .filter("hi > lo and block < blocks"))
    slots = schedule(docs.sparkSession, plan, max_passes)
    mixed = write_table(pieces.join(slots, ["src", "block"]).select(
        "slot", "rank", "src", "at", "doc_id", (F.col("lo") - F.col("at")).alias("first_word"),
        (F.col("hi") - F.col("lo")).alias("words")), "mix-slots")
    taken = mixed.groupBy("src", "at").agg(F.sum("words").alias("taken"))
    out = d.join(taken.withColumnRenamed("src", "t_src").withColumnRenamed("at", "t_at"),
                 (F.col("src") == F.col("t_src")) & (F.col("at") == F.col("t_at")) & (F.col("size") > 0), "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                      "source", "h"), mixed


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    """Query: words that the mix takes of every document."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))[0].drop("source", "h")


def repeat_documents(docs: DataFrame, **params) -> DataFrame:
    """Whole documents, each as often as the mix takes its words, rounded."""
    cols = docs.columns
    per = mix(docs.select("doc_id", "text", "source"), **params)[0]
    # identical rows share their copies: the sum over them is dealt out evenly
    per = write_table(per.groupBy("doc_id", "h").agg(
        F.sum("taken").alias("__taken"), F.sum("size").alias("__size")).select(
            F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "__taken", "__size"), "mix-copies")
    d = docs.withColumn("__hash", F.xxhash64("doc_id", "text", F.lit(17)))
    n = F.when(F.col("__size") > 0, F.floor(F.col("__taken") / F.col("__size") + 0.5)).otherwise(F.lit(1)).cast("int")
    return (d.join(per, (F.col("__hash") == F.col("__h")) & F.col("doc_id").eqNullSafe(F.col("__id")))
            .withColumn("__copy", F.explode(F.array_repeat(F.lit(1), n))).select(*[d[c] for c in cols]))
