"""Page runs kept as state over captures that arrive in landings.

The state holds, per (wine, block of 512 page numbers), one byte per page up to
the block's last captured one: its best capture so far (ok, empty, failed or
none). Blocks are dealt by their hash into a fixed number of state keys, so a
landing costs a few calls per key, not per block; a wine with very many pages
is many blocks, spread over all keys. A landing updates the blocks that it
touches, late and repeated captures included, and emits their new bytes; the
sink keeps what every landing emitted, and a block's last row stands. The run
of a wine then comes from its blocks, one row per 512 pages, instead of from
all captures ever made.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

BLOCK = 512
NONE = 3  # worth of a page without a capture; 0 ok, 1 empty, 2 failed
CAPTURES = "wine_id long, page_no int, state string"
BLOCKS = "wine_id long, block int, pages binary"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


SLOTS = 4096  # state keys; fixed, as every checkpoint depends on it
EMIT = 10_000  # blocks a task holds as rows before it passes them on


def _stored(wine, block, n, data) -> bytes:
    """Blocks as one value: how many, their wines, numbers, lengths and pages."""
    import numpy as np
    return b"".join((np.int64(len(wine)).tobytes(), wine.tobytes(), block.tobytes(), n.tobytes(), data.tobytes()))


def _loaded(value: bytes | None):
    import numpy as np
    k = int(np.frombuffer(value, np.int64, 1)[0]) if value else 0
    value = value or bytes(8)
    return (np.frombuffer(value, np.int64, k, 8), np.frombuffer(value, np.int32, k, 8 + 8 * k),
            np.frombuffer(value, np.int32, k, 8 + 12 * k), np.frombuffer(value, np.uint8, -1, 8 + 16 * k)
            if len(value) > 8 + 16 * k else np.empty(0, np.uint8))


def best_of(value: bytes | None, wine, block, at, worth):
    """(new value, the changed blocks as (wine, block, pages)) for stored
    blocks and arrays of captures; the blocks of a value are ordered."""
    import numpy as np
    old_wine, old_block, old_n, old_data = _loaded(value)
    k = len(old_wine)
    wines, blocks = np.concatenate([old_wine, wine]), np.concatenate([old_block, block])
    order = np.lexsort((blocks, wines))
    w, b = wines[order], blocks[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (b[1:] != b[:-1])
    of = np.empty(len(w), np.int64)
    of[order] = np.cumsum(new) - 1  # the merged block of every stored block and capture
    w, b = w[new], b[new]
    n = np.zeros(len(w), np.int32)
    np.maximum.at(n, of, np.concatenate([old_n, at + 1]).astype(np.int32))
    begin = np.cumsum(n, dtype=np.int64) - n
    before = np.full(int(n.sum()), NONE, np.uint8)
    inside = np.arange(len(old_data)) - np.repeat(np.cumsum(old_n, dtype=np.int64) - old_n, old_n)
    before[np.repeat(begin[of[:k]], old_n) + inside] = old_data
    data = before.copy()
    np.minimum.at(data, begin[of[k:]] + at, worth)
    changed = np.unique(np.repeat(np.arange(len(w)), n)[data != before])
    none = bytes([NONE])
    return _stored(w, b, n, data), ((w[i], b[i], data[begin[i]:begin[i] + n[i]].tobytes().ljust(BLOCK, none)) for i in changed)


class BestCaptures(StatefulProcessor):
    """Per slot: the best capture of every page of its blocks, as bytes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.blocks = handle.getValueState("blocks", "data binary")

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        import itertools
        import numpy as np
        import pandas as pd
        new = pd.concat(list(rows))
        old = self.blocks.get()
        old = bytes(old[0]) if old else None
        data, changed = best_of(old, new["wine_id"].to_numpy(np.int64), new["block"].to_numpy(np.int32),
                                new["at"].to_numpy(np.int64), new["worth"].to_numpy(np.uint8))
        if data != old:
            self.blocks.update((data,))
        while part := list(itertools.islice(changed, EMIT)):
            yield pd.DataFrame(part, columns=["wine_id", "block", "pages"])

    def close(self) -> None:
        pass


def update_page_state(spark: SparkSession, captures: str, sink: str, checkpoint: str, partitions: int | None = None) -> None:
    """Take the capture files (Parquet, :data:`CAPTURES`) that arrived in the
    folder since the last run and append the blocks they changed to ``sink``.
    A batch that is run again replaces its own folder. ``partitions``, the
    number of state stores, is fixed by the first run (default: the cores)."""
    rows = spark.readStream.schema(CAPTURES).option("maxFileAge", "36500d").parquet(captures)
    page = F.col("page_no")
    worth = F.when(F.col("state") == "ok", 0).when(F.col("state") == "empty", 1).otherwise(2).cast("byte")
    keyed = rows.filter("wine_id is not null and page_no is not null").select(
        "wine_id", F.floor(page / BLOCK).cast("int").alias("block"), F.pmod(page, F.lit(BLOCK)).alias("at"), worth.alias("worth"))
    slot = F.pmod(F.xxhash64("wine_id", "block"), F.lit(SLOTS)).cast("int")
    changed = keyed.withColumn("slot", slot).groupBy("slot").transformWithStateInPandas(
        BestCaptures(), outputStructType=BLOCKS, outputMode="update", timeMode="none")

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number:08d}")
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
                "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():  # read when the stream starts
        spark.conf.set(k, v)
    try:
        q = (changed.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored_blocks(spark: SparkSession, sink: str) -> DataFrame:
    """``(wine_id, block, pages)`` as the last landing left them."""
    return (spark.read.schema(f"{BLOCKS}, batch string").parquet(sink).groupBy("wine_id", "block")
            .agg(F.max_by("pages", "batch").alias("pages")))


def runs_from_blocks(blocks: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`doclake.operators.responses.page_runs` from blocks.

    Each block of a wine from its start page on gives the first page that is
    not ok, if any, by one native search in its bytes; the least of these and of the
    first missing block is where the run stops."""
    if starts is None:
        starts = blocks.select("wine_id").distinct().withColumn("start_page", F.lit(1))
    else:
        starts = starts.groupBy("wine_id").agg(F.min("start_page").alias("start_page"))
    first = F.floor(F.col("start_page") / BLOCK).cast("int")
    b = blocks.join(starts, "wine_id").withColumn("first", first).filter(F.col("block") >= F.col("first"))
    begin = F.when(F.col("block") == F.col("first"), F.pmod("start_page", F.lit(BLOCK))).otherwise(F.lit(0))
    digits = F.regexp_replace(F.hex("pages"), "0(.)", "$1")  # one digit a page
    tail = F.substring(digits, begin + 1, F.lit(BLOCK))
    ok = F.length(tail) - F.length(F.ltrim(tail, F.lit("0")))  # ok pages in a row from the entry
    worth = F.substring(tail, ok + 1, F.lit(1))  # empty text: the whole block is ok
    stop = F.when(worth != "", F.struct((F.col("block") * BLOCK + begin + ok).alias("page"), worth.alias("worth")))
    nxt = b.select("wine_id", (F.col("block") - 1).alias("block"), F.lit(True).alias("has_next"))
    gap = F.when(F.col("has_next").isNull(), (F.col("block") + 1) * BLOCK)
    per = (b.join(nxt, ["wine_id", "block"], "left").groupBy("wine_id")
           .agg(F.min(stop).alias("bad"), F.min(gap).alias("gap"), F.max(F.col("block") == F.col("first")).alias("has_start")))
    s = starts.join(per, "wine_id", "left")
    edge = F.when(F.coalesce("has_start", F.lit(False)), F.col("gap")).otherwise(F.col("start_page"))
    end = F.least(edge, F.coalesce("bad.page", edge))
    kept = (end - F.col("start_page")).cast("int")
    done = F.coalesce(F.col("has_start") & (F.col("bad.page") == end) & (F.col("bad.worth") == "1"), F.lit(False))
    return s.select("wine_id", kept.alias("kept_pages"), done.alias("finished"), (kept + F.col("start_page") - 1).cast("int").alias("n_pages"))
