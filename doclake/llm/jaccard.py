"""Exact Jaccard self-join of documents over word shingles, in metric space.

Jaccard distance d = 1 - similarity is a metric; two documents link when
d <= 1 - threshold. Documents with equal shingle sets form one class first.

1. Seed regions. The first pivots are the single shingles, in a global order
   with frequent ones last (from a fixed-size counting sketch of all
   documents). A class lies nearest to its first shingle and, as a boundary
   document, in the window of the next ones: if a partner lacked the first
   floor((1 - threshold) * n) + 1 of them, its distance would exceed the
   bound, so a linked pair meets in at least one region.
2. In a region, the class whose windows are shared most becomes the pivot and
   every other member's exact distance to it is taken; members within the
   bound link to it. Regions of few members are compared directly; pairs that
   cannot reach the threshold by the windows' own overlap are left out before
   (a bound, not an estimate).
3. Where a region still holds members of several components it is divided and
   joined again, recursively: two linked members that do not both link to the
   pivot share a shingle outside the pivot, but for a few that the pivot holds
   nearly whole (see ``residual_regions``). So members meet again under the
   rarest shingles of what the pivot lacks, and those few in a region whose
   pivot is its smallest member, where the exception cannot occur.
4. What is open after some levels is compared with more pivots (8, 64, ...)
   until no region holds two components of unresolved members, so no link is
   lost and pairs inside a large group of copies are never listed.

Regions of frequent shingles are built by aggregates and joins that AQE can
split; all others by one exchange and a streaming pass.

Defined cases: null or empty texts have no shingles and link with nothing;
a text of fewer than ``width`` words is one shingle; null ids take part, a
component's id is its smallest id that is not null; repeated rows are one
class; other columns are ignored. Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.classes import items_of, representatives
from doclake.llm.common import components, write_table
from doclake.session import scratch_path
from doclake.llm.shingles import WordHashes, content_id, shingle_sequences

SKETCH_BITS, SKETCH_PARTS = 20, 256
_PART = (1 << SKETCH_BITS) // SKETCH_PARTS
SLICE = 256  # texts of a batch that a task holds as Python objects at once


def _sets(texts: list, cache: WordHashes, width: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingles."""
    for at in range(0, len(texts), SLICE):
        h, b, _ = shingle_sequences(texts[at: at + SLICE], cache, width)
        for i in range(len(b) - 1):
            yield np.unique(h[b[i]: b[i + 1]])


def _slices(batch) -> Iterator[list]:
    """The texts of an Arrow batch, some at a time."""
    text = batch.column("text")
    for at in range(0, len(text), SLICE):
        yield text.slice(at, SLICE).to_pylist()


def _batch(names: list[str], *cols):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=names)


def measure(docs: DataFrame, width: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, th, n, c) per row - text hash, set size, class - and the
    counting sketch: occurrences of all shingles by the hash's low bits."""

    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa
        cache, sketch = WordHashes(), np.zeros(1 << SKETCH_BITS, np.int64)
        none = pa.nulls

        def count(held: list) -> None:
            at = np.concatenate(held).astype(np.uint64) & np.uint64((1 << SKETCH_BITS) - 1)
            np.add(sketch, np.bincount(at.view(np.int64), minlength=len(sketch)), out=sketch)
        for b in batches:
            n, c, held, size = [], [], [], 0
            for texts in _slices(b):
                for s in _sets(texts, cache, width):
                    n.append(len(s))
                    c.append(content_id(s))
                    held.append(s)
                    size += len(s)
                    if size > 1 << 18:
                        count(held)
                        held, size = [], 0
            if held:
                count(held)
            k = len(n)
            yield _batch(["doc_id", "th", "n", "c", "part", "counts"], b.column("doc_id"), b.column("th"),
                         pa.array(n, pa.int64()), pa.array(c, pa.int64()), none(k, pa.int32()), none(k, pa.binary()))
        parts = [sketch[i * _PART: (i + 1) * _PART].astype("<u4").tobytes() for i in range(SKETCH_PARTS)]
        k = SKETCH_PARTS
        yield _batch(["doc_id", "th", "n", "c", "part", "counts"], *[none(k, pa.int64())] * 4,
                     pa.array(range(k), pa.int32()), pa.array(parts, pa.binary()))

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for p, raw in zip(b.column("part").to_pylist(), b.column("counts").to_pylist(), strict=True):
                x = np.frombuffer(raw, "<u4" if len(raw) == 4 * _PART else "<u8").astype(np.uint64)
                total[p] = total[p] + x if p in total else x
        yield _batch(["part", "counts"], pa.array(list(total), pa.int32()),
                     pa.array([v.astype("<u8").tobytes() for v in total.values()], pa.binary()))
    out = write_table(docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(
        task, "doc_id long, th long, n long, c long, part int, counts binary"), "jx-measure")
    summed = (out.filter("part is not null").select("part", "counts")
              .repartitionByRange(SKETCH_PARTS, "part").mapInArrow(add, "part int, counts binary"))
    sketch = np.zeros(1 << SKETCH_BITS, np.uint64)  # of fixed size, whatever the input
    for r in summed.collect():
        sketch[r["part"] * _PART: (r["part"] + 1) * _PART] += np.frombuffer(r["counts"], "<u8")
    return out.filter("part is null").select("doc_id", "th", "n", "c"), sketch


def seed_rows(docs: DataFrame, sketch: np.ndarray, width: int, percent: int, hot: int) -> DataFrame:
    """(s, c, n, hot): a class's window of single-shingle pivots, stored."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(sketch, (1 << 32) - 1).astype(np.uint32))

    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa
        cache, freq, seen = WordHashes(), shared.value, set()
        for b in batches:
            for texts in _slices(b):
                out = []
                for s in _sets(texts, cache, width):
                    c = content_id(s)
                    if not len(s) or c in seen:
                        continue
                    seen.add(c)
                    if len(seen) > 1 << 18:  # only saves work: equal classes are one row later, too
                        seen.clear()
                    f = freq[s & np.uint64((1 << SKETCH_BITS) - 1)]
                    k = len(s) - -(-percent * len(s) // 100) + 1
                    first = np.lexsort((s, f))[:k]
                    out.append((s[first], np.full(k, c, np.int64), np.full(k, len(s), np.int32), f[first] >= hot))
                if out:
                    cols = [np.concatenate(x) for x in zip(*out, strict=True)]
                    for at in range(0, len(cols[0]), 100_000):
                        p = [x[at: at + 100_000] for x in cols]
                        yield _batch(["s", "c", "n", "hot"], p[0].view(np.int64), p[1], p[2], pa.array(p[3]))
    spark = docs.sparkSession
    path = scratch_path(spark, "jx-rows")
    schema = "s long, c long, n int, hot boolean"
    docs.select("text").mapInArrow(task, schema).write.partitionBy("hot").parquet(path)
    return spark.read.schema(schema).parquet(path)


def regions(rows: DataFrame, partitions: int) -> DataFrame:
    """(s, c, n, p, pn): members of regions with two classes or more, each
    beside the region's smallest class p, stored."""

    def star(batches: Iterator) -> Iterator:
        last_s, last_c, pivot, size = None, None, 0, 0
        for b in batches:
            s, c, n = (b.column(x).to_numpy() for x in ("s", "c", "n"))
            if not len(s):
                continue
            new = np.empty(len(s), bool)
            new[0], new[1:] = last_s is None or s[0] != last_s, s[1:] != s[:-1]
            at = np.maximum.accumulate(np.where(new, np.arange(len(s)), -1))
            p, pn = np.where(at < 0, pivot, c[at]), np.where(at < 0, size, n[at])
            again = np.empty(len(s), bool)  # the same class again
            again[0], again[1:] = not new[0] and c[0] == last_c, ~new[1:] & (c[1:] == c[:-1])
            keep = (c != p) & ~again
            last_s, last_c, pivot, size = s[-1], c[-1], p[-1], pn[-1]
            yield _batch(["s", "c", "n", "p", "pn"], s[keep], c[keep], n[keep], p[keep], pn[keep].astype(np.int32))
    kinds = "s long, c long, n int, p long, pn int"
    cold = (rows.filter("not hot").select("s", "c", "n").repartition(partitions, "s").sortWithinPartitions("s", "c")
            .mapInArrow(star, kinds))
    hot = rows.filter("hot").select("s", "c", "n")
    pivots = write_table(hot.groupBy("s").agg(F.min(F.struct("c", "n")).alias("m"))
                         .select("s", F.col("m.c").alias("p"), F.col("m.n").alias("pn")), "jx-hot")
    return write_table(cold.unionByName(hot.join(pivots, "s").filter("c <> p").select("s", "c", "n", "p", "pn").distinct()),
                       "jx-regions")


def shared_rows(reg: DataFrame) -> DataFrame:
    """(s, c, n): all members of all regions with two classes or more, stored."""
    return write_table(reg.select("s", "c", "n").union(reg.select("s", F.col("p"), F.col("pn")).distinct()), "jx-rows-shared")


def one_region_per_set(rows: DataFrame) -> DataFrame:
    """``rows`` (s, c, ...) of one region for each set of members, with k, the
    set's size, and times, the number of regions that had it (or the sum of
    their ``times``, if ``rows`` has any). Near copies of
    long texts share thousands of shingles and so thousands of regions with
    the same members; all would give the same pairs. Regions of one member go."""
    times = F.max("times") if "times" in rows.columns else F.max(F.lit(1).cast("long"))
    sets = rows.groupBy("s").agg(F.count(F.lit(1)).alias("k"), F.bit_xor(F.xxhash64("c")).alias("h"),
                                 F.bit_xor(F.xxhash64("c", F.lit(1))).alias("g"), times.alias("times"))
    one = write_table(sets.filter("k > 1").groupBy("k", "h", "g").agg(F.min("s").alias("s"), F.sum("times").alias("times"))
                      .select("s", "k", "times"), "jx-sets-once")
    return rows.drop("times").join(one, "s")


def by_size(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` (s, c, n, k, times) with the regions of more than ``FEW``
    members divided by set size. A step of sizes is a little wider than any two
    that can link, and each class lies in its own step and the next, so a
    linked pair still meets. Documents that only share a passage differ in
    size: most are alone here, or few."""
    step = F.floor(F.log("n") / float(np.log(100.1 / percent)))
    steps = F.explode(F.array(step, step + 1)).alias("step")
    parts = rows.filter(F.col("k") > FEW).select("s", "c", "n", "times", steps)
    parts = write_table(parts.select(F.xxhash64("s", "step").alias("s"), "c", "n", "times"), "jx-sizes")
    return rows.filter(F.col("k") <= FEW).unionByName(one_region_per_set(parts).select(*rows.columns))


def memberships(rows: DataFrame, percent: int) -> DataFrame:
    """(s, c, n, w): members of the regions that differ, stored. w, the summed
    sizes of a class's regions, is largest for the class in the middle of a
    group of near copies: its window holds what most of the others share."""
    once = write_table(by_size(write_table(one_region_per_set(rows), "jx-rows-once"), percent), "jx-rows-by-size")
    weight = write_table(once.groupBy("c").agg(F.sum(F.col("k") * F.col("times")).alias("w")), "jx-weights")
    return write_table(once.join(weight, "c").select("s", "c", "n", "w"), "jx-memberships")


def signatures(member: DataFrame) -> DataFrame:
    """(c, n, ss): per class its window's shingles that other classes share, stored."""
    return write_table(member.groupBy("c").agg(F.first("n").alias("n"), F.collect_set("s").alias("ss")), "jx-signatures")


def possible(pairs: DataFrame, sig: DataFrame, percent: int) -> DataFrame:
    """The pairs (c, p) whose windows leave room for the needed overlap, stored.

    Up to the end of the window that ends first in the global order, both
    windows hold all of their class's shingles; of the class whose window
    that is, at most the rest can still be shared. So the overlap is at most
    the windows' common shingles plus the larger of the two rests.
    """
    x, y = sig.select("c", "n", "ss"), sig.select(F.col("c").alias("p"), F.col("n").alias("pn"), F.col("ss").alias("ps"))
    rest = lambda n: F.ceil(F.col(n) * percent / F.lit(100)) - 1
    most = F.size(F.array_intersect("ss", "ps")) + F.greatest(rest("n"), rest("pn"))
    # overlap i links if 100 i >= percent (n + pn - i)
    return write_table(pairs.join(x.hint("merge"), "c").join(y.hint("merge"), "p")
                       .filter(_size_ok("n", "pn", percent) & (most * (100 + percent) >= percent * (F.col("n") + F.col("pn"))))
                       .select("c", "p"), "jx-possible")


def sets_of(docs: DataFrame, reps: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(c, items): the shingle sets of ``classes``, stored."""
    cache = WordHashes()

    def make(texts: list, _: list) -> tuple:
        got = list(_sets(texts, cache, width))
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in got])])
        return [content_id(x) for x in got], np.concatenate([*got, np.empty(0, np.uint64)]).astype(np.uint64), bounds
    return items_of(docs, reps, classes, make, "jx-sets")


def distances(pairs: DataFrame, docs: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """(c, p, d, linked) of distinct stored pairs (c, p), exact, stored."""
    sets = sets_of(docs, reps, pairs.select("c").union(pairs.select("p")).distinct(), width)
    a, b = sets.select("c", F.col("items").alias("x")), sets.select(F.col("c").alias("p"), F.col("items").alias("y"))
    both = pairs.join(a.hint("merge"), "c").join(b.hint("merge"), "p")
    inter = F.size(F.array_intersect("x", "y")).cast("long")
    return write_table(both.select("c", "p", inter.alias("i"), (F.size("x") + F.size("y")).cast("long").alias("t"))
                       .select("c", "p", (1 - F.col("i") / (F.col("t") - F.col("i"))).alias("d"),
                               (100 * F.col("i") >= percent * (F.col("t") - F.col("i"))).alias("linked"))
                       .dropDuplicates(["c", "p"]), "jx-distances")


def _size_ok(n: str, m: str, percent: int):
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def measured(pairs: DataFrame, docs: DataFrame, reps: DataFrame, sketch: np.ndarray, width: int, percent: int) -> DataFrame:
    """(c, p, a, d, linked, us) of distinct stored pairs (c, p, lo), stored:
    the overlap with the pivot, and the class's residual window, which any
    partner of ``lo`` shingles or more shares unless the pivot alone may hold
    the needed overlap.

    A partner needs t = percent / (100 + percent) * (n + its size) common
    shingles; at most a of them lie in the pivot, so max(1, t - a) lie outside,
    and the first (n - a) - max(1, t - a) + 1 shingles outside, in the global
    order, cannot all be missed.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(sketch, (1 << 32) - 1).astype(np.uint32))
    sets = sets_of(docs, reps, pairs.select("c").union(pairs.select("p")).distinct(), width)
    a, b = sets.select("c", F.col("items").alias("x")), sets.select(F.col("c").alias("p"), F.col("items").alias("y"))
    both = pairs.join(a.hint("merge"), "c").join(b.hint("merge"), "p").select("c", "p", "lo", "x", "y")

    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa
        freq = shared.value
        for batch in batches:
            out = []
            for i in range(len(batch)):
                x, y = (batch.column(k)[i].values.to_numpy().view(np.uint64) for k in ("x", "y"))
                rest = np.setdiff1d(x, y, assume_unique=True)
                n, common = len(x), len(x) - len(rest)
                least = max(batch.column("lo")[i].as_py(), -(-percent * n // 100))
                needed = -(-percent * (n + least) // (100 + percent))
                first = np.lexsort((rest, freq[rest & np.uint64((1 << SKETCH_BITS) - 1)]))[: max(0, len(rest) - max(1, needed - common) + 1)]
                union = n + len(y) - common
                out.append((common, 1 - common / union, 100 * common >= percent * union, rest[first].view(np.int64)))
            common, d, linked, us = zip(*out, strict=True) if out else ((), (), (), ())
            yield _batch(["c", "p", "a", "d", "linked", "us"], batch.column("c"), batch.column("p"), pa.array(common, pa.int32()),
                         pa.array(d, pa.float64()), pa.array(linked, pa.bool_()), pa.array(us, pa.list_(pa.int64())))
    return write_table(both.mapInArrow(task, "c long, p long, a int, d double, linked boolean, us array<long>")
                       .dropDuplicates(["c", "p"]), "jx-measured")


FEW = 8  # members of a region that are compared directly


def open_members(members: DataFrame, label: DataFrame) -> DataFrame:
    """Members, with labels, of the regions that hold several components, stored."""
    m = (members.join(label.withColumnRenamed("node", "c"), "c", "left")
         .select(*members.columns, F.coalesce("root", "c").alias("label")))
    several = m.groupBy("s").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).filter("l0 <> l1").select("s")
    return write_table(m.join(several, "s"), "jx-open")


def all_pairs(m: DataFrame, known: DataFrame, sig: DataFrame, percent: int) -> DataFrame:
    """Possible pairs (c, p), not known yet, of members of a region that lie in
    different components, stored. For regions of at most ``FEW`` members."""
    q = m.select("s", F.col("c").alias("p"), F.col("n").alias("pn"), F.col("label").alias("q_label"))
    pairs = (m.join(q, "s").filter((F.col("c") > F.col("p")) & (F.col("label") != F.col("q_label")) & _size_ok("n", "pn", percent))
             .select("c", "p").distinct())
    return possible(_unknown(pairs, known), sig, percent)


def _unknown(pairs: DataFrame, known: DataFrame) -> DataFrame:
    return pairs.join(known.select(F.greatest("c", "p").alias("c"), F.least("c", "p").alias("p")), ["c", "p"], "left_anti")


def class_links(docs: DataFrame, rows: DataFrame, sketch: np.ndarray, width: int, percent: int, levels: int = 2) -> DataFrame:
    """Links (c, p) between classes that connect every component."""
    total = rows.agg(F.sum("n")).first()[0] or 0
    conf = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seeds = seed_rows(docs, sketch, width, percent, hot=max(4096, 4 * (total >> SKETCH_BITS)))
    shared = shared_rows(regions(seeds, max(conf, total // 2_000_000)))
    member = memberships(shared, percent)
    sig, reps = signatures(shared), representatives(rows.filter("n > 0"))
    nobody = member.limit(0)
    known = nobody.select("c", F.col("c").alias("p"), F.lit(0.0).alias("d"), F.lit(False).alias("linked"))
    label = nobody.select(F.col("c").alias("node"), F.col("c").alias("root"))
    # low: the smallest member becomes the pivot instead of the central one
    members = member.withColumn("low", F.lit(False))
    for _ in range(levels):
        m = open_members(members, label)
        if m.isEmpty():
            break
        size = write_table(m.groupBy("s").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("lo"), F.max(F.struct(
            F.when(F.col("low"), -F.col("n")).otherwise(F.col("w")), "w", "c", "n")).alias("m"))
            .select("s", "k", "lo", F.col("m.c").alias("p"), F.col("m.n").alias("pn")), "jx-pivots")
        few = all_pairs(m.join(size.filter(F.col("k") <= FEW).select("s"), "s"), known, sig, percent)
        if not few.isEmpty():
            known = known.unionByName(distances(few, docs, reps, width, percent))
        near = write_table(m.join(size.filter(F.col("k") > FEW), "s").filter("c <> p"), "jx-near")
        pairs = write_table(near.groupBy("c", "p").agg(F.min("lo").alias("lo")), "jx-pairs")
        exact = None if pairs.isEmpty() else measured(pairs, docs, reps, sketch, width, percent)
        if exact is not None:
            known = known.unionByName(exact.select("c", "p", "d", "linked"))
        known = write_table(known, "jx-known")
        label = write_table(components(known.filter("linked").select(F.col("c").alias("a"), F.col("p").alias("b"))), "jx-label")
        members = nobody.withColumn("low", F.lit(False))
        if exact is not None:  # only what these links leave open meets again
            members = residual_regions(open_members(near.drop("label"), label), exact, percent)
    return exhaust(members.select("s", "c", "n", "w"), label, known, sig, docs, reps, width, percent)


def residual_regions(near: DataFrame, exact: DataFrame, percent: int) -> DataFrame:
    """(s, c, n, w, low), stored: the regions in which the pairs that a pivot
    leaves open meet again.

    Two linked members that do not both link to their pivot p either share a
    shingle outside p, and meet in that shingle's region, or p alone may hold
    their needed overlap t, min(a, a') >= t. In the second case one of them
    does not link to p and the other is smaller than p. Those few form the
    region again without p; there the smallest member is the pivot, and the
    second case cannot occur: a >= t of the pair implies a >= t with a
    smaller p, a link.
    """
    both = near.join(exact.drop("us"), ["c", "p"])
    # members that link to the pivot are one component: their rows matter only
    # where they meet one that does not link to this pivot
    rows = write_table(near.groupBy("c", "p").agg(F.first("n").alias("n"), F.first("w").alias("w")), "jx-near-once")
    rows = rows.join(exact.select("c", "p", "linked", "us"), ["c", "p"])
    apart = write_table(rows.filter("not linked").select(F.explode("us").alias("s"), "p", "c", "n", "w"), "jx-apart")
    open_ = apart.select("p").distinct()
    meet = (rows.filter("linked").join(open_, "p", "left_semi").select(F.explode("us").alias("s"), "p", "c", "n", "w")
            .join(apart.select("s", "p").distinct(), ["s", "p"], "left_semi"))
    outside = apart.unionByName(meet).select("s", "c", "n", "w").distinct().withColumn("low", F.lit(False))
    # the largest partner whose needed overlap with x the pivot may hold
    most = F.floor(F.col("a") * (100 + percent) / F.lit(percent)) - F.col("n")
    least = F.greatest("lo", F.ceil(F.col("n") * percent / F.lit(100)))
    inside = write_table(both.filter(~F.col("low") & (most >= least)).select("s", "c", "n", "w", "linked", most.alias("most")), "jx-inside")
    cap = inside.filter("not linked").groupBy("s").agg(F.max("most").alias("cap"))
    again = (inside.join(cap, "s").filter((F.col("n") <= F.col("cap")) | ~F.col("linked"))
             .select(F.xxhash64("s", F.lit(1)).alias("s"), "c", "n", "w").withColumn("low", F.lit(True)))
    stored = write_table(outside.unionByName(again), "jx-members")
    once = one_region_per_set(stored).drop("k", "times")
    return write_table(once, "jx-members-once")


def exhaust(members: DataFrame, label: DataFrame, known: DataFrame, sig: DataFrame, docs: DataFrame, reps: DataFrame,
            width: int, percent: int) -> DataFrame:
    """Links after comparing what is still open: in each round the rarest
    components' members are pivots (8, 64, ...) for the rest of their region."""
    pivots = FEW
    while True:
        m = open_members(members, label)
        if m.isEmpty():
            return known.filter("linked").select("c", "p")
        share = write_table(m.groupBy("s", "label").agg(F.count(F.lit(1)).alias("k")), "jx-share")
        rank = F.row_number().over(Window.partitionBy("s").orderBy("k", F.desc("w"), "label", "c"))
        m = write_table(m.join(share, ["s", "label"]).withColumn("r", rank).drop("k"), "jx-ranked")
        q = m.filter(F.col("r") <= pivots).select("s", *[F.col(x).alias(f"q_{x}") for x in ("c", "n", "label", "r")])
        pairs = (m.join(q, "s").filter((F.col("r") > F.col("q_r")) & (F.col("label") != F.col("q_label")) & _size_ok("n", "q_n", percent))
                 .select(F.greatest("c", "q_c").alias("c"), F.least("c", "q_c").alias("p")).distinct())
        pairs = possible(_unknown(pairs, known), sig, percent)
        if not pairs.isEmpty():
            known = write_table(known.unionByName(distances(pairs, docs, reps, width, percent)), "jx-known")
            label = write_table(components(known.filter("linked").select(F.col("c").alias("a"), F.col("p").alias("b"))), "jx-label")
        members = m.filter(F.col("r") > pivots).select("s", "c", "n", "w")
        pivots *= 8


def labelled(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): ``measure``'s rows, and (c, root, least) per class
    with shingles: its component's root and its own smallest id, stored."""
    rows, sketch = measure(docs, width)
    links = class_links(docs, rows, sketch, width, percent)
    label = write_table(components(links.toDF("a", "b")), "jx-labels")
    least = rows.filter("n > 0").groupBy("c").agg(F.min("doc_id").alias("least"))
    return rows, write_table(least.join(label.withColumnRenamed("node", "c"), "c", "left")
                             .select("c", F.coalesce("root", "c").alias("root"), "least"), "jx-classes")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, th, n_shingles, component_id) per row of ``docs``."""
    rows, own = labelled(docs, width, percent)
    # each class once: its own smallest id, then its component's
    comp = own.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = write_table(own.join(comp, "root").select(F.col("c").alias("k"), "component_id"), "jx-components")
    return (rows.join(ids, (F.col("c") == F.col("k")) & (F.col("n") > 0), "left")
            .select("doc_id", "th", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with exactly one row of each component: the one with its
    smallest id (null ids last), then text hash, and of equal rows one. Rows
    without words all stay."""
    cols = docs.columns
    rows, own = labelled(docs, width, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("u"), "doc_id", "th", "k")).alias("r")
    equal = rows.filter("n > 0").groupBy("c", "doc_id", "th").agg(F.count(F.lit(1)).alias("k"))
    # each class once, then each component; equal texts are one class, so (doc_id, th) names one component
    one = equal.groupBy("c").agg(first).join(own, "c").groupBy("root").agg(F.min("r").alias("r"))
    stay = one.select(F.col("r.doc_id").alias("__id"), F.col("r.th").alias("__th"), F.col("r.k").alias("__rows"))
    none = rows.filter("n = 0").select("doc_id", "th").distinct().withColumn("__rows", F.lit(1).cast("long"))
    stay = write_table(stay.union(none), "jx-stay")
    kept = (docs.withColumn("__hash", F.xxhash64("text"))
            .join(stay, (F.col("__hash") == F.col("__th")) & F.col("doc_id").eqNullSafe(F.col("__id"))))
    if not stay.filter("__rows > 1").isEmpty():  # equal rows: id and text
        once = kept.filter("__rows > 1").dropDuplicates(["__id", "__th"])
        kept = kept.filter("__rows = 1").unionByName(once)
    return kept.select(*[F.col(f"`{c}`") for c in cols])


def op4_jaccard(spark, sf_dir: str) -> DataFrame:
    """Query: components of documents with similarity 0.8 or more on 5-word shingles."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")


ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
    lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS g FROM d),
x AS (SELECT rid, unnest(g) AS t, len(g) AS n FROM s),
l AS (SELECT a.rid AS a, b.rid AS b FROM x a JOIN x b ON a.t = b.t AND a.rid <> b.rid
    GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT rid AS a, rid AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, CAST(min(o.doc_id) AS BIGINT) AS component_id
FROM s JOIN r ON r.a = s.rid JOIN s o ON o.rid = r.b GROUP BY s.rid, s.doc_id, s.g
"""
