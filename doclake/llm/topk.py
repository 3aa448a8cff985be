"""Exact top-k by inner product: ball trees per shard, branch and bound.

Vectors are dealt to shards by hash; each shard builds a ball tree (leaves of
contiguous rows, a centre and a radius per leaf and per inner node). Queries
are a stated set and go to the shards in blocks. Nodes are visited in the
order of their upper bound, centre . query + radius * |query|. First each
block looks at the best leaves of the shards with the largest root bounds; the
largest of the k-th scores found there is a lower bound of the final one and
is shared. A plan then lists the (shard, block) pairs whose root bound reaches
it for some query, computed from the roots alone; only these blocks are sent
to their shards' trees, which prune every node below the shared score. Scores
are exact integers.

Defined cases: vectors that are null or hold null or non-finite components
take no part; vectors of different lengths are never compared; rows are told
apart by position, so repeated ids take part as often as they occur; a null
id is never a query and sorts behind the others in ties.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import write_table

NO_ID = np.iinfo(np.int64).max  # a null id in the shards


def integer_vectors(rows: DataFrame, scale: float) -> DataFrame:
    """(rid, vec_id, v, dim) of the rows that take part."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    ok = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return write_table(rows.filter(F.coalesce(ok, F.lit(False))).select(
        F.monotonically_increasing_id().alias("rid"), "vec_id", v.alias("v"), F.size("embedding").alias("dim")), "tk-vectors")


def ball_tree(x: np.ndarray, leaf: int) -> tuple[np.ndarray, list]:
    """Row order and nodes (lo, hi, centre, radius, left, right); node 0 is the root.

    A node is cut at the median of its widest direction, seen from its two
    farthest points; equal points end in equal halves, so the depth stays
    logarithmic whatever the data.
    """
    order, nodes, todo = np.arange(len(x)), [], [(0, len(x), -1, 0)]
    while todo:
        lo, hi, parent, side = todo.pop()
        own = x[order[lo:hi]]
        centre = own.mean(axis=0)
        radius = float(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
        here = len(nodes)
        nodes.append([lo, hi, centre, radius, -1, -1])
        if parent >= 0:
            nodes[parent][4 + side] = here
        if hi - lo > leaf:
            a = own[((own - centre) ** 2).sum(axis=1).argmax()]
            b = own[((own - a) ** 2).sum(axis=1).argmax()]
            order[lo:hi] = order[lo:hi][np.argsort(own @ (b - a), kind="stable")]
            mid = (lo + hi) // 2
            todo += [(lo, mid, here, 0), (mid, hi, here, 1)]
    return order, nodes


def build_index(vecs: DataFrame, shard_rows: int, leaf: int) -> DataFrame:
    """(dim, shard, tree, centre, radius): one pickled ball tree per shard of about ``shard_rows`` rows."""
    n = max(1, -(-vecs.count() // shard_rows))

    def build(key, pdf):
        import pandas as pd
        x = np.array(pdf["v"].tolist(), dtype=np.int64).reshape(len(pdf), int(key[0]))
        ids = np.array([NO_ID if i is None or i != i else int(i) for i in pdf["vec_id"].astype(object)], dtype=np.int64)
        order, nodes = ball_tree(x.astype(np.float64), leaf)
        small = next((t for t in (np.int8, np.int16, np.int32)
                      if len(x) and x.size and np.iinfo(t).min <= x.min() and x.max() <= np.iinfo(t).max), np.int64)
        tree = {"x": x[order].astype(small), "ids": ids[order], "rid": pdf["rid"].to_numpy(np.int64)[order],
                "lo": np.array([m[0] for m in nodes]), "hi": np.array([m[1] for m in nodes]),
                "c": np.array([m[2] for m in nodes]), "r": np.array([m[3] for m in nodes]),
                "kids": np.array([m[4:6] for m in nodes])}
        return pd.DataFrame({"dim": [int(key[0])], "shard": [int(key[1])], "tree": [pickle.dumps(tree, protocol=5)],
                             "centre": [tree["c"][0].tobytes()], "radius": [float(tree["r"][0])]})
    # vec_id as text keeps null ids exact through pandas
    return write_table(vecs.withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int"))
                       .withColumn("vec_id", F.col("vec_id").cast("string")).groupBy("dim", "shard")
                       .applyInPandas(build, "dim int, shard int, tree binary, centre binary, radius double"), "tk-trees")


def query_blocks(queries: DataFrame, block: int) -> DataFrame:
    """(dim, b, qs): blocks of at most about ``block`` queries."""
    n = max(1, -(-queries.count() // block))
    return write_table(queries.withColumn("b", F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(n)).cast("int"))
                       .groupBy("dim", "b").agg(F.collect_list(F.struct("rid", "v")).alias("qs")), "tk-queries")


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products; by floating point where they are exact there too."""
    x = x.astype(np.int64)
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    if bound < 2 ** 53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return q @ x.T


class Search:
    """Branch and bound of one block of queries in one shard."""

    def __init__(self, tree: dict, q: np.ndarray, rid: np.ndarray, k: int, tau: np.ndarray):
        self.t, self.q, self.rid, self.k = tree, q, rid, k
        self.tau = tau.copy()  # a lower bound of each query's final k-th score
        self.norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        e = (0, len(q))
        self.best = [np.empty((len(q), 0), np.int64) for _ in e] + [np.empty((len(q), 0), bool)]

    def bound(self, node: int) -> np.ndarray:
        b = self.q.astype(np.float64) @ self.t["c"][node] + self.t["r"][node] * self.norm
        return b + np.abs(b) * 1e-9 + self.norm * 1e-6 + 1e-6  # above any rounding

    def visit(self, node: int, rows: np.ndarray) -> None:
        lo, hi = self.t["lo"][node], self.t["hi"][node]
        s = _scores(self.q[rows], self.t["x"][lo:hi])
        ids = np.broadcast_to(self.t["ids"][lo:hi], s.shape)
        ok = self.t["rid"][lo:hi][None, :] != self.rid[rows][:, None]
        old = [a[rows] for a in self.best]
        s, ids, ok = np.hstack([old[0], s]), np.hstack([old[1], ids]), np.hstack([old[2], ok])
        # best first: rows that take part, higher score, smaller id
        pick = np.lexsort((ids, -s, ~ok), axis=1)[:, : self.k]
        new = [np.take_along_axis(a, pick, axis=1) for a in (s, ids, ok)]
        if self.best[0].shape[1] < new[0].shape[1]:
            grow = new[0].shape[1] - self.best[0].shape[1]
            self.best = [np.hstack([a, np.zeros((len(a), grow), a.dtype)]) for a in self.best]
        for a, b in zip(self.best, new, strict=True):
            a[rows, : b.shape[1]] = b
        if new[0].shape[1] >= self.k:
            kth = np.where(new[2][:, self.k - 1], new[0][:, self.k - 1], np.iinfo(np.int64).min)
            self.tau[rows] = np.maximum(self.tau[rows], kth)

    def run(self, leaves: int | None = None) -> None:
        """Visit nodes in the order of their bound; ``leaves``: stop after so many."""
        import heapq
        everyone = np.arange(len(self.q))
        b = self.bound(0)
        heap, seen = [(-float(b.max(initial=0)), 0, everyone, b)], 0
        while heap and (leaves is None or seen < leaves):
            _, node, rows, b = heapq.heappop(heap)
            live = b >= self.tau[rows]  # equal scores still count: ties go to the smaller id
            rows = rows[live]
            if not len(rows):
                continue
            kids = self.t["kids"][node]
            if kids[0] < 0:
                self.visit(node, rows)
                seen += 1
                continue
            for c in kids:
                bc = self.bound(int(c))[rows]
                heapq.heappush(heap, (-float(bc.max()), int(c), rows, bc))


ROOTS = 1024  # shards whose roots are held together
TOGETHER = 64  # blocks that are sent to one copy of a tree


def live_pairs(trees: DataFrame, blocks: DataFrame, best: int | None) -> DataFrame:
    """(dim, b, shard), stored: per block of queries the ``best`` shards by root
    bound, or (None) all shards whose bound reaches ``taus`` for some query.

    Roots are kept in groups; copies of a group are dealt out by a salt, so
    that no key holds all blocks."""
    spark, n = blocks.sparkSession, blocks.count()
    salts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // TOGETHER))
    roots = (trees.select("dim", F.floor(F.col("shard") / ROOTS).cast("int").alias("chunk"), F.struct("shard", "centre", "radius").alias("r"))
             .groupBy("dim", "chunk").agg(F.collect_list("r").alias("roots")))
    chunks = trees.groupBy("dim").agg(F.max(F.floor(F.col("shard") / ROOTS)).cast("int").alias("last"))
    left = (blocks.join(chunks, "dim").withColumn("chunk", F.explode(F.sequence(F.lit(0), "last"))).drop("last")
            .withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)).cast("int")))
    right = roots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def bounds(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for row in batch.to_pylist():
                q = np.array([x["v"] for x in row["qs"]], np.float64).reshape(len(row["qs"]), row["dim"])
                c = np.array([np.frombuffer(r["centre"]) for r in row["roots"]]).reshape(len(row["roots"]), row["dim"])
                norm = np.sqrt((q ** 2).sum(axis=1))
                u = q @ c.T + norm[:, None] * np.array([r["radius"] for r in row["roots"]])[None, :]
                u = u + np.abs(u) * 1e-9 + norm[:, None] * 1e-6 + 1e-6  # above any rounding
                if best is None:
                    tau = {x["rid"]: x["tau"] for x in row["taus"] or []}
                    least = np.array([tau.get(x["rid"], -np.inf) for x in row["qs"]], np.float64)
                    keep = np.flatnonzero((u >= (least - np.abs(least) * 1e-9)[:, None]).any(axis=0))
                else:
                    keep = np.argsort(-u.max(axis=0, initial=-np.inf), kind="stable")[:best]
                k = len(keep)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, row["dim"], np.int32)), pa.array(np.full(k, row["b"], np.int32)),
                     pa.array([row["roots"][i]["shard"] for i in keep], pa.int32()), pa.array(u.max(axis=0, initial=-np.inf)[keep])],
                    names=["dim", "b", "shard", "top"])
    found = left.join(right.hint("merge"), ["dim", "chunk", "salt"]).mapInArrow(bounds, "dim int, b int, shard int, top double")
    if best is not None:
        w = Window.partitionBy("dim", "b").orderBy(F.desc("top"), "shard")  # at most ``best`` rows per group of roots
        found = found.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= best)
    return write_table(found.select("dim", "b", "shard"), "tk-plan")


def visits(plan: DataFrame, trees: DataFrame, blocks: DataFrame, task, schema: str) -> DataFrame:
    """``task(tree, blocks)`` of each shard and up to ``TOGETHER`` of its planned blocks."""
    sub = F.floor(F.col("b") / TOGETHER).cast("int").alias("sub")
    needed = plan.select(F.col("dim").alias("dim"), F.col("shard").alias("shard"), sub).distinct()
    copies = needed.join(trees.select("dim", "shard", "tree").hint("merge"), ["dim", "shard"])
    sent = plan.select("*", sub).join(blocks.hint("merge"), ["dim", "b"])
    keys = ["dim", "shard", "sub"]
    return copies.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(task, schema)


def top_k(rows: DataFrame, queries: DataFrame | None = None, k: int = 20, scale: float = 64.0, every: int = 20,
          shard_rows: int = 16_384, leaf: int = 512, block: int = 512, probe: int = 2, probe_shards: int = 4) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id is divisible by ``every``."""
    vecs = integer_vectors(rows, scale)
    q = vecs.filter(F.col("vec_id") % every == 0)
    trees, blocks = build_index(vecs, shard_rows, leaf), query_blocks(q, block)

    def search(final: bool):
        def task(copies, sent):
            import pandas as pd
            out = []
            tree = pickle.loads(copies["tree"].iloc[0]) if len(copies) else None
            for row in sent.to_dict("records") if tree is not None else []:
                rid = np.array([x["rid"] for x in row["qs"]], np.int64)
                vec = np.array([x["v"] for x in row["qs"]], np.int64).reshape(len(rid), row["dim"])
                tau = np.full(len(rid), np.iinfo(np.int64).min)
                if final:
                    shared = {x["rid"]: x["tau"] for x in row["taus"]}
                    tau = np.array([shared.get(i, t) for i, t in zip(rid, tau, strict=True)], np.int64)
                s = Search(tree, vec, rid, k, tau)
                s.run(None if final else probe)
                if not final:
                    out.append(pd.DataFrame({"dim": row["dim"], "b": row["b"], "rid": rid, "tau": s.tau}))
                    continue
                score, ids, ok = s.best
                keep = ok & (score >= s.tau[:, None])
                qi, _ = np.nonzero(keep)
                ids = pd.Series(ids[keep]).astype("Int64")
                out.append(pd.DataFrame({"rid": rid[qi], "vec_id": ids.mask(ids == NO_ID), "score": score[keep]}))
            names = ["rid", "vec_id", "score"] if final else ["dim", "b", "rid", "tau"]
            return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="Int64") for c in names})
        return task
    first = visits(live_pairs(trees, blocks, probe_shards), trees, blocks, search(False), "dim int, b int, rid long, tau long")
    shared = write_table(first.groupBy("dim", "b", "rid").agg(F.max("tau").alias("tau"))
                         .groupBy("dim", "b").agg(F.collect_list(F.struct("rid", "tau")).alias("taus")), "tk-shared")
    told = write_table(blocks.join(shared, ["dim", "b"]), "tk-told")
    found = visits(live_pairs(trees, told, None), trees, told, search(True), "rid long, vec_id long, score long")
    w = Window.partitionBy("rid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    ids = q.select("rid", F.col("vec_id").alias("query_id"))
    return best.join(ids, "rid").select("query_id", "rank", "vec_id", "score")


def op8_topk(spark, sf_dir: str) -> DataFrame:
    """Query: the 20 best of all other rows for every 20th vector id."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


ORACLE_SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT * FROM v WHERE vec_id % 20 = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.v, v.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM q JOIN v ON q.rid <> v.rid AND len(q.v) = len(v.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
