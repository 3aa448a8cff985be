"""Ranked lexical search over a length-stratified index.

A document's normaliser m depends on its length alone, and a term's impact on
m and the term's count tf alone. Documents of equal m form a stratum; a
stratum is stored as blocks of a bounded number of documents, whose postings
lie per term in groups of equal tf, so that an impact is computed once per
group. A block's bound for an item adds up, over the item's terms, the impact
of the largest tf in the block. Blocks are visited in the order of their
bounds; those below the k-th score found so far are never opened. First every
group of blocks is probed at its best blocks; the largest k-th score of all
groups is shared and prunes the full visit. All scores are integers.

The index is written once, bucketed by block group, and is not exchanged by a
search; items go to it in batches of a bounded size.

Defined cases: a null or empty text has no term, is not counted and never
found; an item without a known term has no result; documents and items are
told apart by position, so repeated rows are found, and answered, as often as
they occur; null ids sort behind the others in ties; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.bucketed import BucketedTable
from doclake.llm.common import shared_folder, write_table
from doclake.llm.groups import MOST, join_groups

NO_ID = np.iinfo(np.int64).max  # a null id in the blocks
#: A-Z become a-z; what belongs to no term becomes a blank; bytes of non-ASCII characters stay.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def term_counts(rows: DataFrame) -> DataFrame:
    """(rid, id, n, terms, tfs) of the rows (rid, id, text) that hold a term:
    distinct terms, joined by blanks, and their counts."""
    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            keep, n, terms, tfs = [], [], [], []
            for i, text in enumerate(b.column("text")):
                text = text.as_py()
                count = Counter(text.encode().translate(TERM_BYTES).split()) if text else None
                if count:
                    tf = np.fromiter(count.values(), "<u4", len(count))
                    keep.append(i)
                    n.append(int(tf.sum()))
                    terms.append(b" ".join(count))
                    tfs.append(tf.tobytes())
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("rid").take(at), b.column("id").take(at), pa.array(n, pa.int64()),
                 pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], names=["rid", "id", "n", "terms", "tfs"])
    return rows.select("rid", "id", "text").mapInArrow(task, "rid long, id long, n long, terms binary, tfs binary")


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


BLOCK = ("m long, first long, docs int, ids binary, terms string, df array<int>, maxtf array<int>, "
         "groups binary, tf binary, size binary, at binary")


def block_row(m: int, docs: list) -> dict:
    """One block of documents (rid, id, terms, tfs) of stratum m."""
    lexicon: dict[bytes, int] = {}
    terms = [d[2].split(b" ") for d in docs]
    term = np.fromiter((lexicon.setdefault(t, len(lexicon)) for ts in terms for t in ts), np.int64)
    tf = np.frombuffer(b"".join(d[3] for d in docs), "<u4").astype(np.int64)
    doc = np.repeat(np.arange(len(docs)), [len(ts) for ts in terms])
    order = np.lexsort((doc, tf, term))
    term, tf, doc = term[order], tf[order], doc[order]
    new_term = np.flatnonzero(np.diff(term, prepend=-1))
    new_group = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(tf, prepend=-1) != 0))
    group_term = term[new_group]
    return {"m": m, "first": docs[0][0], "docs": len(docs),
            "ids": np.array([NO_ID if d[1] is None else d[1] for d in docs], np.int64).tobytes(),
            "terms": b" ".join(lexicon).decode(), "df": np.diff(new_term, append=len(term)).tolist(),
            "maxtf": np.maximum.reduceat(tf, new_term).tolist(),
            "groups": np.bincount(group_term, minlength=len(lexicon)).astype("<u4").tobytes(),
            "tf": tf[new_group].astype("<u4").tobytes(),
            "size": np.diff(new_group, append=len(term)).astype("<u4").tobytes(), "at": doc.astype("<u4").tobytes()}


class StratifiedIndex:
    """``blocks`` (bucketed by group ``g``), ``groups``: number of them, ``n_docs`` (N) and ``n_terms`` (L)."""

    def __init__(self, docs: DataFrame, block_docs: int = 4096, block_postings: int = 2_000_000, group_terms: int = 2_000_000):
        spark = docs.sparkSession
        rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("id"), "text")
        forward = write_table(term_counts(rows), "st-forward", "zstd")
        total = forward.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
        self.spark, self.n_docs, self.n_terms = spark, total["n"], total["l"]
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(least, -(-self.n_terms // (4 * group_terms)))
        self.groups = 4 * tasks
        m = 25 + F.expr(f"(75 * n * {self.n_docs}L) div {max(1, self.n_terms)}L")

        def build(batches: Iterator) -> Iterator:
            import pyarrow as pa
            docs, size, stratum = [], 0, None
            out = pa.schema([("m", pa.int64()), ("first", pa.int64()), ("docs", pa.int32()), ("ids", pa.binary()),
                             ("terms", pa.string()), ("df", pa.list_(pa.int32())), ("maxtf", pa.list_(pa.int32())),
                             *[(c, pa.binary()) for c in ("groups", "tf", "size", "at")]])
            for b in batches:
                for *row, tfs in zip(*[b.column(c).to_pylist() for c in ("m", "rid", "id", "terms", "tfs")], strict=True):
                    if docs and (row[0] != stratum or len(docs) >= block_docs or size >= block_postings):
                        yield pa.RecordBatch.from_pylist([block_row(stratum, docs)], out)
                        docs, size = [], 0
                    stratum = row[0]
                    docs.append((*row[1:], tfs))
                    size += len(tfs) // 4
            if docs:
                yield pa.RecordBatch.from_pylist([block_row(stratum, docs)], out)
        # strata of more than 1 / MOST of all documents, fewer than MOST, are cut by a salt; others are small
        forward = forward.withColumn("m", m)
        large = (forward.groupBy("m").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") * MOST > self.n_docs)
                 .select("m", F.ceil(F.col("size") / block_docs).alias("salts")))
        salt = F.pmod(F.xxhash64("rid"), F.coalesce("salts", F.lit(1))).cast("int")
        dealt = (forward.join(F.broadcast(large), "m", "left").select("m", salt.alias("salt"), "rid", "id", "terms", "tfs")
                 .repartition(tasks, "m", "salt").sortWithinPartitions("m", "salt"))
        blocks = dealt.mapInArrow(build, BLOCK).withColumn("g", F.pmod(F.xxhash64("first"), F.lit(self.groups)).cast("int"))
        self.blocks = BucketedTable(spark, shared_folder(spark, "st-index"), f"{BLOCK}, g int", ["g"], tasks, "made")
        self.blocks.put(blocks, "first")

    def weights(self, vocabulary: DataFrame) -> DataFrame:
        """``vocabulary`` (term, ...) with the terms' weight w; unknown terms are left out."""
        df = (self.blocks.read().select(F.explode(F.arrays_zip(F.split("terms", " ").alias("term"), "df")).alias("x"))
              .select("x.term", "x.df").join(vocabulary.select("term"), "term", "left_semi")
              .groupBy("term").agg(F.sum("df").alias("df")))
        w = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * self.n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
        return vocabulary.join(df, "term").select(*vocabulary.columns, w.alias("w"))


def item_blocks(items: DataFrame, index: StratifiedIndex, block_items: int, block_terms: int) -> tuple[DataFrame, DataFrame, int]:
    """(rid, id) of the items; (b, entries) with the items' weighted terms; number of blocks."""
    rows = write_table(items.select(F.monotonically_increasing_id().alias("rid"), F.col("item_id").alias("item_id"), "text"), "st-items")
    counts = term_counts(rows.select("rid", F.lit(None).cast("long").alias("id"), "text"))

    def spread(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            for rid, terms, tfs in zip(*[b.column(c).to_pylist() for c in ("rid", "terms", "tfs")], strict=True):
                ts = [t.decode() for t in terms.split(b" ")]
                yield pa.RecordBatch.from_arrays([pa.array([rid] * len(ts), pa.int64()), pa.array(ts, pa.string()),
                                                  pa.array(np.frombuffer(tfs, "<u4").astype(np.int64))], names=["rid", "term", "qtf"])
    terms = write_table(counts.mapInArrow(spread, "rid long, term string, qtf long"), "st-item-terms")
    n = terms.agg(F.count_distinct("rid"), F.count(F.lit(1))).first()
    nb = max(1, -(-n[0] // block_items), -(-n[1] // block_terms))
    vocabulary = write_table(terms.groupBy("term").agg(F.count(F.lit(1)).alias("holders")), "st-vocabulary")
    weighted = join_groups(terms, write_table(index.weights(vocabulary), "st-weights"), "term", "holders", n[1])
    entries = F.collect_list(F.struct("rid", "term", (F.col("qtf") * F.col("w")).alias("coef")))
    blocks = (weighted.filter("w > 0").groupBy(F.pmod(F.xxhash64("rid"), F.lit(nb)).cast("int").alias("b")).agg(entries.alias("entries")))
    return rows.select("rid", "item_id"), write_table(blocks, "st-queries"), nb


class Search:
    """A batch of items over one group of blocks."""

    def __init__(self, entries: list[dict], k: int):
        self.rids = np.unique(np.array([e["rid"] for e in entries], np.int64))
        entries = sorted(entries, key=lambda e: e["term"])
        names = [e["term"] for e in entries]
        self.item = np.searchsorted(self.rids, np.array([e["rid"] for e in entries], np.int64))
        self.coef = np.array([e["coef"] for e in entries], np.int64)
        cut = np.flatnonzero([i == 0 or names[i] != names[i - 1] for i in range(len(names))])
        self.start = np.append(cut, len(names))
        self.number = {names[i]: j for j, i in enumerate(cut.tolist())}
        self.k, none = k, np.empty(0, np.int64)
        self.tau = np.ones(len(self.rids), np.int64)  # scores above 0 only
        self.best = [none, none, none]  # item, score, document

    def known(self, block: dict) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the block's lexicon, and numbers, of the terms that both sides have."""
        pairs = [(i, j) for i, t in enumerate(block["terms"].split(" ")) if (j := self.number.get(t)) is not None]
        return tuple(np.array(pairs, np.int64).reshape(-1, 2).T)

    def bound(self, block: dict, at: np.ndarray, number: np.ndarray) -> np.ndarray:
        top = np.zeros(len(self.number), np.int64)
        top[number] = impact(np.asarray(block["maxtf"])[at], block["m"])
        out = np.zeros(len(self.rids), np.int64)
        np.add.at(out, self.item, self.coef * np.repeat(top, np.diff(self.start)))
        return out

    def visit(self, block: dict, at: np.ndarray, number: np.ndarray, live: np.ndarray) -> None:
        rows = np.flatnonzero(live)
        row_of = np.full(len(live), -1)
        row_of[rows] = np.arange(len(rows))
        n_groups = np.frombuffer(block["groups"], "<u4").astype(np.int64)
        g0 = np.append(0, np.cumsum(n_groups))
        size = np.frombuffer(block["size"], "<u4").astype(np.int64)
        p0 = np.append(0, np.cumsum(size))
        value = impact(np.frombuffer(block["tf"], "<u4"), block["m"])  # once per (term, tf)
        docs = np.frombuffer(block["at"], "<u4")
        score = np.zeros((len(rows), block["docs"]), np.int64)
        for t, j in zip(at.tolist(), number.tolist(), strict=True):
            e = slice(self.start[j], self.start[j + 1])
            r = row_of[self.item[e]]
            coef = self.coef[e][r >= 0]
            r = r[r >= 0]
            if not len(r):
                continue
            lo, hi = g0[t], g0[t + 1]
            d = docs[p0[lo]: p0[hi]]
            v = np.repeat(value[lo:hi], size[lo:hi])
            if len(r) == 1:
                score[r[0], d] += coef[0] * v
            else:
                score[np.ix_(r, d)] += coef[:, None] * v[None, :]
        least = self.tau[rows]
        if score.shape[1] > self.k:
            least = np.maximum(least, np.partition(score, -self.k, axis=1)[:, -self.k])
        r, d = np.nonzero(score >= least[:, None])
        found = [rows[r], score[r, d], np.frombuffer(block["ids"], np.int64)[d]]
        item, s, ids = (np.concatenate([a, b]) for a, b in zip(self.best, found, strict=True))
        order = np.lexsort((ids, -s, item))
        item, s, ids = item[order], s[order], ids[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = rank == self.k - 1
        self.tau[item[last]] = np.maximum(self.tau[item[last]], s[last])
        keep = rank < self.k
        self.best = [item[keep], s[keep], ids[keep]]

    def run(self, blocks: list[dict], docs: int | None = None) -> None:
        """Visit blocks, the largest bound first; ``docs``: stop after so many documents."""
        shared = [self.known(b) for b in blocks]
        bounds = [self.bound(b, *s) for b, s in zip(blocks, shared, strict=True)]
        seen = 0
        for i in sorted(range(len(blocks)), key=lambda i: -int(bounds[i].max(initial=0))):
            live = bounds[i] >= self.tau  # equal scores still count: ties go to the smaller id
            if live.any():
                self.visit(blocks[i], *shared[i], live)
                seen += blocks[i]["docs"]
                if docs is not None and seen >= docs:
                    return


def search(index: StratifiedIndex, items: DataFrame, k: int = 10, probe_docs: int = 4096, block_items: int = 256,
           block_terms: int = 200_000, batch: int = 4) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents."""
    ids, queries, nb = item_blocks(items, index, block_items, block_terms)
    g = F.explode(F.sequence(F.lit(0), F.lit(index.groups - 1))).alias("g")
    blocks = index.blocks.read().select("g", "m", "docs", "ids", "terms", "maxtf", "groups", "tf", "size", "at").groupBy("g")

    def visit(mine: DataFrame, final: bool) -> DataFrame:
        def task(left, right):
            import pandas as pd
            found = [np.empty((0, 3), np.int64)]
            own = left.to_dict("records") if len(right) else []
            for q in right.to_dict("records") if own else []:
                s = Search(list(q["entries"]), k)
                if final:
                    taus = {t["rid"]: t["tau"] for t in q["taus"]}
                    s.tau = np.array([taus.get(i, 1) for i in s.rids.tolist()], np.int64)
                s.run(own, None if final else probe_docs)
                if final:
                    found.append(np.stack([s.rids[s.best[0]], s.best[1], s.best[2]], axis=1))
                else:
                    found.append(np.stack([s.rids, s.tau, np.full(len(s.rids), q["b"])], axis=1))
            return pd.DataFrame(np.concatenate(found), columns=["rid", "score", "other"])
        copies = mine.select("*", g).groupBy("g")  # one copy of a bounded batch per group of blocks
        return blocks.cogroup(copies).applyInPandas(task, "rid long, score long, other long")
    out = None
    for first in range(0, nb, batch):
        mine = queries.filter(F.col("b").between(first, first + batch - 1))
        tau = visit(mine, False).groupBy(F.col("other").alias("b"), "rid").agg(F.max("score").alias("tau"))
        taus = write_table(tau.groupBy("b").agg(F.collect_list(F.struct("rid", "tau")).alias("taus")), "st-taus")
        found = write_table(visit(mine.join(taus, "b"), True), "st-found")
        out = found if out is None else out.unionByName(found)
    doc_id = F.when(F.col("other") != NO_ID, F.col("other"))
    w = Window.partitionBy("rid").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = out.select("rid", doc_id.alias("doc_id"), "score").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return best.join(ids, "rid").select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    """Query: the 10 best documents of every benchmark item."""
    index = StratifiedIndex(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS bid, item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
c AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
q AS (SELECT bid, item_id, t, count(*) AS qtf FROM (SELECT bid, item_id, unnest(w) AS t FROM b) GROUP BY bid, item_id, t),
p AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY rid, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT t, count(*) AS df FROM p GROUP BY t), c),
m AS (SELECT rid, doc_id, 25 + (75 * len(w) * n) // l AS m FROM d, c WHERE len(w) > 0),
s AS (SELECT bid, item_id, rid, doc_id, CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM q JOIN w USING (t) JOIN p USING (t) JOIN m USING (rid) GROUP BY bid, item_id, rid, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY bid ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
