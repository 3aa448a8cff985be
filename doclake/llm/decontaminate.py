"""Benchmark decontamination over a distributed positional inverted index.

The training texts' postings (term, document, position) of every term that a
benchmark item uses are stored once. Each window of an item (``window``
consecutive words, or the whole item if it is shorter) is looked up by its
rarest terms: their lists, shifted by the terms' offsets in the item, are
intersected per document; an alignment that two rarest terms share is a
phrase candidate, one they share up to ``slop`` a proximity candidate. The
candidates are then compared word by word, so a hash collision cannot make a
match. Native functions only.

Defined cases: null text or item has no words and matches nothing; documents
are told apart by id and text, so repeated rows and null ids are kept and
get equal results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import ascii_lower, write_table

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: runs of digits, letters a-z (A-Z lowered) and non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATOR), "")


def _doc_key() -> Column:
    return F.xxhash64("doc_id", "text")


def item_table(items: DataFrame, window: int) -> DataFrame:
    """(ik, item_id, iw, len): items that have words; len is the window's length."""
    t = items.select(F.xxhash64("item_id", "text").alias("ik"), F.col("item_id").cast("string").alias("item_id"),
                     words(F.col("text")).alias("iw")).filter("size(iw) > 0").dropDuplicates(["ik"])
    return write_table(t.withColumn("len", F.least(F.lit(window), F.size("iw"))), "dc-items")


def build_index(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Postings (term, key, pos) of all documents for the items' vocabulary."""
    vocab = write_table(items.select(F.explode("iw").alias("w")).distinct()
                        .select("w", F.xxhash64("w").alias("term")), "dc-vocab")
    p = docs.select(_doc_key().alias("key"), F.posexplode(words(F.col("text"))).alias("pos", "w"))
    # the vocabulary is a stored table: Spark broadcasts it if its size allows, else joins by sorting
    return write_table(p.join(vocab, "w").select("term", "key", "pos"), "dc-postings")


def anchors(items: DataFrame, postings: DataFrame) -> DataFrame:
    """(ik, off, term, single): the two rarest offsets of every item window."""
    freq = postings.groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
    terms = (items.select("ik", "len", F.size("iw").alias("n"), F.posexplode("iw").alias("off", "w"))
             .withColumn("term", F.xxhash64("w")).join(freq, "term", "left"))
    # windows that contain offset off start at off-len+1 .. off, within the item
    wins = terms.withColumn("w0", F.explode(F.sequence(
        F.greatest(F.lit(0), F.col("off") - F.col("len") + 1), F.least(F.col("off"), F.col("n") - F.col("len")))))
    rank = F.row_number().over(Window.partitionBy("ik", "w0").orderBy(F.coalesce("cf", F.lit(0)), "off"))
    return write_table(wins.withColumn("r", rank).filter("r <= 2")
                       .groupBy("ik", "off", "term").agg(F.max(F.col("len") == 1).alias("single")), "dc-anchors")


def candidates(postings: DataFrame, items: DataFrame, anchor: DataFrame, slop: int) -> DataFrame:
    """(key, cs): per document the items with the alignments (document
    position of the item's word 0) that two anchors share up to ``slop``."""
    hit = (postings.join(anchor, "term")
           .select("key", "ik", "single", (F.col("pos") - F.col("off")).alias("a"), "off"))
    lists = hit.groupBy("key", "ik").agg(F.array_sort(F.collect_list(F.struct("a", "off", "single"))).alias("l"))

    def keep(x: Column, i: Column) -> Column:
        nxt, prv = F.get(F.col("l"), i + 1), F.get(F.col("l"), i - 1)
        near = F.coalesce((nxt["a"] - x["a"] <= slop) & (nxt["off"] != x["off"]), F.lit(False))
        back = F.coalesce((x["a"] - prv["a"] <= slop) & (prv["off"] != x["off"]), F.lit(False))
        return x["single"] | near | back
    al = F.array_distinct(F.transform(F.filter("l", keep), lambda x: x["a"]))
    return write_table(lists.select("key", "ik", al.alias("al")).filter("size(al) > 0").join(items, "ik")
                       .groupBy("key").agg(F.collect_list(F.struct("item_id", "iw", "len", "al")).alias("cs")),
                       "dc-candidates")


def _matches(dw: Column, c: Column, slop: int) -> Column:
    """Phrase and proximity matches of one candidate item in a document."""
    starts = F.sequence(F.lit(0), F.size(c["iw"]) - c["len"])

    def at(a: Column, exact: bool) -> Column:
        def one(w: Column) -> Column:
            win = F.slice(c["iw"], w + 1, c["len"])
            s = a + w
            if exact:
                return (s >= 0) & (s + c["len"] <= F.size(dw)) & (
                    F.slice(dw, F.greatest(s, F.lit(0)) + 1, c["len"]) == win)
            lo = F.greatest(s - slop, F.lit(0))
            return F.size(F.array_except(win, F.slice(dw, lo + 1, F.greatest(s + c["len"] + slop - lo, F.lit(0))))) == 0
        return F.transform(F.filter(starts, one), lambda w: F.struct(
            c["item_id"].alias("item_id"), F.lit("phrase" if exact else "proximity").alias("kind"),
            w.alias("item_start"), (a + w).alias("start"), c["len"].alias("len")))
    exact = F.flatten(F.transform(c["al"], lambda a: at(a, True)))
    if slop <= 0:
        return exact
    near = F.flatten(F.transform(c["al"], lambda a: at(a, False)))
    return F.when(F.exists(c["al"], lambda a: F.size(at(a, True)) > 0), exact).otherwise(near)


def matched(docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 3) -> DataFrame:
    """``docs`` with ``__n_words`` and ``__matches``: array of (item_id, kind
    phrase | proximity, item_start, start, len)."""
    it = item_table(items, window)
    postings = build_index(docs, it)
    cand = candidates(postings, it, anchors(it, postings), slop)
    # candidates grow with the documents: one plan at every size, by sorting
    cand = cand.select(F.col("key").alias("__k"), F.col("cs").alias("__cs")).hint("merge")
    d = (docs.withColumn("__key", _doc_key()).join(cand, F.col("__key") == F.col("__k"), "left")
         .drop("__k", "__key").withColumn("__w", words(F.col("text"))))
    kind = "array<struct<item_id:string,kind:string,item_start:int,start:int,len:int>>"
    found = F.when(F.col("__cs").isNotNull(), F.flatten(F.transform(
        "__cs", lambda c: _matches(F.col("__w"), c, slop))).cast(kind)).otherwise(F.array().cast(kind))
    return (d.withColumn("__n_words", F.size("__w").cast("long")).withColumn("__matches", found).drop("__cs", "__w"))


def find_matches(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """doc_id, n_words and ``matches`` per document."""
    m = matched(docs.select("doc_id", "text"), items, **params)
    return m.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__matches").alias("matches"))


def digests(found: DataFrame) -> DataFrame:
    m = F.filter("matches", lambda x: x["kind"] == "phrase")
    hit = F.array_distinct(F.flatten(F.transform(m, lambda x: F.sequence(x["start"], x["start"] + x["len"] - 1))))
    ids = F.array_sort(F.array_distinct(F.transform(m, lambda x: x["item_id"])))
    near = F.array_distinct(F.transform(F.filter("matches", lambda x: x["kind"] == "proximity"), lambda x: x["item_id"]))
    return found.select(
        "doc_id", "n_words", F.size(hit).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (F.size(m) > 0).alias("contaminated"),
        F.size(near).cast("long").alias("n_near_items"))


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Query: hits of 10-word benchmark windows in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(find_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))).drop("n_near_items")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
dw AS (SELECT rid, s, k.n, array_to_string(list_slice(w, s, s + k.n - 1), ' ') AS g
    FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS s FROM d), (SELECT DISTINCT n FROM bw) k WHERE s + k.n - 1 <= len(w)),
hit AS (SELECT rid, s, dw.n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hit) GROUP BY rid),
i AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN i USING (rid)
"""
