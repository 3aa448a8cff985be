"""Personal data: base spans and spans found by bootstrapped contexts.

Base spans (email, ip, card, phone) are the seeds. Their lexical contexts -
the two words before, or the word before with the word after - are patterns.
Patterns and instances form a graph that is scored in rounds: a pattern's
confidence is the mean score of its distinct instances (smoothed), an
instance's score is the noisy-or of its patterns' confidences. Tokens with a
digit or an at sign outside all base spans that reach the threshold become
spans of the pattern's kind. Native functions only; the text is read once.

Defined cases: null text counts as empty; null ``doc_id`` is kept; repeated
rows are returned as often as they occur; other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import write_table

# The kinds, in the order of the result.
KINDS = ("email", "ip", "card", "phone")

# The kinds' patterns in a form without backtracking. A run of name or digit
# characters is only entered at its first character (or where the last match
# ended): if a later start matched, so would the first one.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# A text without this cannot hold the kind.
_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
_IP_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _found(pattern: str, hint: str) -> Column:
    """Array of (m, start, end, left, right): matches with code point
    positions and the text around them, from matches and gaps."""
    text = F.when(F.col("t").rlike(hint), F.col("t")).otherwise(F.lit(""))
    ms, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    return F.zip_with(ms, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g")))


def _positions(arr: Column) -> Column:
    """Add start and end: a running sum of gap and match lengths."""
    kind = "struct<at:int,out:array<struct<m:string,s:int,e:int,l:string,r:string>>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<m:string,s:int,e:int,l:string,r:string>>")
                    .alias("out")).cast(kind)

    def step(acc: Column, i: Column) -> Column:
        x, nxt = F.get(arr, i), F.get(arr, i + 1)
        start = acc["at"] + F.length(x["g"])
        end = start + F.length(x["m"])
        item = F.struct(x["m"].alias("m"), start.alias("s"), end.alias("e"),
                        F.substring(x["g"], -80, 80).alias("l"), F.substring(nxt["g"], 1, 40).alias("r"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(item)).alias("out")).cast(kind)
    # the last element of the array is the gap behind the last match
    return F.when(F.size(arr) > 1,
                  F.aggregate(F.sequence(F.lit(0), F.size(arr) - 2), zero, step)["out"]).otherwise(zero["out"])


def base_spans(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, th (hash of the text), one array of spans per
    kind, and ``cand``: tokens with a digit or an at sign outside all spans."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    d = d.withColumn("th", F.xxhash64("t"))
    for k in KINDS:
        d = d.withColumn(f"r_{k}", _found(_PATTERNS[k], _HINT[k]))
    d = d.withColumn("r_cand", _found(_TOKEN, "[0-9@]")).drop("t")
    for k in (*KINDS, "cand"):
        d = d.withColumn(k, _positions(F.col(f"r_{k}"))).drop(f"r_{k}")
    for k in KINDS:
        d = d.withColumn(k, F.filter(k, _keeps(k)))
    spans = F.concat(*KINDS)
    return d.withColumn("cand", F.when(
        F.size(spans) > 0,
        F.filter("cand", lambda c: ~F.exists(spans, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))))
        .otherwise(F.col("cand")))


def _contexts(x: Column) -> Column:
    """The patterns of one occurrence: 'two words before', 'word before + word after'."""
    left = F.filter(F.split(F.lower(x["l"]), r"\s+"), lambda w: w != "")
    right = F.filter(F.split(F.lower(x["r"]), r"\s+"), lambda w: w != "")
    n = F.size(left)
    two = F.when(n >= 2, F.concat_ws(" ", F.get(left, n - 2), F.get(left, n - 1), F.lit("_")))
    around = F.when((n >= 1) & (F.size(right) >= 1),
                    F.concat_ws(" ", F.get(left, n - 1), F.lit("_"), F.get(right, F.lit(0))))
    return F.array_compact(F.array(two, around))


def _keeps(kind: str):
    return lambda x: _valid(kind, x["m"])


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


def _span(kind: str):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"))


def _seed(kind: str):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x["m"].alias("inst"), x["s"].alias("s"), x["e"].alias("e"),
                              _contexts(x).alias("ps"))


def occurrences(base: DataFrame) -> DataFrame:
    """One row per (occurrence, pattern): doc_id, th, kind (null for a token
    that is not a seed), inst, s, e, pattern."""
    arr = F.concat(
        *[F.transform(k, _seed(k)) for k in KINDS],
        F.transform("cand", lambda x: F.struct(
            F.lit(None).cast("string").alias("kind"),
            F.regexp_replace(x["m"], r"^[^0-9A-Za-z@+]+|[^0-9A-Za-z]+$", "").alias("inst"),
            x["s"].alias("s"), x["e"].alias("e"), _contexts(x).alias("ps"))))
    o = base.select("doc_id", "th", F.explode(arr).alias("o")).select("doc_id", "th", "o.*")
    return o.filter("inst <> ''").select("doc_id", "th", "kind", "inst", "s", "e", F.explode("ps").alias("pattern"))


def bootstrap(occ: DataFrame, rounds: int = 3, min_support: int = 3,
              pattern_conf: float = 0.6, accept: float = 0.7) -> DataFrame:
    """Accepted (inst, kind, score) among the unseen instances.

    ``min_support`` distinct instances per pattern; copies of a document do
    not add support. Only aggregates and equi-joins over distinct edges, so a
    pattern or an instance with a third of all occurrences is one edge set.
    """
    edges = write_table(occ.groupBy("pattern", "inst").agg(F.max("kind").alias("kind")), "pii-edges")
    spark = occ.sparkSession
    size = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"),
                                        F.count("kind").alias("seeds"))
    live = write_table(edges.join(size.filter((F.col("n") >= min_support) & (F.col("seeds") >= 1)), "pattern"),
                       "pii-live")
    score = live.filter("kind is not null").select("inst", "kind", F.lit(1.0).alias("score")).distinct()
    seeds = score
    for _ in range(rounds):
        # a pattern's confidence per kind: score mass over its instances, smoothed by one
        conf = (live.select("pattern", "inst", "n").join(score, "inst")
                .groupBy("pattern", "kind").agg((F.sum("score") / (F.first("n") + 1)).alias("conf"))
                .filter(F.col("conf") >= pattern_conf))
        new = (live.filter("kind is null").select("pattern", "inst").join(conf, "pattern")
               .groupBy("inst", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.least(F.col("conf"), F.lit(0.999))))))
                                            .alias("score")))
        score = write_table(seeds.unionByName(new), "pii-score")
    best = score.join(seeds.select("inst").distinct(), "inst", "left_anti").filter(F.col("score") >= accept)
    return best.groupBy("inst").agg(F.max(F.struct("score", "kind")).alias("b")).select(
        "inst", F.col("b.kind").alias("kind"), F.col("b.score").alias("score"))


def _digest(arr: Column) -> Column:
    return F.concat_ws(",", F.transform(arr, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])))


def find_pii(docs: DataFrame, **params) -> DataFrame:
    """doc_id, ``base`` and ``found``: arrays of (kind, s, e), positions in
    code points, end exclusive; ``base`` by kind and start."""
    base = write_table(base_spans(docs), "pii-base")
    occ = write_table(occurrences(base), "pii-occ")
    hits = (occ.filter("kind is null").select("doc_id", "th", "inst", "s", "e").distinct()
            .join(bootstrap(occ, **params).select("inst", "kind"), "inst")
            .groupBy("doc_id", "th").agg(F.collect_set(F.struct("kind", "s", "e")).alias("found")))
    hits = write_table(hits.select(F.col("doc_id").alias("h_id"), F.col("th").alias("h_th"), "found"), "pii-hits")
    spans = F.concat(*[F.transform(k, _span(k)) for k in KINDS])
    kind_t = "array<struct<kind:string,s:int,e:int>>"
    return (base.select("doc_id", "th", spans.cast(kind_t).alias("base"))
            .join(hits, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("th") == F.col("h_th")), "left")
            .select("doc_id", "base", F.coalesce(F.col("found").cast(kind_t), F.array().cast(kind_t)).alias("found")))


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Query: counts and digests of the base spans, and all spans."""
    r = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def by_kind(arr: Column) -> Column:
        return F.concat(*[F.array_sort(F.filter(arr, _of_kind(k))) for k in KINDS])
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return r.select("doc_id", *counts, F.sha2(_digest(F.col("base")), 256).alias("base_sha256"),
                    _digest(by_kind(F.concat("base", "found"))).alias("spans"),
                    F.size("found").cast("long").alias("n_found"))
