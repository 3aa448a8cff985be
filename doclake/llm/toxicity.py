"""Toxicity scores from a factorization machine over hashed terms.

Terms are a text's words and word beginnings, hashed to ``2 ** bits``
columns; a text's value in a column is 1 if it has such a term. The machine
learns a weight per column and a short vector per column, whose products
weigh pairs of terms, so that two terms together can count for more than
their sum. It is fitted in one task on a bounded sample of labelled rows
(``max_labelled`` different ones, those with the smallest hash; rows equal in
id, text and label count once); every text is then scored whole, in parallel.

Defined cases: null and empty texts get the machine's bias as score; ids
without labels are scored alike; labels that repeat or disagree are used as
they are; null labels are not used; without any labelled row all scores are
0. Other columns are ignored and never inputs of a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import write_table

#: what separates words: ASCII other than letters and digits, mapped to blanks; A-Z are lowered
_TABLE = bytes(ord(chr(i).lower()) if chr(i).isascii() and chr(i).isalnum() else 32 if i < 128 else i for i in range(256))
_AFFIXES = (4, 6, 7)  # lengths of the word beginnings, in bytes


def terms(text: str | None, bits: int, cache: dict) -> np.ndarray:
    """Distinct columns of a text: its words and word beginnings."""
    words = set((text or "").encode().translate(_TABLE).split())
    out = set()
    mask = (1 << bits) - 1
    for w in words:
        got = cache.get(w)
        if got is None:
            got = [zlib.crc32(b"w" + w) & mask] + [zlib.crc32(b"p" + w[:n]) & mask for n in _AFFIXES if len(w) > n]
            if len(cache) > 1 << 18:
                cache.clear()
            cache[w] = got
        out.update(got)
    return np.fromiter(out, np.int64, len(out))


def _score(w0: float, w: np.ndarray, v: np.ndarray, idx: np.ndarray, ptr: np.ndarray):
    """Raw scores of rows in compressed form, and the rows' sums of vectors."""
    n = len(ptr) - 1
    row = np.repeat(np.arange(n), np.diff(ptr))
    lin = np.bincount(row, weights=w[idx], minlength=n)
    vi = v[idx]
    s = np.stack([np.bincount(row, weights=vi[:, f], minlength=n) for f in range(v.shape[1])], axis=1)
    sq = np.bincount(row, weights=(vi ** 2).sum(axis=1), minlength=n)
    return w0 + lin + 0.5 * ((s ** 2).sum(axis=1) - sq), s, row


def informative(rows: list[np.ndarray], y: np.ndarray, size: int, min_docs: int, min_chi2: float) -> tuple[np.ndarray, np.ndarray]:
    """Columns in ``min_docs`` rows or more, and those of them whose presence tells the labels apart."""
    flat = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    seen = np.bincount(flat, minlength=size).astype(float)
    hit = np.bincount(flat, weights=np.repeat(y, [len(r) for r in rows]), minlength=size)
    n, pos = float(len(y)), float(y.sum())
    spread = seen * (n - seen) * pos * (n - pos)
    chi2 = np.divide(n * (n * hit - seen * pos) ** 2, spread, out=np.zeros(size), where=spread > 0)
    often = seen >= min_docs
    return often, often & (chi2 >= min_chi2)


def fit(rows: list[np.ndarray], y: np.ndarray, bits: int, rank: int = 4, epochs: int = 12, rate: float = 0.1,
        l2: float = 2e-3, l2_pairs: float = 0.1, min_docs: int = 3, min_chi2: float = 25.0, batch: int = 256,
        seed: int = 5, pair_docs: int = 50, pair_rate: float = 0.2) -> dict:
    """Factorization machine by adaptive gradient steps on the logistic loss.

    Columns in fewer than ``min_docs`` sampled rows, or whose presence and the
    label have a chi-square below ``min_chi2``, keep weight 0; every column in
    ``pair_docs`` rows or more has a factor vector, so that terms which tell
    nothing alone count as pairs. Positive rows weigh as much as all others
    together, up to a factor of 4.
    """
    rng = np.random.default_rng(seed)
    size = 1 << bits
    often, used = informative(rows, y, size, min_docs, min_chi2)
    paired = used | (np.bincount(np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64), minlength=size) >= pair_docs)
    rows = [r[paired[r]] for r in rows]
    w0, w, v = 0.0, np.zeros(size), np.zeros((size, rank))
    v[paired] = rng.normal(0, 0.01, (int(paired.sum()), rank))
    gw, gv, g0 = np.full(size, 1e-6), np.full((size, rank), 1e-6), 1e-6
    pos = max(1.0, float(y.sum()))
    weight = np.where(y > 0, min(4.0, max(1.0, (len(y) - pos) / pos)), 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            pick = order[at: at + batch]
            idx = np.concatenate([rows[i] for i in pick])
            ptr = np.concatenate([[0], np.cumsum([len(rows[i]) for i in pick])])
            raw, s, row = _score(w0, w, v, idx, ptr)
            err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[pick]) * weight[pick] / len(pick)
            cols, inv = np.unique(idx, return_inverse=True)
            if not len(cols):
                w0 -= rate * float(err.sum()) / (g0 + float(err.sum()) ** 2) ** 0.5
                continue
            dw = np.where(used[cols], np.bincount(inv, weights=err[row], minlength=len(cols)) + l2 * w[cols] / len(cols) ** 0.5, 0.0)
            vi = v[idx]
            part = err[row][:, None] * (s[row] - vi)
            dv = np.stack([np.bincount(inv, weights=part[:, f], minlength=len(cols)) for f in range(rank)], axis=1)
            dv += l2_pairs * v[cols] / len(cols) ** 0.5
            gw[cols] += dw ** 2
            gv[cols] += dv ** 2
            w[cols] -= rate * dw / np.sqrt(gw[cols])
            v[cols] -= pair_rate * rate * dv / np.sqrt(gv[cols])
            d0 = float(err.sum())
            g0 += d0 ** 2
            w0 -= rate * d0 / g0 ** 0.5
    return {"w0": w0, "w": w.astype(np.float32), "v": v.astype(np.float32)}


def training_sample(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """(doc_id, text, th, toxic): labelled rows outside the held-out fold, by hash
    at most ``max_labelled`` different ones (id, text and label), with their copies."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    lab = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold != 0))
    # the bound holds before the join, so the broadcast side has at most so many short rows
    lab = write_table(lab.select("doc_id", F.col("toxic").cast("double").alias("toxic"))
                      .orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(max_labelled), "tox-labels")
    rows = (docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id")
            .select("doc_id", "text", F.xxhash64("text").alias("th"), "toxic"))
    # and again after it, on rows without their texts: an id may stand for many documents
    chosen = write_table(rows.select("doc_id", "th", "toxic").distinct()
                         .orderBy(F.xxhash64("doc_id", "th", F.lit(5)), "doc_id", "th", "toxic").limit(max_labelled), "tox-chosen")
    return rows.join(F.broadcast(chosen), ["doc_id", "th", "toxic"], "left_semi")


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, bits: int = 18) -> dict | None:
    """The model: featurised in parallel, fitted in one task, about 5 MB."""

    def featurise(batches: Iterator) -> Iterator:
        import pyarrow as pa
        cache: dict = {}
        seen: set = set()  # at most max_labelled entries
        for b in batches:
            keys = list(zip(*[b.column(c).to_pylist() for c in ("doc_id", "th", "toxic")], strict=True))
            first = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
            b = b.take(pa.array(first, pa.int64()))
            cols = [np.sort(terms(t.as_py(), bits, cache)).astype(np.int32) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), b.column("toxic"), pa.array(cols, pa.list_(pa.int32()))],
                                             names=["doc_id", "th", "toxic", "cols"])
    feats = write_table(training_sample(docs, labels, max_labelled)
                        .mapInArrow(featurise, "doc_id long, th long, toxic double, cols array<int>")
                        .dropDuplicates(["doc_id", "th", "toxic"]), "tox-sample")

    def learn(batches: Iterator) -> Iterator:
        import pickle

        import pyarrow as pa
        got = []
        for b in batches:
            vals, offs = b.column("cols"), b.column("cols").offsets.to_numpy()
            flat = vals.values.to_numpy()
            for i, (d, th, t) in enumerate(zip(*[b.column(c).to_pylist() for c in ("doc_id", "th", "toxic")], strict=True)):
                got.append((d, th, t, flat[offs[i]: offs[i + 1]].astype(np.int64)))
        got.sort(key=lambda x: x[:3])
        if got:
            model = fit([g[3] for g in got], np.array([g[2] for g in got]), bits)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model, protocol=5)], pa.binary())], names=["model"])
    stored = write_table(feats.coalesce(1).mapInArrow(learn, "model binary"), "tox-model")
    row = stored.first()
    if row is None:
        return None
    import pickle
    return pickle.loads(row["model"])


def score_texts(docs: DataFrame, model: dict | None, bits: int = 18) -> DataFrame:
    """``docs`` with a column ``__score`` (0 to 1)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # a fixed size: 2 ** bits columns
    schema = docs.drop("__score").schema.add("__score", "double")

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa
        m, cache = shared.value, {}
        for b in batches:
            if m is None:
                p = np.zeros(b.num_rows)
            else:
                rows = [terms(t.as_py(), bits, cache) for t in b.column("text")]
                p = np.empty(len(rows))
                for at in range(0, len(rows), 256):
                    part = rows[at: at + 256]
                    ptr = np.concatenate([[0], np.cumsum([len(r) for r in part])])
                    raw, _, _ = _score(m["w0"], m["w"], m["v"], np.concatenate(part), ptr)
                    p[at: at + 256] = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], names=[*b.schema.names, "__score"])
    return docs.drop("__score").mapInArrow(score, schema)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Query: score and prediction of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_texts(docs, model).select(
        "doc_id", held_out().alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"))
