"""Vector code compression: product codes by Lloyd rounds with resident members.

Every vector is cut into parts; a part is a member of its nearest codebook
entry of its position. Members are stored once, in a table bucketed by owner
(position, entry, salt), and never exchanged again. In a round each owner
looks at its resident members in place; only parts that change their entry
are exchanged: an entry in the moves table (bucketed alike) tells the old
owner that the part left and brings it to the new one. Owners then sum up
their resident members, the arrivals where they arrived, and the new codebook
(a fixed number of small vectors) goes out with the next round. The salt
bounds an owner's members whatever the share of one entry.

Defined cases: rows whose vector is null or holds null or non-finite
components are left out, and so are those of another length than the row with
the smallest id has; components are held between -2^62 and 2^62 and errors at
2^63 - 1; vectors of a length that the parts do not divide are cut at
i * length / parts, rounded down; equal ids start in the order of their
vectors, null ids last; rows are told apart by position, so repeated rows are
all coded; fewer rows than entries make a smaller codebook; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.bucketed import BucketedTable
from doclake.llm.common import shared_folder, write_table
from doclake.llm.groups import join_groups

HELD = 1 << 62  # components are held at this magnitude
MOST = (1 << 63) - 1
OWNER = ["position", "entry", "salt"]
MEMBER = "position int, entry int, salt int, rid long, vec binary"
SHIFT = 40  # sums travel as two longs


def integer_vectors(rows: DataFrame, scale: float) -> DataFrame:
    """(rid, vec_id, label, v) of the rows that take part, stored."""
    v = F.transform("embedding", lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale).cast("long"),
                                                              F.lit(HELD)), F.lit(-HELD)))
    ok = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return write_table(rows.filter(F.coalesce(ok, F.lit(False))).select(
        F.monotonically_increasing_id().alias("rid"), "vec_id", "label", v.alias("v")), "ll-vectors", "zstd")


def nearest(x: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry, ties to the lower one, and the squared distance."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(codebook).max(initial=0)))
    if 4 * top * top * max(1, x.shape[1]) < 1 << 53:  # every product and sum is exact in doubles
        f, c = x.astype(np.float64), codebook.astype(np.float64)
        d = (f * f).sum(axis=1)[:, None] - 2 * (f @ c.T) + (c * c).sum(axis=1)[None, :]
        e = d.argmin(axis=1)
        return e, d[np.arange(len(x)), e].astype(np.int64)
    best, e = None, np.zeros(len(x), np.int64)
    for i, entry in enumerate(codebook.astype(object)):
        d = ((x.astype(object) - entry) ** 2).sum(axis=1)
        closer = np.zeros(len(x), bool) if best is None else (d < best).astype(bool)
        best, e = (d, e) if best is None else (np.where(closer, d, best), np.where(closer, i, e))
    return e, np.minimum(best, MOST).astype(np.int64)


def vectors(column) -> np.ndarray:
    """Binary parts as a matrix."""
    flat = np.frombuffer(b"".join(column), np.int64)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def residents(base, moves):
    """(rid, vec) that an owner holds: its latest event for a part is an arrival."""
    import pandas as pd
    if not len(moves):
        return base[["rid", "vec"]]
    events = pd.concat([base[["rid", "vec"]].assign(at=1, arrived=True), moves[["rid", "vec", "at", "arrived"]]])
    last = events.sort_values("at", kind="stable").drop_duplicates("rid", keep="last")
    return last[last["arrived"].astype(bool)][["rid", "vec"]]


def sums(x: np.ndarray):
    """(j, hi, lo, n): the members' sum per component, in two longs."""
    import pandas as pd
    total = [int(t) for t in x.astype(object).sum(axis=0)] if len(x) and np.abs(x).max(initial=0) >= 1 << 40 else x.sum(axis=0).tolist()
    return pd.DataFrame({"j": range(len(total)), "hi": [t >> SHIFT for t in total],
                         "lo": [t & ((1 << SHIFT) - 1) for t in total], "n": len(x)})


def owner_sums(members: DataFrame) -> DataFrame:
    """(position, entry, j, hi, lo, n) of each owner's rows of a bucketed table; no exchange."""
    def task(key, pdf):
        s = sums(vectors(pdf["vec"])) if len(pdf) else sums(np.zeros((0, 0), np.int64))
        s.insert(0, "entry", key[1])
        s.insert(0, "position", key[0])
        return s
    return members.groupBy(*OWNER).applyInPandas(task, "position int, entry int, j int, hi long, lo long, n long")


def updated(codebooks: list[np.ndarray], parts: list[DataFrame]) -> list[np.ndarray]:
    """Entries replaced by their members' mean, rounded down; unused ones stay."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    new = [c.copy() for c in codebooks]  # at most positions x entries x components rows
    for r in both.groupBy("position", "entry", "j").agg(*[F.sum(c).alias(c) for c in ("hi", "lo", "n")]).collect():
        if r["n"]:
            new[r["position"]][r["entry"], r["j"]] = ((r["hi"] << SHIFT) + r["lo"]) // r["n"]
    return new


class ResidentLloyd:
    """Members in their owners' buckets, and the moves of the rounds so far."""

    def __init__(self, vecs: DataFrame, codebooks: list[np.ndarray], cuts: list[int], owner_rows: int):
        self.spark, n = vecs.sparkSession, vecs.count()
        salts = max(1, -(-n // owner_rows))
        buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")),
                      -(-n * len(codebooks) // (4 * owner_rows)))
        folder = shared_folder(self.spark, "ll-members")
        self.codebooks = codebooks
        self.base = BucketedTable(self.spark, f"{folder}/base", MEMBER, OWNER, buckets, "made")
        self.moves = BucketedTable(self.spark, f"{folder}/moves", f"{MEMBER}, arrived boolean, at int", OWNER, buckets, "round")

        def first(batches):
            import pyarrow as pa
            for b in batches:
                rid = b.column("rid").to_numpy()
                x = b.column("v").flatten().to_numpy().reshape(len(rid), cuts[-1])
                for p, codebook in enumerate(codebooks):
                    part = np.ascontiguousarray(x[:, cuts[p]: cuts[p + 1]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rid), p, np.int32)), pa.array(nearest(part, codebook)[0].astype(np.int32)),
                         b.column("salt"), pa.array(rid), pa.array([r.tobytes() for r in part], pa.binary())],
                        names=[*OWNER, "rid", "vec"])
        salted = vecs.select("rid", F.pmod(F.xxhash64("rid"), F.lit(salts)).cast("int").alias("salt"), "v")
        self.base.put(salted.mapInArrow(first, MEMBER), "first")
        self.codebooks = updated(codebooks, [owner_sums(self.base.read())])

    def _owners(self, task, schema: str) -> DataFrame:
        return (self.base.read().groupBy(*OWNER).cogroup(self.moves.read().groupBy(*OWNER)).applyInPandas(task, schema))

    def round(self, at: int) -> bool:
        """One more assignment and update; False if no part changed its entry."""
        codebooks = self.codebooks

        def task(key, base, moves):
            import pandas as pd
            own = residents(base, moves)
            x = vectors(own["vec"]) if len(own) else np.zeros((0, codebooks[key[0]].shape[1]), np.int64)
            e = nearest(x, codebooks[key[0]])[0].astype(np.int32)
            stays = e == key[1]
            gone = own[~stays]
            leaves = pd.DataFrame({"entry": np.int32(key[1]), "rid": gone["rid"], "vec": None, "arrived": False})
            comes = pd.DataFrame({"entry": e[~stays], "rid": gone["rid"], "vec": gone["vec"], "arrived": True})
            kept = sums(x[stays]).assign(entry=np.int32(key[1]))
            out = pd.concat([kept, leaves, comes], ignore_index=True).assign(position=key[0], salt=key[2], at=at)
            return out[["position", "entry", "salt", "rid", "vec", "arrived", "at", "j", "hi", "lo", "n"]].astype(
                {"rid": "Int64", "arrived": "boolean", "j": "Int32", "hi": "Int64", "lo": "Int64", "n": "Int64"})
        seen = write_table(self._owners(task, f"{MEMBER}, arrived boolean, at int, j int, hi long, lo long, n long"), "ll-round", "zstd")
        changed = seen.filter("arrived is not null").drop("j", "hi", "lo", "n")
        if changed.isEmpty():
            return False
        self.moves.put(changed, f"r{at}")
        stay = seen.filter("j is not null").select("position", "entry", "j", "hi", "lo", "n")
        self.codebooks = updated(codebooks, [stay, owner_sums(self.moves.only(f"r{at}").filter("arrived"))])
        return True

    def codes(self) -> DataFrame:
        """(rid, position, entry, error) of every part under the present codebooks."""
        codebooks = self.codebooks

        def task(key, base, moves):
            import pandas as pd
            own = residents(base, moves)
            if not len(own):
                return pd.DataFrame({"rid": [], "position": [], "entry": [], "error": []}).astype("int64")
            e, d = nearest(vectors(own["vec"]), codebooks[key[0]])
            return pd.DataFrame({"rid": own["rid"].to_numpy(), "position": key[0], "entry": e, "error": d})
        return self._owners(task, "rid long, position int, entry int, error long")


def _held(total) -> object:
    """A sum of longs, held at the largest one."""
    return F.least(F.sum(total.cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long")


def compress(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: float = 4096.0,
             owner_rows: int = 32_768) -> tuple[DataFrame, list[np.ndarray]]:
    """((rid, vec_id, label, code, error), codebooks) of ``rows`` (vec_id, embedding, label)."""
    vecs = integer_vectors(rows, scale)
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    one = vecs.orderBy(*order).limit(1).collect()
    size = len(one[0]["v"]) if one else 0
    vecs = vecs.filter(F.size("v") == size)
    start = [r["v"] for r in vecs.orderBy(*order).limit(entries).collect()]
    start = np.array(start, np.int64).reshape(len(start), size)
    cuts = [i * size // parts for i in range(parts + 1)]
    if not one:
        return vecs.select("rid", "vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    job = ResidentLloyd(vecs, [start[:, cuts[p]: cuts[p + 1]] for p in range(parts)], cuts, owner_rows)
    for at in range(2, rounds + 1):
        if not job.round(at):  # the same members give the same entries for ever
            break
    pair = F.lpad(F.lower(F.hex("entry")), 2, "0")
    coded = (job.codes().groupBy("rid")
             .agg(F.array_sort(F.collect_list(F.struct("position", pair.alias("h")))).alias("hs"), _held(F.col("error")).alias("error"))
             .select("rid", F.concat_ws("", F.col("hs.h")).alias("code"), "error"))
    return vecs.select("rid", "vec_id", "label").join(coded.hint("merge"), "rid"), job.codebooks


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Query: codes of all embeddings, their errors, and the errors per label."""
    coded, codebooks = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))
    coded = write_table(coded, "ll-codes", "zstd")
    text = ",".join(str(int(x)) for c in codebooks for x in c.ravel())
    labels = write_table(coded.groupBy("label").agg(_held(F.col("error")).alias("label_error"), F.count(F.lit(1)).alias("size")), "ll-labels")
    return (join_groups(coded.select("vec_id", "code", "error", "label"), labels, "label", "size", coded.count(), null_keys=True)
            .select("vec_id", "code", "error", "label_error",
                    F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256")))


def oracle(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same in SQL, one assignment and one update per round written out."""
    sql = f"""WITH k AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS rid, vec_id, label,
        list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT rid, (i * {parts}) // len(v) AS p, i, v[i + 1] AS x
    FROM (SELECT rid, v, unnest(range(len(v))) AS i FROM k)),
c0 AS MATERIALIZED (SELECT p, CAST(rid AS INTEGER) AS e, i, x AS c FROM x WHERE rid < {entries})"""
    for r in range(rounds + 1):
        sql += f""",
a{r} AS MATERIALIZED (SELECT rid, p, min(d * {entries} + e) % {entries} AS e, min(d * {entries} + e) // {entries} AS d
    FROM (SELECT rid, p, e, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM x JOIN c{r} USING (p, i) GROUP BY rid, p, e) GROUP BY rid, p)"""
        if r < rounds:
            sql += f""",
m{r} AS (SELECT p, e, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS c FROM x JOIN a{r} USING (rid, p) GROUP BY p, e, i),
c{r + 1} AS MATERIALIZED (SELECT p, e, i, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (p, e, i))"""
    return sql + f""",
o AS (SELECT rid, string_agg(lower(format('{{:02x}}', CAST(e AS INTEGER))), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) FROM c{rounds}) AS codebooks_sha256
FROM k JOIN o USING (rid)"""


ORACLE_SQL = oracle()
