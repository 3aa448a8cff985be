"""Ranked search, vector codes and exact dedup against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from doclake.llm import digests, lloyd, strata
from doclake.llm.common import shared_folder
from doclake.llm.groups import join_groups

from . import brute


def write(df, tmp, table):
    df.write.parquet(f"{tmp}/{table}.parquet")
    return tmp


# exact dedup

def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain_dedup(rows):
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(normal(t), []).append((d is None, d or 0, i))
    out = []
    for i, (d, t) in enumerate(rows):
        g = groups[normal(t)]
        keep = min(g)
        out.append((d, rows[keep[2]][0], len(g), keep[2] == i, hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(map(str, out))


def test_exact_dedup(spark, tmp, edge_docs, edge_rows):
    more = [(20_001, "a  b\n"), (20_000, "a b "), (20_002, "a b"), (20_003, "a\xa0b"), (20_004, " "), (None, "a b"), (None, None)]
    docs = edge_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = digests.op13_exact_dedup(spark, write(docs, tmp, "documents")).collect()
    assert sorted(str(tuple(r)) for r in got) == plain_dedup([(r[0], r[1]) for r in edge_rows] + more)


def test_exact_dedup_empty_and_null_ids(spark, tmp, no_docs):
    assert digests.op13_exact_dedup(spark, write(no_docs, tmp, "documents")).count() == 0
    rows = [(None, "x")] * 3 + [(None, "y")]
    got = digests.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(tuple(r)) for r in got) == plain_dedup(rows)


def test_digest_index_outlives_its_session(spark):
    folder = shared_folder(spark, "index")
    schema = "doc_id long, text string, digest string, wave string, n long, __group int"
    make = lambda rows: spark.createDataFrame([(*r, "d", "w", 1, 2) for r in rows], schema)
    first = digests.DigestIndex(spark, folder, 8)
    one = digests.keep_new(first, make([(5, "a"), (3, "a"), (9, "b"), (9, "b"), (4, None)]), "monday")
    assert one.columns == schema.replace(",", "").split()[::2]
    assert sorted((r.doc_id, r.text) for r in one.collect()) == [(3, "a"), (4, None), (9, "b")]
    again = digests.DigestIndex(spark, folder, 8)  # another session opens the stored tables
    tuesday = [(1, "a"), (7, "c"), (6, "c "), (8, "c"), (2, "")]
    for _ in range(2):  # a wave that is run again gives the same
        kept = digests.keep_new(again, make(tuesday), "tuesday").collect()
        assert sorted((r.doc_id, r.text) for r in kept) == [(6, "c "), (7, "c")]
        sizes = {r.keep_id: r.group_size for r in again.figures().collect()}
        assert sizes == {3: 3, 9: 2, 4: 2, 7: 2, 6: 1}
    assert digests.keep_new(again, make([]), "wednesday").count() == 0


def test_digest_index_is_not_exchanged(spark):
    index = digests.DigestIndex(spark, shared_folder(spark, "index"), 16)
    rows = digests.digest_rows(spark.createDataFrame([(i, f"t{i % 7}") for i in range(60)], "doc_id long, text string"))
    index.add(rows, "w")
    plan = index.figures()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_join_groups_splits_hot_groups(spark):
    rows = spark.createDataFrame([(i, None if i % 3 else i) for i in range(3000)], "i long, key long")
    groups = rows.groupBy("key").count()
    got = join_groups(rows, groups, "key", "count", 3000, null_keys=True)
    assert {(r.key is None, r["count"]) for r in got.collect()} == {(True, 2000), (False, 1)}
    assert got.count() == 3000


# vector codes

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label) -> [(vec_id, code, error, label_error, sha)]."""
    held = lambda x: max(-lloyd.HELD, min(lloyd.HELD, math.floor(4096 * x)))
    kept = [(i, [held(x) for x in v], la) for i, v, la in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == size]
    cuts = [i * size // parts for i in range(parts + 1)]
    cut = [[v[a:b] for a, b in zip(cuts, cuts[1:], strict=False)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            best = []
            for p in range(parts):
                d = [sum((x - y) ** 2 for x, y in zip(c[p], e, strict=True)) for e in books[p]]
                best.append((d.index(min(d)), min(d)))
            out.append(best)
        return out
    for _ in range(rounds):
        a = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, x in zip(cut, a, strict=True) if x[p][0] == e]
                if own:
                    books[p][e] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    top = lloyd.MOST
    a = assign()
    error = [min(top, sum(min(top, d) for _, d in x)) for x in a]
    label = Counter()
    for (_, _, la), e in zip(kept, error, strict=True):
        label[la] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{e:02x}" for e, _ in x), er, min(top, label[la]), sha)
            for (i, _, la), x, er in zip(kept, a, error, strict=True)]


SCHEMA = "vec_id long, embedding array<float>, label int, rid long, position int, salt int, code string, size long, v int"


def op12(spark, tmp, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3, "c", 4, 5) for r in rows], SCHEMA).repartition(3)
    df.write.mode("overwrite").parquet(f"{tmp}/embeddings.parquet")
    return sorted(str(tuple(r)) for r in lloyd.op12_vector_codes(spark, tmp).collect())


def floats(values):
    import numpy as np
    return [float(np.float32(v)) for v in values]


def test_vector_codes(spark, tmp):
    rng = random.Random(5)
    vec = lambda n=20: floats(rng.gauss(0, 1) for _ in range(n))
    rows = [(i, vec(), rng.choice([None, 0, 1, 2])) for i in range(150)]
    hot = vec()
    rows += [(1000 + i, hot, 7) for i in range(80)] + [(3, vec(), 1), (3, vec(), 1), (None, vec(), None)]
    rows += [(2000, None, 1), (2001, [*vec(19), None], 1), (2002, [*vec(19), float("nan")], 1),
             (2003, [*vec(19), float("-inf")], None), (2004, vec(8), 1), (2005, [], 1)]
    assert op12(spark, tmp, rows) == sorted(map(str, plain_codes(rows)))


@pytest.mark.parametrize("rows", [
    [(i, floats([i, -i, i * 3e37, 0.5, 1e30, -1e30, 2, i]), 1) for i in range(30)],  # beyond 64 bits
    [(i, floats([i / 7, 1]), None) for i in range(5)],  # fewer rows than entries, shorter than the parts
    [(i, [], 1) for i in range(20)], [(i, floats([0.25] * 8), i % 2) for i in range(40)]])
def test_vector_codes_odd_vectors(spark, tmp, rows):
    assert op12(spark, tmp, rows) == sorted(map(str, plain_codes(rows)))


def test_vector_codes_empty(spark, tmp):
    assert op12(spark, tmp, []) == [] == op12(spark, tmp, [(1, None, None)])


def test_members_stay_with_salted_owners(spark):
    rng = random.Random(6)
    rows = [(i, floats(rng.gauss(c := rng.choice([-3, 0, 0, 0, 3]), 1) + c for _ in range(16)), 0) for i in range(400)]
    coded, _ = lloyd.compress(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), owner_rows=16)
    want = {r[0]: r[1:3] for r in plain_codes(rows)}
    assert {r.vec_id: (r.code, r.error) for r in coded.collect()} == want


def test_only_moves_are_exchanged(spark):
    rng = random.Random(7)
    rows = [(i, floats(rng.gauss(0, 1) for _ in range(8)), 0) for i in range(300)]
    vecs = lloyd.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), 4096.0)
    import numpy as np
    start = np.array([r["v"] for r in vecs.orderBy("vec_id").limit(16).collect()], np.int64)
    job = lloyd.ResidentLloyd(vecs, [start[:, p: p + 1] for p in range(8)], list(range(9)), 32)
    moved = []
    for at in range(2, 5):
        job.round(at)
        moved.append(job.moves.only(f"r{at}").filter("arrived").count())
    assert job.base.read().count() == 2400 and 0 < moved[-1] < moved[0] < 2400
    plan = job.codes()._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "Exchange" not in plan


# ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, k=10):
    split = lambda t: [w.translate(brute.LOWER) for w in TERM.findall(t or "")]
    counts = [(d, Counter(split(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in counts:
            m = 25 + (75 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in split(text) if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scores)[:k])]
    return out


def items_of(rows):
    rng = random.Random(8)
    texts = [r[1] for r in rows if r[1]]
    items = [(i, " ".join(rng.choice(texts).split()[: rng.randrange(1, 40)])) for i in range(40)]
    return items + [(50, None), (51, ""), (52, "unheard-of qqqq zzzzzz"), (53, "é 日本 W1 w1 w1 x_Y"), (53, "é 日本 W1 w1 w1 x_Y"), (None, "one TWO")]


def test_ranked_search(spark, tmp, edge_docs, edge_rows):
    items = items_of(edge_rows)
    write(edge_docs, tmp, "documents")
    write(spark.createDataFrame([(*i, 1, "g") for i in items], "item_id long, text string, rid int, g string"), tmp, "benchmark")
    got = strata.op11_ranked_search(spark, tmp).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, plain_search([(r[0], r[1]) for r in edge_rows], items)))


def test_ranked_search_in_many_small_blocks(spark, edge_docs, edge_rows):
    """Strata cut into blocks, blocks into groups, items into batches: nothing changes."""
    items = items_of(edge_rows)
    index = strata.StratifiedIndex(edge_docs, block_docs=5, block_postings=3000, group_terms=2000)
    got = strata.search(index, spark.createDataFrame(items, "item_id long, text string"), k=3, probe_docs=10,
                        block_items=7, block_terms=300, batch=2)
    want = plain_search([(r[0], r[1]) for r in edge_rows], items, 3)
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(map(str, want))


def test_bounds_leave_blocks_unopened():
    rng = random.Random(9)
    words = lambda n: [f"w{rng.randrange(50)}".encode() for _ in range(n)]

    def block(m, first, n):
        counts = [Counter(words(30) + [b"rare"] * (m == 40)) for _ in range(n)]
        import numpy as np
        rows = [(first + i, first + i, b" ".join(c), np.array(list(c.values()), "<u4").tobytes()) for i, c in enumerate(counts)]
        return strata.block_row(m, rows)
    blocks = [block(m, 100 * m, 20) for m in range(30, 60)]
    s = strata.Search([{"rid": 1, "term": "rare", "coef": 9000}, {"rid": 1, "term": "w1", "coef": 10}], 10)
    opened, visit = [], s.visit
    s.visit = lambda b, *a: (opened.append(b["m"]), visit(b, *a))
    s.run(blocks)
    assert opened == [40] and len(s.best[0]) == 10


def test_ranked_search_empty(spark, no_docs):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert strata.search(strata.StratifiedIndex(no_docs), items).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert strata.search(strata.StratifiedIndex(docs), items.limit(0)).count() == 0
