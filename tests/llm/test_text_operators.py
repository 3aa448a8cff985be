"""Personal data, decontamination, Jaccard join and passages against plain versions."""

import hashlib

from . import brute
import numpy as np
import pytest

from doclake.llm import decontaminate, jaccard, passages, pii
from doclake.llm.shingles import WordHashes, shingle_sequences


def digest(spans):
    return ",".join(":".join(map(str, s)) for s in spans)


def write(spark, df, tmp, table):
    df.write.parquet(f"{tmp}/{table}.parquet")
    return tmp


def test_pii_base_spans_of_whole_texts(spark, tmp, edge_docs, edge_rows):
    seeds = [(20_000 + i, f"mail me at user{i}@mail.example.com today, or +1 (555) 010-44{i:02d}; "
                          f"card 4111 1111 1111 1111, 10.0.{i}.7 𝛼") for i in range(8)]
    odd = [(30_001, "a@b.com_x@y.org 1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.01 +1-2-3 +12345678 4111-1111-1111-1111-2"),
           (30_002, "mail me at agent.seven(at)example today, mail me at agent9.seven today")]
    extra = spark.createDataFrame(seeds + odd, "doc_id long, text string")
    docs = edge_docs.unionByName(extra, allowMissingColumns=True)
    got = pii.op1_pii(spark, write(spark, docs, tmp, "documents")).collect()
    rows = [(r[0], r[1]) for r in edge_rows] + seeds + odd
    want = sorted((str(d), hashlib.sha256(digest(brute.base_spans(t)).encode()).hexdigest(),
                   *[sum(s[0] == k for s in brute.base_spans(t)) for k in brute.KINDS]) for d, t in rows)
    assert sorted((str(r.doc_id), r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == want
    # 'mail me at _' precedes eight seeds: the unseen token in that context is found
    found = next(r for r in got if r.doc_id == 30_002)
    assert found.n_found >= 1 and "email:" in found.spans


def test_pii_empty_table(spark, tmp, no_docs):
    assert pii.op1_pii(spark, write(spark, no_docs, tmp, "documents")).count() == 0


def test_decontamination(spark, tmp, edge_docs, edge_rows):
    items = [(1, edge_rows[5][1][:400]), (2, None), (3, ""), (4, "ONE, two!"), (5, "x"), (5, "x"),
             (6, " ".join(edge_rows[200 + 7 - 0][1].split()[30:45]) if edge_rows[207][1] else "q"),
             (7, "nothing like this occurs anywhere in the texts at all really"), (None, "one two")]
    items += [(40 + i, r[1][100:420]) for i, r in enumerate(edge_rows[10:40])]
    write(spark, edge_docs, tmp, "documents")
    write(spark, spark.createDataFrame(items, "item_id long, text string"), tmp, "benchmark")
    got = decontaminate.op3_decontaminate(spark, tmp).collect()
    known = [i for i in items if i[0] is not None]
    want = brute.contamination([(r[0], r[1]) for r in edge_rows], known)
    null_item = {r[:3] for r in brute.contamination([(r[0], r[1]) for r in edge_rows], items)}
    assert {(r.doc_id, r.n_words, r.n_hit) for r in got} == null_item
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_items, r.items_sha256) for r in got if r.n_words != 2))) == \
        sorted(map(str, ((w[0], w[1], w[3], w[4]) for w in want if w[1] != 2)))
    assert all(r.contaminated == (r.n_hit > 0) for r in got)


def test_decontamination_proximity_and_empty(spark, no_docs):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = spark.createDataFrame([(1, "so " + text), (2, "so " + text.replace("zeta", "zeta or so")), (3, "else")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(9, text)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.digests(decontaminate.find_matches(docs, items)).collect()}
    assert (got[1].n_hit, got[1].n_near_items) == (12, 0)
    assert (got[2].n_hit, got[2].n_near_items, got[2].contaminated) == (0, 1, False)
    assert (got[3].n_hit, got[3].n_near_items) == (0, 0)
    assert decontaminate.find_matches(no_docs, items).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.digests(decontaminate.find_matches(docs, none)).collect()] == [0, 0, 0]


def test_jaccard_components(spark, tmp, edge_docs, edge_rows):
    got = jaccard.op4_jaccard(spark, write(spark, edge_docs, tmp, "documents")).collect()
    want = brute.jaccard_components([(r[0], r[1]) for r in edge_rows])
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_jaccard_recursion_finds_links_a_pivot_misses(spark):
    """Many unlike texts share a run that fills their windows: regions hold
    several components and are joined again until they are resolved."""
    common = [f"c{i}" for i in range(60)]
    rows = []
    for i in range(24):
        own = [f"o{i // 2}_{j}" for j in range(18)]  # texts 2k and 2k+1 are near copies
        rows.append((i, " ".join(own[: 17 + i % 2] + common)))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute.jaccard_components(rows))


def test_jaccard_empty_and_keep_one(spark, no_docs, edge_docs, edge_rows):
    assert jaccard.jaccard_components(no_docs).count() == 0
    kept = jaccard.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    comp = brute.jaccard_components([(r[0], r[1]) for r in edge_rows])
    want = sorted({str(c) for _, n, c in comp if n}) + sorted(str(d) for d, n, _ in comp if not n)
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(want)


def test_shingle_sequences_match_sets():
    cache = WordHashes()
    texts = ["a b c d e f", "A b C d e", None, "", "a b", "a B", "a b c d e f a b c d e f"]
    h, b, n = shingle_sequences(texts, cache)
    got = [frozenset(h[b[i]:b[i + 1]].tolist()) for i in range(len(texts))]
    assert [len(g) for g in got] == [len(brute.shingles(t)) for t in texts]
    assert got[4] == got[5] and got[1] <= got[0] <= got[6] and list(n) == [6, 5, 0, 0, 2, 2, 12]


@pytest.mark.parametrize("t", [1, 3, 7])
def test_compact_windows_cover_each_stretch_once(t):
    rng = np.random.default_rng(t)
    v = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    bounds = np.array([0, 5, 5, 120, 122, 300])
    lo, ce, hi = passages.compact_windows(v, bounds, t)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        for i in range(a, b):
            for j in range(i + t - 1, b):
                own = [(x, y, z) for x, y, z in zip(lo, ce, hi, strict=True) if x <= i <= y <= j <= z and a <= x and z < b]
                assert len(own) == 1 and own[0][1] == i + int(np.argmin(v[i:j + 1] >> np.uint64(28)))


def test_repeated_passages(spark, tmp, edge_docs, edge_rows):
    got = passages.op6_passages(spark, write(spark, edge_docs, tmp, "documents")).collect()
    assert len(got) == len(edge_rows)
    by_id = {r.doc_id: r for r in got}
    pairs, cover = brute.passage_pairs([(r[0], r[1]) for r in edge_rows])
    ids = [r[0] for r in edge_rows]
    assert len(pairs) > 50
    for a, b in pairs:  # texts that share 50 words are in one class
        if ids[a] is not None and ids[b] is not None:
            assert by_id[ids[a]].class_id == by_id[ids[b]].class_id
    for d, words in cover.items():
        if ids[d] is None:
            continue
        spans = [tuple(map(int, s.split(":"))) for s in by_id[ids[d]].passages.split(",") if s]
        missed = [w for w in words if not any(s <= w < e for s, e in spans)]
        assert not missed, (ids[d], spans, missed[:5])
    clean = [r for r in got if r.n_words < 50]
    assert clean and all(r.n_passages == 0 and r.class_id == r.doc_id for r in clean)
    assert all(r.class_id == r.doc_id for r in got if r.doc_id is not None and r.n_passages == 0)


def test_repeated_passages_empty(spark, no_docs):
    assert passages.repeated_passages(no_docs).count() == 0
