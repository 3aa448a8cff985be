"""Archives, sharding, mixing, top-k, packing, toxicity and the pipeline."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

from . import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from .conftest import SF

from doclake.llm import mixing, packing, shards, topk, toxicity, warc
from doclake.llm.common import components, open_folder, shared_folder


def write(df, tmp, table):
    df.write.parquet(f"{tmp}/{table}.parquet")
    return tmp


# archives

PAGES = "page_id long, url string, html string, rid long, digest string, first string"


def pages(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", f"<p>{rng.choice(['é', 'b', 'same'])} {i % 7}</p>" * rng.randrange(1, 40)) for i in range(300)]
    rows += [(1000 + i, "http://hot", "<b>hot page</b>" * 50) for i in range(200)]
    rows += [(5, "http://h/5", "again"), (5, "http://h/5", "again"), (4, None, None), (3, "u\r\nx: y", ""),
             (None, "n", "again"), (None, "n", "only null ids"), (None, None, "only null ids"), (7, "long", "x" * 3_000_000)]
    return rows, spark.createDataFrame([(*r, 1, "d", "f") for r in rows], PAGES).repartition(4)


def test_warc_round_trip(spark, tmp):
    rows, df = pages(spark)
    got = sorted(map(tuple, warc.op2_warc(spark, write(df, tmp, "pages")).collect()), key=str)
    least = {}
    for i, _, h in rows:
        if i is not None:
            least[h or ""] = min(least.get(h or "", i), i)
    want, seen = [], set()
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        p = (h or "").encode()
        f = least.get(h or "")
        first = f is None or (i == f and (h or "") not in seen)
        if i == f:
            seen.add(h or "")
        want.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                     "response" if first else "revisit", None if first else f))
    assert got == sorted(want, key=str)


def test_warc_small_payloads_stay_responses_and_archives_roll(spark):
    _, df = pages(spark)
    marked = warc.mark_revisits(df, min_revisit_bytes=100)
    folder = shared_folder(spark, "warc-test")
    arch = warc.write_archives(marked, folder, archive_bytes=20_000).collect()
    assert len(arch) > 4 and sum(a.records for a in arch) == df.count()
    got = warc.read_archives(spark.createDataFrame(arch), folder).collect()
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 100)
    fs, base = open_folder(folder)
    with fs.open_input_stream(f"{base}/{max(arch, key=lambda a: a.records).archive}", compression=None) as f:
        head = f.read(8)
    assert int.from_bytes(head[:4], "little") == warc.DICT_FRAME_MAGIC  # the dictionary leads


def test_warc_empty_table(spark, tmp):
    assert warc.op2_warc(spark, write(spark.createDataFrame([], PAGES), tmp, "pages")).count() == 0


def test_warc_damage_is_noticed():
    rec = warc.record_bytes(3, "u", b"payload", None)
    assert warc.parse_record(rec)[:2] == (3, 7)
    with pytest.raises(ValueError):
        warc.parse_record(rec.replace(b"payload", b"paylord"))


# sharding

def test_sharding(spark, tmp, edge_docs, edge_rows):
    got = shards.op5_sharding(spark, write(edge_docs, tmp, "documents")).collect()
    size = lambda t: len((t or "").encode()) + 16
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(r[0]), size(r[1]), zlib.crc32((r[1] or "").encode())) for r in edge_rows)
    per = Counter()
    slots = {}
    for r in got:
        per[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 40
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, longest = sum(per.values()), max(r.size for r in got)
    assert all(abs(sum(per[s] for s in range(k + 1)) - total * (k + 1) / 40) <= longest for k in range(40))


def test_sharding_balance_without_long_rows(spark):
    rows = [(i, f"text {i % 50} " * (1 + i % 7)) for i in range(20_000)]  # few texts, many copies
    keys = shards.keyed_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    got = shards.shard_rows(keys, n_shards=8).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 0.004 * sum(sizes) / 8 + 200


def test_sharding_few_and_no_rows(spark, no_docs, tmp):
    assert shards.shard_rows(shards.keyed_rows(no_docs)).count() == 0
    three = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string")
    got = shards.shard_rows(shards.keyed_rows(three)).collect()
    assert len(got) == 3 and all(0 <= r.shard < 40 for r in got) and len({(r.shard, r.slot) for r in got}) == 3


def test_write_shards_in_slot_order(spark, tmp):
    docs = spark.createDataFrame([(i, f"t{i}" * (i % 9), "x") for i in range(200)], "doc_id long, text string, shard_ string")
    shards.write_shards(docs, f"{tmp}/out", n_shards=5)
    back = spark.read.parquet(f"{tmp}/out")
    assert back.count() == 200 and back.select("shard").distinct().count() == 5


def hot_rows():
    return [(i, "hot text") for i in range(1500)] + [(i % 40, f"t{i % 90}") for i in range(900)] + [(None, "hot text")] * 3


def test_sharding_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(hot_rows(), "doc_id long, text string")
    plans = [sorted(map(str, shards.shard_rows(shards.keyed_rows(df.repartition(n)), n_shards=7).select("doc_id", "size", "text_crc32", "shard", "slot").collect()))
             for n in (3, 7)]
    assert plans[0] == plans[1]


def test_write_shards_writes_the_plan(spark, tmp):
    """A hot text is cut over shards on disk as in the plan; clashing names stay."""
    df = spark.createDataFrame([(*r, f"s{i}", i) for i, r in enumerate(hot_rows())], "doc_id long, text string, shard string, slot int")
    shards.write_shards(df, f"{tmp}/out", n_shards=6)
    back = spark.read.parquet(f"{tmp}/out")
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    plan = shards.shard_rows(shards.keyed_rows(df), n_shards=6)
    count = lambda d, c: sorted(tuple(r) for r in d.groupBy(c).count().collect())
    assert count(back, "__shard") == count(plan, "shard") and len(count(back, "__shard")) == 6
    assert back.select("__shard", "__slot").distinct().count() == len(hot_rows())


# mixing

def test_mixing_meets_targets(spark, tmp, edge_docs, edge_rows):
    got = mixing.op7_mixing(spark, write(edge_docs, tmp, "documents"))
    first = got.collect()
    again = mixing.op7_mixing(spark, tmp).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    assert sorted((str(r.doc_id), r.size) for r in first) == sorted(
        (str(r[0]), len(brute.WORD.findall(r[1] or ""))) for r in edge_rows)
    names = sorted({r[3] for r in edge_rows}, key=lambda s: (s is None, s or ""))
    words = Counter()
    source = {}
    for r in edge_rows:
        words[r[3]] += len(brute.WORD.findall(r[1] or ""))
        source[r[0]] = r[3]
    want = dict(zip(names, mixing.targets([words[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))],
                                          sum(words.values()), 3), strict=True))
    assert abs(sum(want.values()) - sum(words.values())) < 1e-6
    taken = Counter()
    for r in first:
        assert r.taken <= 3 * r.size
        if r.doc_id is None:
            continue
        s = source[r.doc_id]
        assert r.source_size == words[s] and abs(r.target - want[s]) < 1e-6
        taken[s] += r.taken
    for s in names:
        if s is not None and words[s] > 100:
            assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 50, (s, taken[s], want[s])


def test_mixing_targets_by_hand():
    assert mixing.targets([10, 10, 1000], [5, 2, 1], 1020, 3) == [30.0, 30.0, 960.0]
    assert mixing.targets([100, 100], [1, 1], 200, 3) == [100.0, 100.0]
    assert mixing.targets([0, 5], [5, 2], 5, 3) == [0.0, 5.0]
    assert mixing.targets([], [], 0, 3) == []


def test_mixing_schedule_is_even_in_every_prefix(spark):
    plan = [{"slots": 700.0, "blocks": 400}, {"slots": 200.0, "blocks": 500}, {"slots": 100.0, "blocks": 50}]
    rows = sorted(mixing.schedule(spark, plan, 3, chunk=128).collect())
    seen = Counter()
    for i, r in enumerate(rows, 1):
        assert r.rank == seen[r.src] and r.block == r.rank % plan[r.src]["blocks"]
        seen[r.src] += 1
        assert all(abs(seen[s] - p["slots"] * i / 1000) < 5 for s, p in enumerate(plan))
    assert len(rows) == 1000


def test_mixing_empty_and_whole_documents(spark, no_docs, edge_docs):
    assert mixing.mix(no_docs.select("doc_id", "text", "source"))[0].count() == 0
    assert mixing.repeat_documents(no_docs).count() == 0
    out = mixing.repeat_documents(edge_docs)
    assert out.columns == edge_docs.columns
    per = out.groupBy("doc_id").count().collect()
    assert max(r["count"] for r in per if r.doc_id is not None and r.doc_id != 10_050) <= 3


# top-k

VECTORS = "vec_id long, embedding array<float>, rid long, dim string, v string"


def test_topk_equals_brute_force(spark, tmp):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 16)]) for i in range(400)]
    rows += [(400 + i, rows[20][1]) for i in range(60)]  # a common vector: ties
    rows += [(40, rows[7][1]), (40, rows[7][1]), (None, rows[3][1]), (600, None), (620, [1.0, None]),
             (640, [float("nan")] * 16), (660, [float("inf")] * 16), (680, []), (700, [0.5, 1.5]), (701, [2.0, -1.0])]
    df = spark.createDataFrame([(*r, 1, "d", "v") for r in rows], VECTORS).repartition(3)
    got = sorted(map(tuple, topk.op8_topk(spark, write(df, tmp, "embeddings")).collect()), key=str)
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{tmp}/embeddings.parquet/*.parquet'")
    assert got == sorted(con.sql(topk.ORACLE_SQL).fetchall(), key=str)


def test_topk_many_shards_prune_and_agree(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 3, (12, 8))
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(0, 0.2, 8)]) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = sorted(map(tuple, topk.top_k(df, k=5, every=50).collect()))
    cut = sorted(map(tuple, topk.top_k(df, k=5, every=50, shard_rows=200, leaf=16, block=7, probe=1).collect()))
    assert whole == cut and len(whole) == 30 * 5


def test_topk_plan_prunes_shards_and_spreads_blocks(spark):
    """Shards far from a block are left out before any tree is sent, and no
    join key holds all blocks."""
    rng = np.random.default_rng(6)
    far = np.eye(8) * 40
    vecs = topk.integer_vectors(spark.createDataFrame([(i, [float(x) for x in far[i // 200] + rng.normal(0, 0.1, 8)]) for i in range(1600)],
                                                      "vec_id long, embedding array<float>"), 64.0)
    trees = topk.build_index(vecs.withColumn("rid", F.floor(F.col("vec_id") / 200)), 1 << 20, 64)  # one tree of all: no pruning
    assert trees.count() == 1
    trees = topk.build_index(vecs, 40, 16)
    blocks = topk.query_blocks(vecs.filter("vec_id % 20 = 0"), 4)
    best = topk.live_pairs(trees, blocks, 3)
    assert best.groupBy("dim", "b").count().filter("count <> 3").isEmpty() and best.count() == 3 * blocks.count()
    none = blocks.withColumn("taus", F.transform("qs", lambda x: F.struct(x["rid"], F.lit(1 << 60).alias("tau"))))
    assert topk.live_pairs(trees, none, None).isEmpty()
    every = blocks.withColumn("taus", F.transform("qs", lambda x: F.struct(x["rid"], F.lit(-(1 << 60)).alias("tau"))))
    assert topk.live_pairs(trees, every, None).count() == trees.count() * blocks.count()
    plan = topk.visits(best, trees, blocks, lambda a, b: b[["b"]], "b int")._jdf.queryExecution().executedPlan().toString()
    keys = set(re.findall(r"hashpartitioning\(([^)]*)\)", plan))
    assert keys and all(k.count("#") >= 2 for k in keys), keys


def test_topk_empty_and_few(spark):
    assert topk.top_k(spark.createDataFrame([], VECTORS)).count() == 0
    one = spark.createDataFrame([(20, [1.0]), (21, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(one).collect()] == [(20, 1, 21, 64 * 128)]


# packing

def test_packing_round_trip(spark, edge_docs, edge_rows):
    folder = shared_folder(spark, "pack-test")
    rows = packing.pack(edge_docs, folder, row_len=256, group_tokens=20_000).collect()
    tok = packing.Tokenizer(packing.VOCABULARY)
    fs, base = open_folder(folder)
    got, files = [], {}
    for r in rows:
        if r.matrix not in files:
            with fs.open_input_stream(f"{base}/{r.matrix}", compression=None) as f:
                files[r.matrix] = np.frombuffer(f.read(), "<u2").reshape(-1, 256)
        ids = files[r.matrix][r.row]
        assert r.ids_crc32 == zlib.crc32(ids.tobytes()) and (ids[r.n_tokens:] == packing.PAD).all()
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1]
        for d, start, s, e in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            got.append((d, start, ids[s:e].tolist()))
    assert sum(len(m) for m in files.values()) == len(rows)
    want = []
    for d, t, *_ in edge_rows:
        ids = tok.enc.encode_ordinary(t or "")
        want += [(d, s, ids[s:s + 256]) for s in range(0, len(ids), 256)]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_packing_empty(spark, no_docs):
    assert packing.pack(no_docs, shared_folder(spark, "pack-none")).count() == 0


def test_tokenizer_pieces_equal_whole_texts(real):
    tok = packing.Tokenizer(packing.VOCABULARY, cache=500)
    odd = ["", " ", "  a", "a  b", "a\n b", "a \nb", "a\tb c", "don't stop", " lead", "trail ", "a b c", "a  b", "x\n\ny z",
           "日本 語", "1 2 33", "é è", "a  b", "\n", "a b\n", "we'll 's ok", "<|endoftext|> a"]
    for t in odd + [r[1] for r in real[:60]]:
        assert tok.encode(t).tolist() == tok.enc.encode_ordinary(t), repr(t[:40])


def test_best_fit_decreasing_equals_a_plain_search():
    rng = random.Random(7)
    for _ in range(30):
        n = [rng.randrange(1, 65) for _ in range(rng.randrange(0, 120))]
        rooms = []
        for length in sorted(n, reverse=True):
            fit = [i for i, r in enumerate(rooms) if r >= length]
            if fit:
                rooms[min(fit, key=lambda i: rooms[i])] -= length
            else:
                rooms.append(64 - length)
        rows = packing.best_fit_decreasing(n, 64)
        assert sorted(i for r in rows for i in r) == list(range(len(n)))
        assert sorted(64 - sum(n[i] for i in r) for r in rows) == sorted(rooms)


# toxicity

def test_toxicity_accuracy_on_the_held_out_fold(spark):
    root = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in toxicity.op10_toxicity(spark, root).collect()}
    labels = spark.read.parquet(f"{root}/labels.parquet").collect()
    held = [(got[r.doc_id], r.toxic) for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(g.held_out for g, _ in held) and all(0 <= g.score <= 1 for g in got.values())
    assert sum(t == g.predicted for g, t in held) / len(held) > 0.95
    assert sum(t == 0 and g.predicted for g, t in held) / len(held) < 0.02


def test_machine_learns_pairs_that_weights_miss():
    rng = random.Random(1)
    rows, y = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5  # insult, group mention: toxic only together
        words = [f"n{rng.randrange(200)}" for _ in range(12)] + ["idiot"] * a + ["group"] * b
        rows.append(toxicity.terms(" ".join(words), 14, {}))
        y.append(float(a and b))
    m = toxicity.fit(rows[:2000], np.array(y[:2000]), 14)
    ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows[2000:]])])
    raw, _, _ = toxicity._score(m["w0"], m["w"], m["v"], np.concatenate(rows[2000:]), ptr)
    assert np.mean((raw > 0) == (np.array(y[2000:]) > 0.5)) > 0.97


def test_machine_learns_labels_of_pairs_alone():
    """Toxic if both terms or none occur: no single term tells the labels apart."""
    rng = random.Random(4)
    rows, y = [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(toxicity.terms(" ".join([f"n{rng.randrange(300)}" for _ in range(20)] + ["insult"] * a + ["group"] * b), 14, {}))
        y.append(float(a == b))
    m = toxicity.fit(rows[:2500], np.array(y[:2500]), 14)
    ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows[2500:]])])
    raw, _, _ = toxicity._score(m["w0"], m["w"], m["v"], np.concatenate(rows[2500:]), ptr)
    assert np.mean((raw > 0) == (np.array(y[2500:]) > 0.5)) > 0.95


def test_toxicity_sample_is_bounded_after_the_join(spark):
    docs = spark.createDataFrame([(7, f"text {i % 900}") for i in range(3000)] + [(i, f"other {i}") for i in range(100, 300)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1)] + [(i, i % 2) for i in range(100, 300)], "doc_id long, toxic int")
    sample = toxicity.training_sample(docs, labels, 100)
    assert sample.select("doc_id", "th", "toxic").distinct().count() <= 100
    assert toxicity.train(docs, labels, 100) is not None


def test_toxicity_scores_equal_a_plain_scorer(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    v = model["v"].astype(float)
    for r in toxicity.score_texts(docs, model).limit(60).collect():
        cols = set()
        for w in re.findall(rb"[0-9a-z\x80-\xff]+", (r.text or "").encode().lower()):
            cols |= {zlib.crc32(x) % (1 << 18) for x in [b"w" + w, *[b"p" + w[:n] for n in (4, 6, 7) if len(w) > n]]}
        cols = sorted(cols)
        pairs = sum(float(v[i] @ v[j]) for k, i in enumerate(cols) for j in cols[:k] if v[i].any() and v[j].any()) if len(cols) < 400 else None
        if pairs is not None:
            raw = model["w0"] + sum(float(model["w"][i]) for i in cols) + pairs
            assert abs(1 / (1 + math.exp(-raw)) - r["__score"]) < 1e-4


def test_toxicity_odd_rows(spark, tmp, edge_docs, no_docs):
    write(edge_docs, tmp, "documents")
    lab = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    more = spark.createDataFrame([(None, 1), (10_002, None), (10_001, 0), (99_999, 1)], "doc_id long, toxic int")
    write(lab.unionByName(more), tmp, "labels")
    got = toxicity.op10_toxicity(spark, tmp).collect()
    assert len(got) == edge_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    model = toxicity.train(edge_docs, lab.limit(0))
    assert model is None and {r[0] for r in toxicity.score_texts(edge_docs, None).select("__score").collect()} == {0.0}
    assert toxicity.score_texts(no_docs, None).count() == 0


# shared parts and the pipeline

def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(None, 3), (7, None), (8, 8)] + [(500, 501 + i) for i in range(80)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = brute.components(600, [(a, b) for a, b in edges if a is not None and b is not None])
    least = {}
    for i, r in enumerate(root):
        least.setdefault(r, i)
    assert all(got.get(i, i) == least[r] for i, r in enumerate(root))


def test_pipeline_stages(spark, tmp, edge_docs, edge_rows):
    import corpus_pipeline
    root = f"{tmp}/in"
    docs = edge_docs.withColumn("n_words", edge_docs["n_words"])
    write(docs, root, "documents")
    items = [(1, edge_rows[3][1][:300]), (2, None)]
    write(spark.createDataFrame(items, "item_id long, text string"), root, "benchmark")
    write(spark.read.parquet(f"{SF}/labels.parquet"), root, "labels")
    kept, data = {}, spark.read.parquet(f"{root}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = data
        data = stage(spark, before, root)
        if name != "token_packing":
            assert data.columns == before.columns
        data.write.parquet(f"{tmp}/{name}")
        data = spark.read.parquet(f"{tmp}/{name}")
        kept[name] = data.collect()
    ids = lambda n: sorted(str(r.doc_id) for r in kept[n])
    model = toxicity.train(edge_docs, spark.read.parquet(f"{root}/labels.parquet"))
    score = toxicity.score_texts(edge_docs.select("doc_id", "text"), model).collect()
    assert ids("toxicity") == sorted(str(r.doc_id) for r in score if r["__score"] < 0.5)
    comp = brute.jaccard_components([(r.doc_id, r.text) for r in kept["toxicity"]])
    assert ids("ngram_jaccard_join") == sorted([*{str(c) for _, n, c in comp if n}, *(str(d) for d, n, _ in comp if not n)])
    dirty = brute.contamination([(r.doc_id, r.text) for r in kept["ngram_jaccard_join"]], items)
    assert ids("benchmark_decontamination") == sorted(str(d) for d, _, hit, *_ in dirty if not hit)
    assert 0 < len(ids("benchmark_decontamination")) < len(ids("ngram_jaccard_join"))
    copies = Counter(ids("source_mixing"))
    assert set(copies) <= set(ids("benchmark_decontamination")) and max(copies.values()) <= 3
    texts = {str(r.doc_id): r.text for r in kept["source_mixing"]}
    tok = packing.Tokenizer(packing.VOCABULARY)
    n = sum(len(tok.encode(texts[d] or "")) * k for d, k in copies.items())
    assert sum(r.n_tokens for r in kept["token_packing"]) == n


def test_no_shortcuts_in_sources():
    """Queries take whole tables: no sampling, no local checkpoints."""
    import doclake.llm as llm
    folder = llm.__path__[0]
    import os
    for name in os.listdir(folder):
        if name.endswith(".py"):
            code = open(f"{folder}/{name}").read()
            assert not re.search(r"localCheckpoint|\.sample\(|crossJoin|toPandas", code), name
