"""Cases in which an operator did less than its whole job."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from . import brute

from doclake.llm import jaccard, passages
from doclake.llm.shingles import WordHashes, shingle_sequences


def words(rng, n, size=100_000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def test_keep_one_removes_linked_rows_only(spark):
    rng = random.Random(11)
    text = lambda: " ".join(words(rng, 40))
    near = words(rng, 60)
    copy = " ".join([*near[:-1], "other"])
    near = " ".join(near)
    twins = words(rng, 60)
    alone, shared = [text() for _ in range(4)], [text() for _ in range(2)]
    repeated = text()
    rows = [(None, t) for t in alone] + [(7, t) for t in shared]  # unlike texts: all stay
    rows += [(3, near), (3, copy)]  # near copies with one id: one stays
    rows += [(None, " ".join(twins)), (None, " ".join([*twins[:-1], "x"]))]  # without ids, too
    rows += [(None, ""), (None, None), (8, ""), (8, "")]
    for more in ([], [(5, repeated), (5, repeated)]):  # one outcome, whatever the other rows
        kept = [tuple(r) for r in jaccard.keep_one(spark.createDataFrame(rows + more, "doc_id long, text string")).collect()]
        want = [(None, t) for t in alone] + [(7, t) for t in shared] + [(None, ""), (None, None), (8, ""), (8, "")] + more[:1]
        left = list(kept)
        for r in want:
            left.remove(r)
        assert sorted((str(i), len(t.split())) for i, t in left) == [("3", 60), ("None", 60)]


def test_near_passages_meet_under_any_order(spark):
    """60 planted passages of 60 words, two neighbouring words of
    each changed: shingle similarity 50 / 62."""
    rng = random.Random(12)
    rows = []
    for i in range(60):
        body = words(rng, 60)
        copy = list(body)
        at = rng.randrange(8, 48)
        copy[at], copy[at + 1] = "new", "word"
        x, y = brute.shingles(" ".join(body)), brute.shingles(" ".join(copy))
        assert len(x & y) / len(x | y) >= 0.8
        rows += [(2 * i, " ".join(words(rng, 30) + body + words(rng, 30))), (2 * i + 1, " ".join(words(rng, 50) + copy + words(rng, 20)))]
    got = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = sum(got[2 * i + 1].class_id == 2 * i and got[2 * i].n_repeated >= 50 for i in range(60))
    assert found >= 59, found


def test_passages_with_inserted_and_deleted_words(spark):
    rng = random.Random(13)
    rows = []
    for i in range(20):
        body = words(rng, 62)
        copy = list(body)
        if i % 2:
            copy.insert(31, "more")
        else:
            del copy[31]
        rows += [(2 * i, " ".join(words(rng, 30) + body + words(rng, 30))), (2 * i + 1, " ".join(words(rng, 50) + copy + words(rng, 20)))]
    got = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(20):
        assert got[2 * i + 1].class_id == 2 * i
        assert (got[2 * i].passages, got[2 * i + 1].passages) == ("30:92", f"50:{113 if i % 2 else 111}")


def test_passages_that_a_group_s_pivot_does_not_hold(spark):
    """Texts joined by one common passage: what some of them share besides it
    next to it is too short to meet by itself and is found all the same."""
    rng = random.Random(14)
    common, rows = words(rng, 70), [(0, None)]
    rows[0] = (0, " ".join(words(rng, 5) + common))  # the shortest text: the pivot
    for i in range(12):
        tail = words(rng, 8)
        rows += [(1 + 2 * i + j, " ".join(words(rng, 40 + i + j) + common + tail + words(rng, 25))) for j in range(2)]
    got = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {r.class_id for r in got.values()} == {0} and got[0].passages == "5:75"
    for i in range(12):
        for j in range(2):
            assert got[1 + 2 * i + j].passages == f"{40 + i + j}:{118 + i + j}"


def test_further_windows_of_the_pivot_text_meet(spark):
    """The pivot text holds the passage twice, first in a piece; its other
    window meets, too, and so does a pair whose first meeting was too short."""
    rng = random.Random(15)
    body = words(rng, 60)
    rows = [(0, " ".join([*body[20:40], *words(rng, 3), *body])),
            (1, " ".join(words(rng, 80) + body + words(rng, 80)))]
    got = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].class_id == got[1].class_id == 0
    assert got[0].passages == "23:83" and got[1].passages == "80:140"


def test_unlinked_texts_around_one_passage_are_not_listed_by_pairs(spark, monkeypatch):
    """3,000 texts of one common passage and endings of their own, near the
    threshold but below it, with some linked pairs among them: every link is
    found and the compared pairs grow with the texts, not with their square."""
    rng = random.Random(16)
    common = words(rng, 64)
    rows = [(i, " ".join([*common, *words(rng, 12)])) for i in range(3000)]
    a, b = brute.shingles(rows[0][1]), brute.shingles(rows[1][1])
    assert 0.68 < len(a & b) / len(a | b) < 0.8
    for i in range(0, 400, 10):  # the ending's last word changed: linked with its model only
        rows.append((5000 + i, " ".join([*rows[i][1].split()[:-1], "other"])))
    compared = 0
    store = jaccard.write_table

    def counted(df, name, *more):
        nonlocal compared
        out = store(df, name, *more)
        if name in ("jx-pairs", "jx-near", "jx-possible", "jx-ranked"):
            compared += out.count()
        return out
    monkeypatch.setattr(jaccard, "write_table", counted)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - 5000 if i >= 5000 else i for i, _ in rows}
    assert compared < 20 * len(rows), compared


def test_a_shared_passage_does_not_pair_texts_of_unlike_sizes(spark, monkeypatch):
    """A dozen texts of one passage, each a third longer than the one before:
    nothing can link, so none meets a pivot. Beginnings of one text, each of
    four fifths of the next, all link in a chain. The sketch is level, as on
    large inputs, so the passage lies in all windows."""
    rng = random.Random(23)
    common = words(rng, 60)
    rows = [(i, " ".join([*common, *words(rng, int(20 * 1.9 ** i))])) for i in range(12)]
    long, size = words(rng, 800), 64
    for i in range(11):
        rows.append((100 + i, " ".join(long[: size + 4])))  # size shingles
        size = size * 5 // 4
    met = []
    store, measure = jaccard.write_table, jaccard.measure

    def level(docs, width):
        sizes, sketch = measure(docs, width)
        return sizes, sketch * 0
    monkeypatch.setattr(jaccard, "measure", level)

    def counted(df, name, *more):
        out = store(df, name, *more)
        if name == "jx-pairs":
            met.extend(out.collect())
        return out
    monkeypatch.setattr(jaccard, "write_table", counted)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in
                 jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted(brute.jaccard_components(rows))
    assert {c for _, _, c in got} == {*range(12), 100}
    assert not met, len(met)


def test_groups_of_sizes_that_a_large_pivot_holds(spark):
    """Pieces of one long text: the pivot holds small members nearly whole
    without being linked to them, and they are linked with each other."""
    rng = random.Random(17)
    long = words(rng, 140)
    rows = [(0, " ".join(long))]
    for i in range(60):
        n = rng.randrange(88, 135)
        at = rng.randrange(0, 140 - n)
        piece = list(long[at: at + n])
        if i % 3:
            piece[rng.randrange(n)] = f"edit{i}"
        rows.append((i + 1, " ".join(piece)))
    got = sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in
                           jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())))
    assert got == sorted(map(str, brute.jaccard_components(rows)))


def test_periodic_stretches_hide_no_passage(spark):
    """A near copy beside rules of dashes, however long."""
    rng = random.Random(18)
    rows = []
    for i, n in enumerate((0, 500, 1500, 4000)):
        body = words(rng, 95)
        copy = list(body)
        copy[47] = "other"
        rule = ["-"] * n
        rows += [(2 * i, " ".join(words(rng, 30) + rule + body + words(rng, 30) + rule)), (2 * i + 1, " ".join(words(rng, 50) + rule + copy + words(rng, 20)))]
    for a, b in zip(rows[::2], rows[1::2], strict=True):
        x, y = (shingle_sequences([t], WordHashes())[0] for _, t in (a, b))
        at = max(len(r[1].split()) for r in (a, b))
        got = passages.common_passages(x, y, 46, 80)
        text, other = a[1].split(), b[1].split()
        want, want2 = text.index(next(w for w in text[30:] if w != "-")), other.index(next(w for w in other[50:] if w != "-"))
        # one found passage holds the near copy whole on both sides
        assert any(s <= want and e + 4 >= want + 95 and s2 <= want2 and e2 + 4 >= want2 + 95 for s, e, s2, e2 in got), (at, got[:5])


def test_chains_see_all_runs_that_can_be_joined():
    rng = np.random.default_rng(19)
    for _ in range(30):
        s, d = rng.integers(0, 400, 60), rng.integers(-30, 30, 60)
        n = rng.integers(1, 40, 60)
        runs = np.stack([s + 50, s + n + 50, s + d + 50, s + d + n + 50, n], axis=1)
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        got = {(q, r) for a, b, _, _ in passages.next_pairs(runs, 80, 64) for q, r in zip(a.tolist(), b.tolist(), strict=True)}
        want = set()
        for q in range(60):
            for r in range(q + 1, 60):
                x, y = runs[q].tolist(), runs[r].tolist()
                over = max(0, -min(y[0] - x[1], y[2] - x[3]))
                m = x[4] + y[4] - over
                if (x[2] <= y[2] and x[1] <= y[1] and x[3] <= y[3] and over < min(x[4], y[4])
                        and 180 * m >= 80 * (y[1] - x[0] + y[3] - x[2])):
                    want.add((q, r))
        assert got == want


def test_chaining_looks_at_pairs_of_unchanged_runs_once(monkeypatch):
    draw = np.random.default_rng(3)
    a = draw.integers(0, 1 << 40, 1500)
    b = np.delete(a, draw.choice(1500, 60, replace=False))  # some 60 runs, joined in several rounds
    runs, each = passages.equal_runs(a, b), passages.next_pairs
    plain = passages.undominated(runs)
    while True:  # all pairs again in each round
        plain = plain[np.lexsort((plain[:, 2], plain[:, 0]))]
        found = sorted((gap, q, r, m) for part in each(plain, 80) for q, r, m, gap in zip(*(x.tolist() for x in part), strict=True))
        taken, gone, new = set(), set(), []
        for _, q, r, m in found:
            if not {q, r} & taken:
                gone |= {q, r}
                new.append((plain[q, 0], plain[r, 1], plain[q, 2], plain[r, 3], m))
            taken |= {q, r}
        if not new:
            break
        plain = np.array([x for i, x in enumerate(plain.tolist()) if i not in gone] + new)
    asked = []

    def counted(runs, percent, **params):
        asked.append(params.get("fresh"))
        yield from each(runs, percent, **params)
    monkeypatch.setattr(passages, "next_pairs", counted)
    assert sorted(passages.chained(runs, 80).tolist()) == sorted(plain.tolist()) and len(plain) < 10
    assert len(asked) > 2 and asked[0] is None and all(len(f) for f in asked[1:])


def test_a_stored_step_leaves_no_shuffle_files(spark):
    from doclake.llm.common import write_table
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = files.getAllFiles().size()
    got = write_table(spark.range(2000).repartition(5, F.col("id") % 7), "no-shuffles")
    for _ in range(100):  # files go in the background
        if files.getAllFiles().size() <= before:
            break
        time.sleep(0.1)
    assert files.getAllFiles().size() <= before and got.count() == 2000


def test_comparing_passages_exchanges_the_pivots_items_alone(spark, monkeypatch):
    """A pivot is the shortest text of its group: its items travel with each pair, the longer ones' do not."""
    rows, long = 40, [f"w{i}" for i in range(3000)]
    texts = [" ".join(long[:60])] + [" ".join(f"a{k}_{x}" for x in long) + " " + " ".join(long[:60]) for k in range(rows)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = docs.select("doc_id", F.xxhash64("text").alias("th"), F.xxhash64("text").alias("c")).localCheckpoint()
    h = {r["doc_id"]: r["c"] for r in table.collect()}
    pairs = spark.createDataFrame([(h[i], h[0]) for i in range(1, rows + 1)], "c long, p long")
    from doclake.llm.classes import representatives
    plans = []
    write = passages.write_table
    monkeypatch.setattr(passages, "write_table", lambda df, *a: (plans.append(df), write(df, *a))[1])
    found = passages.verify(pairs, docs, representatives(table), 5, 46, 80)
    assert found.count() == rows
    text = plans[-1]._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.splitlines() if "Join Inner" in line]
    assert len(joins) == 2 and joins[0].split("(")[1].startswith("c#") and joins[1].split("(")[1].startswith("p#")
