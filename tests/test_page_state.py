"""Page runs from state equal the batch page runs, whatever the landings' order."""

import itertools
import random

import pytest
from conftest import rows

from doclake.operators.responses import page_runs
from doclake.streaming.page_state import BLOCK, CAPTURES, NONE, SLOTS, best_of, runs_from_blocks, stored_blocks, update_page_state


def captures():
    rng = random.Random(3)
    out = []
    for wine in range(1, 25):
        n = rng.choice([3, 20, BLOCK - 1, BLOCK, BLOCK + 5, 3 * BLOCK])
        lost = set(rng.sample(range(1, n + 1), rng.choice([0, 0, 1])))
        out += [(wine, p, "ok") for p in range(1, n + 1) if p not in lost]
        out += [(wine, n + 1, rng.choice(["empty", "failed", "ok"]))]
        out += [(wine, p, "failed") for p in rng.sample(range(1, n + 1), 2)]  # retries
    out += [(90, 5 * BLOCK, "ok"), (91, 0, "ok"), (91, 1, "empty"), (92, 1, "failed"), (92, 1, "empty")]
    rng.shuffle(out)
    return out


def starts(spark):
    return spark.createDataFrame([(w, 1 + (w % 3) * 2) for w in range(1, 25)] + [(90, 1), (91, 1), (92, 1), (93, 2), (24, BLOCK)],
                                 "wine_id long, start_page int")


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_landings_in_any_order_equal_the_batch(spark, tmp, order):
    all_rows = captures()
    parts = [all_rows[i::3] for i in range(3)]
    for i, part in enumerate(order):
        more = parts[part] + parts[order[0]][:40]  # repeated captures
        spark.createDataFrame(more, CAPTURES).write.mode("append").parquet(f"{tmp}/in")
        update_page_state(spark, f"{tmp}/in", f"{tmp}/sink", f"{tmp}/ckpt")
        if i == 1:
            update_page_state(spark, f"{tmp}/in", f"{tmp}/sink", f"{tmp}/ckpt")  # nothing new
    got = runs_from_blocks(stored_blocks(spark, f"{tmp}/sink"), starts(spark))
    want = page_runs(spark.createDataFrame(all_rows, CAPTURES), starts(spark))
    assert rows(got, "wine_id") == rows(want, "wine_id") and got.count() == 28
    plain = page_runs(spark.createDataFrame(all_rows, CAPTURES))
    assert rows(runs_from_blocks(stored_blocks(spark, f"{tmp}/sink")), "wine_id") == rows(plain, "wine_id")


def test_one_state_value_holds_many_blocks():
    """Stored blocks and new captures against a dictionary; only changed blocks are emitted."""
    import numpy as np
    rng, value, want = random.Random(5), None, {}
    for size in (200, 1, 50, 200, 200):
        new = [(rng.choice([-3, 7, 2 ** 40, *range(20)]), rng.randint(-2, 2), rng.choice([0, 3, 511, rng.randrange(BLOCK)]),
                rng.randrange(3)) for _ in range(size)]
        w, b, at, worth = (np.array(c, t) for c, t in zip(zip(*new), (np.int64, np.int32, np.int64, np.uint8)))
        value, changed = best_of(value, w, b, at, worth)
        before = {k: bytes(v) for k, v in want.items()}
        for wine, block, i, x in new:
            pages = want.setdefault((wine, block), bytearray([NONE]) * BLOCK)
            pages[i] = min(pages[i], x)
        assert {(int(x), int(y)): z for x, y, z in changed} == {k: bytes(v) for k, v in want.items() if before.get(k) != bytes(v)}
        again, changed = best_of(value, w, b, at, worth)
        assert again == value and not list(changed)


def test_a_landing_costs_a_call_per_slot_not_per_wine(spark, tmp):
    """Twice as many wines as slots: state rows stay within the slots."""
    wines = 2 * SLOTS
    spark.range(wines).selectExpr("id as wine_id", "1 as page_no", "'ok' as state").write.parquet(f"{tmp}/in")
    update_page_state(spark, f"{tmp}/in", f"{tmp}/sink", f"{tmp}/ckpt", partitions=2)
    assert stored_blocks(spark, f"{tmp}/sink").count() == wines
    state = spark.read.format("statestore").option("stateVarName", "blocks").load(f"{tmp}/ckpt")
    assert state.count() <= SLOTS
