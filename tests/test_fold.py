"""Folds against a plain loop, at every segment width and with a hot key."""

import random

import pytest

from tallyline.functions.segments import Segments
from tallyline.operators.audit import islands
from tallyline.operators.fold import SEGMENT, Put, Tally, Wide, fold, fold_set_sum
from tallyline.operators.lookup import asof_lookup

SCHEMA = "block bigint, ordinal bigint, k string, s bigint, a bigint, w binary"


def word(v):
    return None if v is None else (v % 2**256).to_bytes(32, "big")


def make_rows(seed):
    rng = random.Random(seed)
    rows = []
    for block in range(60):
        for slot in range(rng.randint(0, 4)):
            key = "hot" if rng.random() < 0.5 else rng.choice("abc")
            put = rng.randint(-9, 9) if rng.random() < 0.2 else None
            add = rng.randint(-(2**40), 2**40) if rng.random() < 0.6 else None
            rows.append((block, 2 * slot + 1, key, put, add))
    return rows


def expected(rows):
    """{(block, ordinal): (set before/after, add before/after, set_sum before/after)}"""
    state, out = {}, {}
    for block, ordinal, key, put, add in sorted(rows):
        s, a, m = state.get(key, (None, None, None))
        s2 = put if put is not None else s
        a2 = a if add is None else (a or 0) + add
        m2 = put if put is not None else (m if add is None else (m or 0) + add)
        state[key] = (s2, a2, m2)
        out[block, ordinal] = (s, s2, a, a2, m, m2)
    return out


def ledger(spark, rows, width):
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    df = spark.createDataFrame([(*r, word(r[4])) for r in shuffled], SCHEMA)
    return df.withColumn(SEGMENT, Segments.even(0, width).of())


@pytest.mark.parametrize(("seed", "width"), [(1, 1), (2, 7), (3, 25), (4, 1000)])
def test_folds_match_a_loop(spark, seed, width):
    rows = make_rows(seed)
    done = fold(
        ledger(spark, rows, width), ["k"],
        [Put("set", "s"), Tally("add", "a"), Tally("wide", "w", Wide)],
    )
    done = fold_set_sum(done, ["k"], "sum", "s", "a")
    want = expected(rows)
    got = done.collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.block, r.ordinal]
        assert (
            r.set_before, r.set_after, r.add_before, r.add_after, r.sum_before, r.sum_after
        ) == w
        assert (r.wide_before, r.wide_after) == (word(w[2]), word(w[3]))


def test_wide_set_sum(spark):
    rows = make_rows(9)
    df = ledger(spark, rows, 7).selectExpr(
        "*", "IF(s IS NULL, NULL, unhex(lpad(hex(s), 64, IF(s < 0, 'F', '0')))) AS sw"
    )
    got = fold_set_sum(df, ["k"], "sum", "sw", "w", Wide).collect()
    want = expected(rows)
    for r in got:
        _, _, _, _, before, after = want[r.block, r.ordinal]
        assert (r.sum_before, r.sum_after) == (word(before), word(after))


@pytest.mark.parametrize("inclusive", [True, False])
def test_asof(spark, inclusive):
    writes = spark.createDataFrame(
        [(1, 1, "x", 10), (1, 3, "x", 20), (9, 1, "x", 30), (2, 1, "y", 5)],
        "block bigint, ordinal bigint, k string, v bigint",
    ).withColumn(SEGMENT, Segments.even(0, 4).of())
    probes = spark.createDataFrame(
        [(0, 1, "x"), (1, 3, "x"), (8, 1, "x"), (9, 1, "x"), (1, 1, "y"), (3, 1, "z")],
        "block bigint, ordinal bigint, k string",
    ).withColumn(SEGMENT, Segments.even(0, 4).of())
    done = asof_lookup(writes, probes, ["k"], "v", "found", inclusive).collect()
    got = {(r.block, r.ordinal, r.k): r.found for r in done}
    assert got == {
        (0, 1, "x"): None,
        (1, 3, "x"): 20 if inclusive else 10,
        (8, 1, "x"): 20,
        (9, 1, "x"): 30 if inclusive else 20,
        (1, 1, "y"): None,
        (3, 1, "z"): None,
    }


def test_islands_cross_segments(spark):
    blocks = [1, 2, 3, 4, 5, 9, 10, 20, 33, 34, 35, 36, 37, 38]
    df = spark.createDataFrame([(b,) for b in blocks], "block bigint").withColumn(
        SEGMENT, Segments.even(0, 3).of()
    )
    got = sorted((r.first_block, r.last_block, r.blocks) for r in islands(df).collect())
    assert got == [(1, 5, 5), (9, 10, 2), (20, 20, 1), (33, 38, 6)]


def test_hot_key_uses_every_segment(spark):
    """No window of a fold is partitioned by the key alone over ledger rows."""
    rows = [(b, 1, "hot", b, 1) for b in range(64)]
    done = fold(ledger(spark, rows, 8), ["k"], [Tally("add", "a")])
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and SEGMENT in plan
    assert {r.block: r.add_after for r in done.collect()} == {b: b + 1 for b in range(64)}
