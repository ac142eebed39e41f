"""Wide integers against Python integers."""

import random

import pytest
from pyspark.sql import functions as F

from tallyline.functions import words as W


def word(v):
    return (v % 2**256).to_bytes(32, "big")


def shortest(v):
    n = 1
    while not -(2 ** (8 * n - 1)) <= v < 2 ** (8 * n - 1):
        n += 1
    return v.to_bytes(n, "big", signed=True)


@pytest.fixture(scope="module")
def values():
    rng = random.Random(7)
    edges = [
        0, 1, -1, 127, 128, -128, -129, 2**23 - 1, -(2**23), 2**63 - 1, -(2**63), 2**63,
        2**120, 2**127 - 1, -(2**127), 2**255 - 1, -(2**255),
    ]
    return edges + [rng.randint(-(2**b), 2**b) for b in range(1, 255, 3)]


def test_arithmetic_and_text(spark, values):
    rows = [(str(a), word(a), word(b)) for a, b in zip(values, reversed(values))]
    df = spark.createDataFrame(rows, "a string, aw binary, bw binary").selectExpr(
        "a",
        f"{W.word_text('aw')} AS text",
        f"{W.text_to_word('a')} AS parsed",
        f"{W.word_add('aw', 'bw')} AS total",
        f"{W.word_add('aw', W.word_negate('bw'))} AS difference",
        f"{W.word_negate('aw')} AS negated",
        f"{W.minimal_signed_bytes('aw')} AS short",
        f"{W.signed_bytes_to_word(W.minimal_signed_bytes('aw'))} AS back",
        f"{W.word_to_bigint('aw')} AS number",
        f"{W.signed_word('aw', 24)} AS int24",
        f"{W.unsigned_word_text('aw')} AS unsigned",
    )
    for row, b in zip(df.collect(), reversed(values)):
        a = int(row.a)
        assert row.text == str(a)
        assert bytes(row.parsed) == word(a)
        assert bytes(row.total) == word(a + b)
        assert bytes(row.difference) == word(a - b)
        assert bytes(row.negated) == word(-a)
        assert bytes(row.short) == shortest(a)
        assert bytes(row.back) == word(a)
        assert row.number == (a if -(2**63) <= a < 2**63 else None)
        assert row.int24 == (a if -(2**23) <= a < 2**23 else None)
        assert row.unsigned == str(a % 2**256)


@pytest.mark.parametrize(
    ("value", "expected"),
    [(127, "7f"), (128, "0080"), (-1, "ff"), (-128, "80"), (-129, "ff7f"), (0, "00"), (None, "")],
)
def test_shortest_bytes(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v bigint").selectExpr(
        f"lower(hex({W.minimal_signed_bytes(W.bigint_to_word('v'))})) AS h"
    )
    assert df.first().h == expected


def test_lenient_parse(spark):
    bad = ["", "x", "1.5", "--1", "1 ", "0x10", None]
    good = {"+5": 5, "-0": 0, "007": 7, str(-(2**255)): -(2**255)}
    df = spark.createDataFrame([(t,) for t in [*bad, *good]], "t string")
    rows = df.select("t", F.expr(W.text_to_word("t")).alias("w")).collect()
    parsed = {r.t: None if r.w is None else bytes(r.w) for r in rows}
    assert all(parsed[t] is None for t in bad)
    assert all(parsed[t] == word(v) for t, v in good.items())


@pytest.mark.parametrize("text", ["9" * 82, str(10**78), str(2**255), str(-(2**255) - 1)])
def test_integers_beyond_a_word_fail(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(F.expr(W.text_to_word("t")))
    with pytest.raises(Exception, match="beyond 256 bits"):
        df.collect()
