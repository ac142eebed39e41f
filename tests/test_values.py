"""Exact kernels against golden vectors and fractions."""

import random
from decimal import Context, Decimal
from fractions import Fraction

import exact as X
import numpy as np
import pyarrow as pa
import pytest

from tallyline.functions import kernels as K
from tallyline.functions import wide
from tallyline.functions import words as W

Q96 = 2**96


def numbers(x, base=wide.BINARY):
    return [sum(int(d) * base**i for i, d in enumerate(row)) for row in x.T]


def column(values, base=wide.BINARY):
    size = max(1, *(len(wide.constant(v, base)) for v in values))
    return np.concatenate([wide.padded(wide.constant(v, base), size) for v in values], axis=1)


def word_column(values):
    return pa.array([None if v is None else v.to_bytes(32, "big", signed=True) for v in values], pa.binary())


def integers(array):
    return [None if v is None else int.from_bytes(v, "big", signed=True) for v in array.to_pylist()]


def wide_numbers(seed, rows):
    """Numbers of all sizes, and those at which estimates of quotients go wrong."""
    rng = random.Random(seed)
    for _ in range(rows):
        bits = rng.choice((1, 5, 31, 32, 33, 64, 96, 128, 160, 255, 300))
        yield rng.choice((rng.getrandbits(bits), 2**bits - 1, 2**bits, (2**32 - 1) << bits, 10**30 - 1))


@pytest.mark.parametrize(
    ("tick", "ratio"),
    [
        (-887272, 4295128739),
        (-60, 78990846045029531151608375686),
        (-1, 79224201403219477170569942574),
        (0, Q96),
        (1, 79232123823359799118286999568),
        (60, 79466191966197645195421774833),
        (887272, 1461446703485210103287273052203988822378723970342),
    ],
)
def test_tick_ratio(tick, ratio):
    assert X.tick_ratio(tick) == ratio == numbers(K.tick_ratios(np.array([tick])))[0]


@pytest.mark.parametrize(
    ("tick", "delta", "amount0", "amount1"),
    [
        (0, 10**18, 2995354955910781, 2995354955910781),
        (0, -(10**18), -2995354955910780, -2995354955910780),
        (-100, 10**18, 5999709018652707, 0),
        (-60, 10**18, 5999709018652707, 0),
        (60, 10**18, 0, 5999709018652707),
        (100, -(10**18), 0, -5999709018652706),
    ],
)
def test_position_amounts(spark, tick, delta, amount0, amount1):
    from tallyline.functions import words as W
    from tallyline.operators.valuation import (
        position_amounts,
        tick_dimension,
        with_bound_ratios,
    )

    price = X.tick_ratio(tick)
    row = (
        delta.to_bytes(32, "big", signed=True), tick, price.to_bytes(32, "big"), -60, 60,
    )
    df = spark.createDataFrame(
        [row], "delta binary, tick_before bigint, price_before binary, lower bigint, upper bigint"
    )
    out = position_amounts(with_bound_ratios(df, tick_dimension(df))).selectExpr(
        f"{W.word_text('raw0')} AS a0", f"{W.word_text('raw1')} AS a1"
    )
    assert tuple(out.first()) == (str(amount0), str(amount1))


def test_tick_out_of_range_fails(spark):
    from tallyline.operators.valuation import tick_dimension

    df = spark.createDataFrame([(-887273, 0)], "lower bigint, upper bigint")
    with pytest.raises(Exception, match="tick out of range"):
        tick_dimension(df).collect()


def test_price_fixture():
    assert X.prices(Q96, 18, 6) == ("0.000000000001", "1000000000000")
    assert X.prices(0, 18, 6) == ("0", "0")


@pytest.mark.parametrize(
    ("tick", "ratio", "inverse"),
    # Ratios of the ticks with a single bit, and of their negatives.
    [
        (1, 79232123823359799118286999568, 79224201403219477170569942574),
        (2, 79236085330515764027303304732, 79220240490215316061937756561),
        (4, 79244008939048815603706035062, 79212319258289487113226433917),
        (8, 79259858533276714757314932306, 79196479170490597288862688491),
        (16, 79291567232598584799939703905, 79164808496886665658930780292),
        (32, 79355022692464371645785046467, 79101505139923049997807806615),
        (64, 79482085999252804386437311142, 78975050245229982702767995060),
        (128, 79736823300114093921829183327, 78722746600537056721934508530),
        (256, 80248749790819932309965073893, 78220554859095770638340573244),
        (512, 81282483887344747381513967012, 77225761753129597550065289037),
        (1024, 83390072131320151908154831282, 75273969370139069689486932538),
        (2048, 87770609709833776024991924139, 71517125791179246722882903168),
        (4096, 97234110755111693312479820774, 64556580881331167221767657720),
        (8192, 119332217159966728226237229891, 52601903197458624361810746400),
        (16384, 179736315981702064433883588728, 34923947901690145425342545399),
        (32768, 407748233172238350107850275305, 15394552875315951095595078918),
        (65536, 2098478828474011932436660412518, 2991262837734375505310244437),
        (131072, 55581415166113811149459800483534, 112935262922445818024280874),
        (262144, 38992368544603139932233054999993536, 160982827401375763736069),
        (524288, 19190206568837448476620805525116361302670, 327099227039063107),
    ],
)
def test_single_bit_ticks(tick, ratio, inverse):
    assert X.tick_ratio(tick) == ratio and X.tick_ratio(-tick) == inverse
    assert numbers(K.tick_ratios(np.array([tick, -tick]))) == [ratio, inverse]
    # Within one unit of sqrt(1.0001)^tick in Q96, by Fraction-free long arithmetic.
    exact = Decimal("1.0001") ** tick
    assert abs(Decimal(ratio) ** 2 / Decimal(Q96) ** 2 / exact - 1) < Decimal("1e-9")


def rounded(amount, decimals):
    """amount / 10^decimals to 34 digits, by Python's decimals."""
    value = X.to_digits(Decimal(amount))
    shifted = value.scaleb(-decimals, Context(prec=100, Emin=-(10**6), Emax=10**6))
    text = format(shifted, "f")
    return (text.rstrip("0").rstrip(".") if "." in text else text) if amount else "0"


@pytest.mark.parametrize(
    ("amount", "decimals", "text"),
    [
        (123_456, 3, "123.456"), (-5, 0, "-5"), (0, 18, "0"), (10**40, 2, "1" + "0" * 38),
        (-1, 18, "-0.000000000000000001"), (1500, 2, "15"), (2**255 - 1, 0, None), (-(2**255), 77, None),
        (int("1" * 34 + "5"), 1, None), (-int("1" * 34 + "9"), 1, None), (10**35 - 1, 35, None), (7, 254, None),
    ],
)
def test_scaled_text(spark, amount, decimals, text):
    df = spark.createDataFrame(
        [(amount.to_bytes(32, "big", signed=True), decimals)], "w binary, d bigint"
    ).selectExpr(f"{W.scaled_text('w', 'd')} AS t")
    want = rounded(amount, decimals)
    assert df.first().t == want and text in (None, want)
    flipped = df.selectExpr(f"{W.flipped_text('t')} AS t").first().t
    assert flipped == ("0" if want == "0" else want[1:] if amount < 0 else "-" + want)


def test_missing_metadata_fails(spark):
    from tallyline.operators.metadata import decode_metadata, token_rows

    inits = spark.createDataFrame([(1, bytes(20), b"\1" * 20)], "block bigint, currency0 binary, currency1 binary")
    calls = [(1, b"\1" * 20, f, True, b"") for f in ("symbol", "name", "totalSupply", "decimals")]
    kind = "block bigint, token binary, field string, failed boolean, raw binary"
    metadata = decode_metadata(spark.createDataFrame(calls, kind))
    assert [r.symbol for r in token_rows(inits, metadata, complete=True).orderBy("side").collect()] == ["ETH", "unknown"]
    for some in (calls[:3], calls[:0]):
        part = decode_metadata(spark.createDataFrame(some, kind))
        assert token_rows(inits, part).count() == 2
        with pytest.raises(Exception, match="metadata responses missing"):
            token_rows(inits, part, complete=True).collect()


@pytest.mark.parametrize("sqrt_price", [1, 4295128739, 3 * Q96 // 7, 10**40])
def test_price_is_right_to_33_digits(sqrt_price):
    exact = Fraction(sqrt_price**2, 2**192) * Fraction(10**6, 10**18)
    got = Fraction(Decimal(X.prices(sqrt_price, 6, 18)[1]))
    assert abs(got / exact - 1) < Fraction(1, 10**32)


def test_rounding_to_34_digits():
    assert str(X.to_digits(Decimal("1" * 34 + "5"))) == "1." + "1" * 32 + "2E+34"
    assert len(X.to_digits(Decimal("-" + "9" * 40)).as_tuple().digits) == 34


@pytest.mark.parametrize("base", [wide.BINARY, wide.BILLION])
def test_wide_products_and_quotients(base):
    a, d = list(wide_numbers(1, 3000)), [n + 1 for n in wide_numbers(2, 3000)]
    x, y = column(a, base), column(d, base)
    assert numbers(wide.multiply(x, y, base), base) == [p * q for p, q in zip(a, d, strict=True)]
    digits, left = wide.divide(x, y, base)
    assert numbers(digits, base) == [p // q for p, q in zip(a, d, strict=True)]
    assert left.tolist() == [p % q > 0 for p, q in zip(a, d, strict=True)]
    assert numbers(wide.to_billions(column(a)), wide.BILLION) == a
    low, high = K.ordered(*(column([*a, *d])[:, i::2] for i in (0, 1)))
    assert all(p <= q for p, q in zip(numbers(low), numbers(high), strict=True))


def test_rounding_of_columns():
    """Ties and carries at the 34th digit, short numbers and zero."""
    values = [0, 1, 10**34 - 1, int("9" * 34 + "5"), int("9" * 34 + "49"), int("1" * 34 + "5"), int("1" * 33 + "25" + "0" * 40), *wide_numbers(3, 2000)]
    mantissa, power = wide.rounded(column(values, wide.BILLION))
    made = [Decimal(m).scaleb(int(p), X.EXACT) for m, p in zip(numbers(mantissa, wide.BILLION), power, strict=True)]
    assert made == [X.to_digits(Decimal(v)) for v in values]


def test_amount_kernels_match_python_integers():
    rng = random.Random(4)
    ratios = [X.tick_ratio(t) for t in (-887272, -60, -1, 0, 1, 60, 887272)] + [Q96, 4295128739]
    rows = [
        (rng.choice((-1, 1)) * rng.getrandbits(rng.choice((1, 20, 64, 90))), rng.choice(ratios), rng.choice(ratios))
        for _ in range(5000)
    ] + [(None, Q96, Q96), (1, None, Q96), (0, Q96, 2 * Q96), (-1, Q96, 3 * Q96)]
    delta, one, other = (word_column(c) for c in zip(*rows, strict=True))
    for kernel, scalar in ((K.amounts_in_token0, X.amount_in_token0), (K.amounts_in_token1, X.amount_in_token1)):
        want = [None if None in r else scalar(r[0], *sorted(r[1:])) for r in rows]
        assert integers(K.columnwise(kernel, delta, one, other)) == want
    with pytest.raises(OverflowError):
        K.columnwise(K.amounts_in_token0, word_column([2**250]), word_column([1]), word_column([2**159]))


def test_ticks_match_python_integers():
    rng = random.Random(6)
    ticks = [rng.randint(-K.MAX_TICK, K.MAX_TICK) for _ in range(3000)]
    assert numbers(K.tick_ratios(np.array(ticks))) == [X.tick_ratio(t) for t in ticks]


def test_price_columns_match_python_decimals(spark):
    rng = random.Random(7)
    roots = [0, 1, 4295128739, Q96, 2**160 - 1, 3 * Q96 // 7, 10**40, *(rng.getrandbits(rng.randint(1, 160)) for _ in range(1500))]
    rows = [(r.to_bytes(32, "big"), rng.choice((0, 6, 18, 254)), rng.choice((0, 6, 18, 254))) for r in roots]
    df = spark.createDataFrame([*rows, (None, 1, 1), (rows[3][0], None, 6)], "p binary, d0 bigint, d1 bigint")
    step = df.withColumn("t", K.price_digits("p", "d0", "d1"))
    got = step.selectExpr(*(K.price_text("t", i) + f" AS price{i}" for i in (0, 1))).collect()
    want = [X.prices(r, d0, d1) for r, (_, d0, d1) in zip(roots, rows, strict=True)]
    assert [tuple(g) for g in got] == [*want, (None, None), (None, None)]
