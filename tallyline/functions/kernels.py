"""Exact arithmetic kernels, run over Arrow columns inside tasks.

Only what needs integers beyond 256 bits or 34-digit decimals is here; all of
it works on whole columns (:mod:`tallyline.functions.wide`).
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from decimal import ROUND_HALF_UP, Context, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions import wide as X

# Workers get these functions by value and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(X)

# The tick bound, the fixed-point scale and the size of a word.
MAX_TICK = 887_272
Q96 = 1 << 96
LIMBS = 8
ROWS = 4096  # at a time, so that a column of digits stays in the processor's cache


def _tick_factors() -> list[int]:
    """2^128 / sqrt(1.0001)^(2^i), rounded to nearest, for each tick bit."""
    exact = Context(prec=120)
    root = exact.sqrt(Decimal("1.0001"))
    factors = []
    for bit in range(MAX_TICK.bit_length()):
        value = exact.divide(Decimal(2**128), exact.power(root, 2**bit))
        factors.append(int(value.to_integral_value(ROUND_HALF_UP, exact)))
    return factors


TICK_FACTORS = _tick_factors()


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Magnitudes and signs of 32-byte words without NULLs."""
    size = 4 * LIMBS
    fixed = column.cast(pa.binary(size))
    data = np.frombuffer(fixed.buffers()[1], np.uint8) if len(fixed) else np.zeros(0, np.uint8)
    x = data[fixed.offset * size :][: len(fixed) * size].reshape(-1, size).view(">u4")[:, ::-1].T.astype(np.uint64)
    negative = x[-1] >= 1 << 31
    return signed(x, negative), negative


def signed(x: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """Two's complement of the rows marked negative."""
    if not negative.any():
        return x
    flipped = X.add_small(np.where(negative, X.BINARY - 1 - x, x), negative, X.BINARY)
    return flipped[:LIMBS]


def word_array(x: np.ndarray, negative: np.ndarray) -> pa.Array:
    """Words of magnitudes and signs; a number beyond 256 bits is an error."""
    x = X.padded(x, LIMBS)
    edge = negative & (x[LIMBS - 1] == 1 << 31) & ~x[: LIMBS - 1].any(axis=0)
    if x[LIMBS:].any() or ((x[LIMBS - 1] >= 1 << 31) & ~edge).any():
        raise OverflowError("integer beyond 256 bits")
    low = signed(x[:LIMBS], negative & x.any(axis=0)).astype(">u4")
    flat = np.ascontiguousarray(low[::-1].T).tobytes()
    made = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * LIMBS), x.shape[1], [None, pa.py_buffer(flat)])
    return made.cast(pa.binary())


def columnwise(fn: Callable[..., pa.Array], *columns: pa.Array) -> pa.Array:
    """``fn`` over the rows without NULLs, ``ROWS`` at a time; other rows give NULL."""
    valid = np.ones(len(columns[0]), bool)
    for column in columns:
        valid &= column.is_valid().to_numpy(zero_copy_only=False)
    mask = pa.array(valid)
    full = [c.filter(mask) for c in columns]
    parts = [fn(*(c.slice(i, ROWS) for c in full)) for i in range(0, max(len(full[0]), 1), ROWS)]
    made = pa.concat_arrays(parts)
    if valid.all():
        return made
    return made.take(pa.array(np.cumsum(valid) - 1, mask=~valid))


def quotient(a: np.ndarray, d: np.ndarray, up: np.ndarray) -> np.ndarray:
    """Magnitude of a / d, rounded away from zero where ``up``, else toward it."""
    q, left = X.divide(a, d, X.BINARY)
    return X.add_small(q, left & up, X.BINARY)


def tick_ratios(tick: np.ndarray) -> np.ndarray:
    """sqrt(1.0001^tick) as Q96 integers, rounded up."""
    size = np.abs(tick)
    ratio = X.constant(1 << 128, X.BINARY, len(tick))
    for bit, factor in enumerate(TICK_FACTORS):
        rows = np.flatnonzero(size >> bit & 1)
        if len(rows):
            whole = X.multiply(ratio[:, rows], X.constant(factor, X.BINARY, len(rows)), X.BINARY)
            ratio[:, rows] = X.padded(whole, 9)[4:9]
    above = np.flatnonzero(tick > 0)
    ratio = X.padded(ratio, LIMBS)
    if len(above):
        top = X.constant(2**256 - 1, X.BINARY, len(above))
        ratio[:, above] = X.divide(top, ratio[:, above], X.BINARY)[0]
    return X.add_small(ratio[1:], ratio[0] != 0, X.BINARY)[:LIMBS]


def ordered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    swap = X.smaller(b, a)
    return np.where(swap, b, a), np.where(swap, a, b)


def amounts_in_token0(delta: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
    """Liquidity times the distance of two ratios over their product."""
    liquidity, negative = words(delta)
    low, high = ordered(words(one)[0], words(other)[0])
    distance = X.trimmed(X.subtract(high, low, X.BINARY))
    scaled = X.multiply(X.trimmed(liquidity), distance, X.BINARY)
    shifted = np.concatenate([np.zeros((3, scaled.shape[1]), np.uint64), scaled])
    first = quotient(shifted, X.trimmed(high), ~negative)
    return word_array(X.trimmed(quotient(X.trimmed(first), X.trimmed(low), ~negative)), negative)


def amounts_in_token1(delta: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
    """Liquidity times the distance of two ratios."""
    liquidity, negative = words(delta)
    low, high = ordered(words(one)[0], words(other)[0])
    scaled = X.multiply(X.trimmed(liquidity), X.trimmed(X.subtract(high, low, X.BINARY)), X.BINARY)
    scaled = X.padded(scaled, 4)
    left = scaled[:3].any(axis=0)
    return word_array(X.trimmed(X.add_small(scaled[3:], left & ~negative, X.BINARY)), negative)


Q192 = X.rounded(X.constant(Q96 * Q96, X.BILLION))
ONE = (X.constant(10**35, X.BILLION), np.array([-35]))
PRICE = pa.struct(
    [(f"{part}{i}", pa.int64() if part != "power" else pa.int32()) for i in (0, 1) for part in ("high", "low", "power")]
)


def price_parts(price: pa.Array, decimals0: pa.Array, decimals1: pa.Array) -> pa.Array:
    """Both tokens' prices as 36-digit mantissas in two halves, and powers of ten."""
    root = X.trimmed(words(price)[0])
    rows = root.shape[1]
    square = X.rounded(X.to_billions(X.multiply(root, root, X.BINARY)))
    same = lambda fixed: (np.repeat(fixed[0], rows, axis=1), np.repeat(fixed[1], rows))
    digits, power = X.ratio(square, same(Q192))
    shift = decimals0.to_numpy(zero_copy_only=False) - decimals1.to_numpy(zero_copy_only=False)
    one = digits, np.where(digits.any(axis=0), power + shift, 0)
    columns = []
    for mantissa, exponent in (X.ratio(same(ONE), one), one):
        halves = mantissa[1::2] * X.BILLION + mantissa[::2]
        columns += [pa.array(halves[1].astype(np.int64)), pa.array(halves[0].astype(np.int64)), pa.array(exponent.astype(np.int32))]
    return pa.StructArray.from_arrays(columns, fields=list(PRICE))


@F.arrow_udf(T.BinaryType())
def tick_ratio_word(tick: pa.Array) -> pa.Array:
    def ratio(part: pa.Array) -> pa.Array:
        made = tick_ratios(pc.cast(part, pa.int64()).to_numpy(zero_copy_only=False))
        return word_array(made, np.zeros(len(part), bool))

    return columnwise(ratio, tick)


@F.arrow_udf(T.BinaryType())
def token0_word(delta: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    return columnwise(amounts_in_token0, delta, low, high)


@F.arrow_udf(T.BinaryType())
def token1_word(delta: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    return columnwise(amounts_in_token1, delta, low, high)


_PARTS = T.StructType()
for _i in (0, 1):
    _PARTS = _PARTS.add(f"high{_i}", "long").add(f"low{_i}", "long").add(f"power{_i}", "integer")


@F.arrow_udf(_PARTS)
def price_digits(price: pa.Array, decimals0: pa.Array, decimals1: pa.Array) -> pa.Array:
    return columnwise(price_parts, price, decimals0, decimals1)


def price_text(parts: str, i: int) -> str:
    """SQL fragment: plain text of a price without trailing zeros."""
    digits = f"concat(CAST({parts}.high{i} AS STRING), lpad(CAST({parts}.low{i} AS STRING), 18, '0'))"
    # The digits after the point, once trailing zeros are dropped.
    e = f"(length(_d) - 36 - {parts}.power{i})"
    return (
        f"CASE WHEN {parts} IS NULL THEN NULL WHEN {parts}.high{i} = 0 THEN '0' ELSE "
        f"transform(array(rtrim('0', {digits})), _d -> "
        f"CASE WHEN {e} <= 0 THEN concat(_d, repeat('0', -{e})) "
        f"WHEN length(_d) > {e} THEN concat(left(_d, length(_d) - {e}), '.', right(_d, {e})) "
        f"ELSE concat('0.', repeat('0', {e} - length(_d)), _d) END)[0] END"
    )
