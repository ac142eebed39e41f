"""Exact wide integers and 34-digit decimals as numpy columns.

A column of numbers is an array of digits, least significant first, with one
column per row: ``x[i, r]`` is digit ``i`` of row ``r``, unsigned 64 bits that
hold a digit of base 2^32 or 10^9.  Products of two digits and two carries fit,
so products and long division run as a few hundred operations on whole arrays,
whatever the number of rows; nothing here loops over rows.
"""

from __future__ import annotations

import numpy as np

BINARY = 1 << 32
BILLION = 10**9
SIGNIFICANT = 34
MANTISSA = 4  # digits of base 10^9 that hold 36 decimal ones
TENS = 10 ** np.arange(10, dtype=np.uint64)


SHIFT, LOW = np.uint64(32), np.uint64(BINARY - 1)


def split(total: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Carry and digit; the array itself becomes the digit."""
    if base == BINARY:
        carry = total >> SHIFT
        total &= LOW
    else:
        carry = total // base
        total -= carry * base
    return carry, total


def constant(value: int, base: int, rows: int = 1) -> np.ndarray:
    """``value`` in every row."""
    digits = []
    while value or not digits:
        value, digit = divmod(value, base)
        digits.append(digit)
    return np.repeat(np.array(digits, np.uint64)[:, None], rows, axis=1)


def trimmed(x: np.ndarray) -> np.ndarray:
    """Without leading digits that are zero in all rows."""
    used = np.flatnonzero(x.any(axis=1))
    return x[: used[-1] + 1 if len(used) else 1]


def padded(x: np.ndarray, size: int) -> np.ndarray:
    return np.concatenate([x, np.zeros((max(size - len(x), 0), x.shape[1]), np.uint64)])


def lengths(x: np.ndarray) -> np.ndarray:
    """Digits of each row without leading zeros."""
    return len(x) - np.argmax((x != 0)[::-1], axis=0) - np.where(x.any(axis=0), 0, len(x))


def multiply(a: np.ndarray, b: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros((len(a) + len(b), a.shape[1]), np.uint64)
    for i, x in enumerate(a):
        carry = np.zeros(a.shape[1], np.uint64)
        for j, y in enumerate(b):
            total = x * y
            total += out[i + j]
            total += carry
            carry, out[i + j] = split(total, base)
        out[i + len(b)] = carry
    return out


def add_small(x: np.ndarray, amount: np.ndarray, base: int) -> np.ndarray:
    """``x`` plus a number below ``base``; one digit longer."""
    out = padded(x, len(x) + 1)
    carry = amount.astype(np.uint64)
    for i in range(len(out)):
        carry, out[i] = split(out[i] + carry, base)
    return out


def subtract(a: np.ndarray, b: np.ndarray, base: int) -> np.ndarray:
    """``a - b`` for ``a >= b``, of the same size."""
    out = np.empty_like(a)
    borrow = np.zeros(a.shape[1], np.uint64)
    for i in range(len(a)):
        enough, out[i] = split(a[i] + base - b[i] - borrow, base)
        borrow = 1 - enough
    return out


def smaller(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a < b`` per row, of the same size."""
    less, same = np.zeros(a.shape[1], bool), np.ones(a.shape[1], bool)
    for x, y in zip(a[::-1], b[::-1], strict=True):
        less |= same & (x < y)
        same &= x == y
    return less


def divide(a: np.ndarray, d: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Quotient, and whether something is left over, for ``d > 0``.

    Rows are taken together by the size of their divisor.
    """
    quotient = np.zeros_like(a)
    left = np.zeros(a.shape[1], bool)
    sizes = lengths(d)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        # All rows at once need no copies.
        pick = slice(None) if len(rows) == len(sizes) else rows
        top = trimmed(a[:, pick])
        q, rest = _long_division(top, d[:size, pick], base)
        quotient[: len(q), pick] = q
        left[pick] = rest
    return quotient, left


def _long_division(a: np.ndarray, d: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Digit by digit: estimate from the leading digits, subtract, correct.

    The leading digit of every divisor is not zero.
    """
    size = len(d)
    if size == 1:
        return _short_division(a, d[0], base)
    # Scaled so that the divisor's leading digit is at least half the base.
    factor = (base // (d[-1] + 1))[None]
    v = multiply(d, factor, base)[:size]
    u = multiply(a, factor, base)
    if len(u) <= size:
        u = padded(u, size + 1)
    steps = len(u) - size
    quotient = np.zeros((steps, a.shape[1]), np.uint64)
    first, second = v[-1], v[-2]
    for j in range(steps - 1, -1, -1):
        # The remainder is below the divisor, so its leading digit is at most ``first``.
        high = u[j + size]
        two = high * base
        two += u[j + size - 1]
        estimate = two // first
        np.minimum(estimate, base - 1, out=estimate)
        rest = two - estimate * first
        for _ in range(2):
            wrong = (rest < base) & (estimate * second > rest * base + u[j + size - 2])
            if not wrong.any():
                break
            estimate -= wrong
            rest += first * wrong
        carry = np.zeros(a.shape[1], np.uint64)
        borrow = np.zeros(a.shape[1], np.uint64)
        for i in range(size):
            product = estimate * v[i]
            product += carry
            carry, product = split(product, base)
            product += borrow
            total = u[j + i] + base
            total -= product
            enough, u[j + i] = split(total, base)
            borrow = 1 - enough
        below = high < carry + borrow
        u[j + size] = 0
        if below.any():
            again = np.flatnonzero(below)
            estimate[again] -= 1
            carry = np.zeros(len(again), np.uint64)
            for i in range(size):
                carry, u[j + i, again] = split(u[j + i, again] + v[i, again] + carry, base)
        quotient[j] = estimate
    return quotient, u[:size].any(axis=0)


def _short_division(a: np.ndarray, d: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    quotient = np.zeros_like(a)
    rest = np.zeros(a.shape[1], np.uint64)
    for i in range(len(a) - 1, -1, -1):
        total = rest * base + a[i]
        quotient[i] = total // d
        rest = total - quotient[i] * d
    return quotient, rest != 0


def to_billions(x: np.ndarray) -> np.ndarray:
    """Digits of base 2^32 to digits of base 10^9."""
    rest = trimmed(x).copy()
    out = []
    while len(rest) > 1 or rest.any():
        carry = np.zeros(x.shape[1], np.uint64)
        for i in range(len(rest) - 1, -1, -1):
            total = carry << np.uint64(32) | rest[i]
            rest[i] = total // BILLION
            carry = total - rest[i] * BILLION
        out.append(carry)
        short = trimmed(rest)
        if len(short) == 1 and not short.any():
            break
        rest = short
    return np.stack(out) if out else np.zeros((1, x.shape[1]), np.uint64)


def rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive decimals rounded half up to 34 digits: mantissas and powers of ten.

    A mantissa has 36 decimal digits of which the last two are zero; zero stays
    zero.  ``x`` must be exact to its 35th digit.
    """
    top = lengths(x) - 1
    five = np.concatenate([np.zeros((MANTISSA, x.shape[1]), np.uint64), x])
    place = top + MANTISSA + np.arange(-MANTISSA, 1)[:, None]
    w = np.take_along_axis(five, np.maximum(place, 0), axis=0)
    used = np.searchsorted(TENS, w[-1], side="right").clip(1)
    low, high = TENS[used], TENS[9 - used]
    head, tail = w[:-1] // low, w[:-1] % low
    m = np.empty((MANTISSA, x.shape[1]), np.uint64)
    m[-1] = w[-1] * high + head[-1]
    m[:-1] = tail[1:] * high + head[:-1]
    up = m[0] // 10 % 10 >= 5
    carry = up * np.uint64(100)
    m[0] = m[0] // 100 * 100
    for i in range(MANTISSA):
        m[i] += carry
        over = m[i] >= BILLION
        m[i] -= over * np.uint64(BILLION)
        carry = over.astype(np.uint64)
    m[-1] += carry * np.uint64(BILLION // 10)
    power = 9 * top + used - 9 * MANTISSA + carry.astype(np.int64)
    return m, np.where(x.any(axis=0), power, 0)


def ratio(a: tuple[np.ndarray, np.ndarray], d: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Quotient of two rounded decimals, rounded; a zero divisor gives zero."""
    mantissa, power = d
    none = ~mantissa.any(axis=0)
    safe = np.where(none, constant(BILLION ** (MANTISSA - 1), BILLION), mantissa)
    shifted = np.concatenate([np.zeros((MANTISSA, a[0].shape[1]), np.uint64), a[0]])
    digits, _ = divide(shifted, safe, BILLION)
    made, more = rounded(np.where(none, 0, digits).astype(np.uint64))
    return made, np.where(made.any(axis=0), more + a[1] - power - 9 * MANTISSA, 0)
