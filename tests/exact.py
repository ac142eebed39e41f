"""Scalar arithmetic with Python's integers and decimals, to check the columnar kernels against."""

from decimal import ROUND_DOWN, ROUND_HALF_UP, Context, Decimal
from functools import reduce

from tallyline.functions.kernels import TICK_FACTORS

Q96 = 2**96
EXACT = Context(prec=200, rounding=ROUND_DOWN, Emax=10**6, Emin=-(10**6))
UP = Context(prec=34, rounding=ROUND_HALF_UP, Emax=10**6, Emin=-(10**6))
CUT = Context(prec=34, rounding=ROUND_DOWN, Emax=10**6, Emin=-(10**6))


def tick_ratio(tick):
    used = [f for bit, f in enumerate(TICK_FACTORS) if abs(tick) >> bit & 1]
    ratio = reduce(lambda acc, f: acc * f >> 128, used, 1 << 128)
    if tick > 0:
        ratio = (2**256 - 1) // ratio
    return -(-ratio >> 32)


def quotient(a, b, up):
    if up:
        return -(-a // b)
    return a // b if a >= 0 else -(-a // b)


def amount_in_token0(liquidity, low, high):
    up = liquidity > 0
    return quotient(quotient(liquidity * Q96 * (high - low), high, up), low, up)


def amount_in_token1(liquidity, low, high):
    return quotient(liquidity * (high - low), Q96, liquidity > 0)


def to_digits(value):
    """34 significant digits: half up above zero, toward zero below."""
    return (CUT if value < 0 else UP).plus(value)


def plain(value):
    return format(value.normalize(UP), "f") if value else "0"


def prices(sqrt_price, decimals0, decimals1):
    ratio = to_digits(EXACT.divide(to_digits(Decimal(sqrt_price**2)), to_digits(Decimal(Q96**2))))
    ratio = to_digits(EXACT.divide(to_digits(EXACT.multiply(ratio, Decimal(10) ** decimals0)), Decimal(10) ** decimals1))
    inverse = to_digits(EXACT.divide(Decimal(1), ratio)) if ratio else Decimal(0)
    return plain(inverse), plain(ratio)
