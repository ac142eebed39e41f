"""Exact 256-bit integers as 32-byte big-endian two's complement words.

Every helper takes SQL fragments (usually a column name) and returns a SQL
fragment for ``F.expr``: one parse per expression instead of hundreds of
Column objects.  All of it runs in the JVM.  Sums run on eight unsigned 32-bit
limbs held in BIGINTs, so one partial sum may take 2^31 rows before it is
folded back into a word; arithmetic is modulo 2^256.

A value used more than once is bound with :func:`let`, which keeps the plan and
the generated code small.
"""

from __future__ import annotations

LIMBS = 8
_LOW32 = 4294967295
_CHUNK = 1000000000  # nine decimal digits, the text conversion base
_CHUNKS = 9  # 81 digits hold any 256-bit value
_NONE = "CAST(array() AS ARRAY<BIGINT>)"


def let(value: str, name: str, body: str) -> str:
    """Bind ``value`` once as ``name`` for use in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def hex_to_bigint(h: str) -> str:
    """Up to 15 hex digits as a non-negative BIGINT."""
    return f"CAST(conv({h}, 16, 10) AS BIGINT)"


def bytes_to_bigint(b: str, start: int, length: int) -> str:
    """Unsigned value of ``length`` bytes (at most 7) from 1-based ``start``."""
    return hex_to_bigint(f"hex(substring({b}, {start}, {length}))")


def word_at(data: str, index: int) -> str:
    """The ``index``-th 32-byte word of ABI-encoded data."""
    return f"substring({data}, {32 * index + 1}, 32)"


def bigint_to_word(c: str) -> str:
    """Sign-extend a BIGINT to a word."""
    return f"unhex(lpad(hex({c}), 64, IF({c} < 0, 'F', '0')))"


def zero_word() -> str:
    return f"X'{'0' * 64}'"


def is_negative(word: str) -> str:
    return f"(substring({word}, 1, 1) >= X'80')"


def _narrow(word: str, size: int) -> tuple[str, str]:
    """Conditions that the last ``size`` bytes carry the whole value, by sign."""
    top, sign = f"substring({word}, 1, {32 - size})", f"substring({word}, {33 - size}, 1)"
    whole = f"octet_length({word}) = 32 AND"
    return (
        f"{whole} {top} = X'{'00' * (32 - size)}' AND {sign} < X'80'",
        f"{whole} {top} = X'{'FF' * (32 - size)}' AND {sign} >= X'80'",
    )


def fits_bigint(word: str) -> str:
    plus, minus = _narrow(word, 8)
    return f"(({plus}) OR ({minus}))"


def word_to_bigint(word: str) -> str:
    """The word as BIGINT; NULL when it needs more than 64 bits."""
    plus, minus = _narrow(word, 8)
    high, low = bytes_to_bigint(word, 25, 4), bytes_to_bigint(word, 29, 4)
    return (
        f"CASE WHEN {plus} THEN {high} * {2**32} + {low} "
        f"WHEN {minus} THEN ({high} - {2**32}) * {2**32} + {low} END"
    )


def signed_word(word: str, bits: int) -> str:
    """An intN (N <= 56, whole bytes) word as BIGINT; NULL when not a clean intN."""
    size, spare = bits // 8, 64 - bits
    value = bytes_to_bigint(word, 33 - size, size)
    fill = (
        f"IF(substring({word}, {33 - size}, 1) >= X'80', X'{'FF' * (32 - size)}', "
        f"X'{'00' * (32 - size)}')"
    )
    return (
        f"IF(substring({word}, 1, {32 - size}) = {fill}, "
        f"shiftright(shiftleft({value}, {spare}), {spare}), NULL)"
    )


def unsigned_word(word: str, bits: int) -> str:
    """A uintN (N <= 56, whole bytes) word as BIGINT; NULL when not a clean uintN."""
    size = bits // 8
    return (
        f"IF(substring({word}, 1, {32 - size}) = X'{'00' * (32 - size)}', "
        f"{bytes_to_bigint(word, 33 - size, size)}, NULL)"
    )


def low_bytes(word: str, count: int) -> str:
    """The last ``count`` bytes of a word (an address is the last 20)."""
    return f"substring({word}, {33 - count}, {count})"


def limbs(word: str) -> list[str]:
    """Eight unsigned limbs as separate fragments, least significant first."""
    return [bytes_to_bigint(word, 29 - 4 * i, 4) for i in range(LIMBS)]


def limb_array(word: str) -> str:
    """The same limbs as one array."""
    parts = [hex_to_bigint(f"substring(_l, {57 - 8 * i}, 8)") for i in range(LIMBS)]
    return let(f"hex({word})", "_l", f"array({', '.join(parts)})")


def pack(parts: str, carry: int = 0) -> str:
    """Propagate carries through an array of limbs, modulo 2^256; limbs may be negative."""
    total = "(_x + _c.carry)"
    return (
        f"aggregate({parts}, named_struct('carry', {carry}L, 'out', ''), (_c, _x) -> "
        f"named_struct('carry', shiftright({total}, 32), "
        f"'out', concat(lpad(hex({total} & {_LOW32}), 8, '0'), _c.out)), _c -> unhex(_c.out))"
    )


def limbs_to_word(parts: list[str]) -> str:
    """Pack limb fragments; NULL limbs give a NULL word."""
    return let(f"array({', '.join(parts)})", "_y", f"IF(_y[0] IS NULL, NULL, {pack('_y')})")


def flat_word(parts: list[str]) -> str:
    """Limbs whose carries have run already, least significant first, as a word."""
    low = [f"lpad(hex({p} & {_LOW32}L), 8, '0')" for p in reversed(parts)]
    return f"unhex(concat({', '.join(low)}))"


def word_add(a: str, b: str) -> str:
    return pack(f"zip_with({limb_array(a)}, {limb_array(b)}, (_p, _q) -> _p + _q)")


def word_negate(a: str) -> str:
    return pack(f"transform({limb_array(a)}, _p -> {_LOW32} - _p)", carry=1)


def minimal_signed_bytes(word: str) -> str:
    """Shortest big-endian two's complement; absent (NULL) becomes empty bytes."""
    return (
        "coalesce(unhex("
        + let(
            f"hex({word})",
            "_h",
            "IF(_h >= '8', regexp_replace(_h, '^(FF)+(?=[89A-F].)', ''), "
            "regexp_replace(_h, '^(00)+(?=[0-7].)', ''))",
        )
        + "), X'')"
    )


def signed_bytes_to_word(b: str) -> str:
    """Inverse of :func:`minimal_signed_bytes`; empty bytes are absent (NULL)."""
    return let(
        f"hex({b})", "_h", "IF(length(_h) > 0, unhex(lpad(_h, 64, IF(_h >= '8', 'F', '0'))), NULL)"
    )


def _long_text(magnitude: str) -> str:
    """Decimal text of any unsigned word, by long multiplication in base 10^9."""
    total = f"(_d * {2**32} + _r.carry)"
    ripple = (
        f"aggregate(_a, named_struct('carry', _i, 'out', {_NONE}), (_r, _d) -> "
        f"named_struct('carry', {total} div {_CHUNK}, "
        f"'out', concat(_r.out, array({total} % {_CHUNK}))), _r -> _r.out)"
    )
    zeros = f"array_repeat(0L, {_CHUNKS})"
    chunks = f"aggregate(reverse({limb_array(magnitude)}), {zeros}, (_a, _i) -> {ripple})"
    padded = (
        f"array_join(transform(reverse({chunks}), _k -> lpad(CAST(_k AS STRING), 9, '0')), '')"
    )
    return f"regexp_replace({padded}, '^0+(?=.)', '')"


def _magnitude_text(magnitude: str) -> str:
    """Decimal text of an unsigned word; up to 120 bits take the cheap branch."""
    high, low = hex_to_bigint("substring(_g, 35, 15)"), hex_to_bigint("substring(_g, 50, 15)")
    medium = (
        f"CAST(CAST({high} AS DECIMAL(19,0)) * CAST({2**60} AS DECIMAL(19,0)) "
        f"+ CAST({low} AS DECIMAL(19,0)) AS STRING)"
    )
    small = let("hex(_m)", "_g", f"IF(substring(_g, 1, 34) = '{'0' * 34}', {medium}, NULL)")
    return let(magnitude, "_m", f"coalesce({small}, {_long_text('_m')})")


def word_text(word: str) -> str:
    """Signed decimal text; 64-bit values take the cheapest branch."""
    return let(
        word,
        "_w",
        "CASE WHEN _w IS NULL THEN NULL "
        f"WHEN {fits_bigint('_w')} THEN CAST({word_to_bigint('_w')} AS STRING) "
        f"WHEN {is_negative('_w')} THEN concat('-', {_magnitude_text(word_negate('_w'))}) "
        f"ELSE {_magnitude_text('_w')} END",
    )


def unsigned_word_text(word: str) -> str:
    """Decimal text of an unsigned word (uint256)."""
    return let(word, "_w", f"IF(_w IS NULL, NULL, {_magnitude_text('_w')})")


def _text_magnitude(digits: str) -> str:
    """Hex of ten limbs, two more than a word, so an overflow stays visible."""
    chunks = ", ".join(
        f"CAST(substring(_z, {9 * i + 1}, 9) AS BIGINT)" for i in range(_CHUNKS)
    )
    total = f"(_d * {_CHUNK} + _r.carry)"
    ripple = (
        f"aggregate(_a, named_struct('carry', _i, 'out', {_NONE}), (_r, _d) -> "
        f"named_struct('carry', shiftright({total}, 32), "
        f"'out', concat(_r.out, array({total} & {_LOW32}))), _r -> _r.out)"
    )
    parts = f"aggregate(array({chunks}), array_repeat(0L, {LIMBS + 2}), (_a, _i) -> {ripple})"
    packed = f"array_join(transform(reverse({parts}), _k -> lpad(hex(_k), 8, '0')), '')"
    return let(f"lpad({digits}, {9 * _CHUNKS}, '0')", "_z", packed)


def text_to_word(text: str) -> str:
    """Decimal text to a word; NULL when it is not an integer.

    An integer beyond int256 is an error: NULL would silently drop the write.
    """
    magnitude = "unhex(substring(_h, 17, 64))"
    too_big = "CAST(raise_error(concat('integer beyond 256 bits: ', _t)) AS BINARY)"
    lowest = f"(_t LIKE '-%' AND substring(_h, 17, 64) = '8{'0' * 63}')"
    wide = let(
        _text_magnitude("_n"),
        "_h",
        f"CASE WHEN substring(_h, 1, 16) <> '{'0' * 16}' THEN {too_big} "
        f"WHEN substring(_h, 17, 1) >= '8' AND NOT {lowest} THEN {too_big} "
        f"WHEN _t LIKE '-%' THEN {word_negate(magnitude)} ELSE {magnitude} END",
    )
    small = let(
        "IF(_t LIKE '-%', -CAST(_n AS BIGINT), CAST(_n AS BIGINT))", "_v", bigint_to_word("_v")
    )
    by_size = let(
        "regexp_extract(_t, '^[+-]?0*([0-9]+)$', 1)",
        "_n",
        f"CASE WHEN length(_n) <= 18 THEN {small} "
        f"WHEN length(_n) <= {9 * _CHUNKS} THEN {wide} ELSE {too_big} END",
    )
    return let(text, "_t", f"IF(_t RLIKE '^[+-]?[0-9]+$', {by_size}, NULL)")


DIGITS = 34


def scaled_text(word: str, decimals: str) -> str:
    """The word over 10^decimals as plain text of at most 34 significant digits.

    Integers of more digits are rounded first: half up above zero, toward zero
    below it.  Dividing by a power of ten then only moves the point.
    """
    head = f"CAST(left(_s, {DIGITS}) AS DECIMAL(38,0))"
    up = f"IF(_n NOT LIKE '-%' AND substring(_s, {DIGITS + 1}, 1) >= '5', 1, 0)"
    rounded = (
        f"IF(length(_s) <= {DIGITS}, _s, concat(CAST({head} + {up} AS STRING), "
        f"repeat('0', length(_s) - {DIGITS})))"
    )
    point = f"CAST({decimals} AS INT)"
    filled = f"lpad(_r, greatest(length(_r), {point} + 1), '0')"
    fraction = f"rtrim('0', right(_f, {point}))"
    moved = (
        f"concat(IF(_n LIKE '-%', '-', ''), left(_f, length(_f) - {point}), "
        f"IF({point} = 0 OR {fraction} = '', '', concat('.', {fraction})))"
    )
    text = let(rounded, "_r", let(filled, "_f", moved))
    body = let("ltrim('-', _n)", "_s", text)
    return let(
        word_text(word), "_n", f"CASE WHEN _n IS NULL OR {decimals} IS NULL THEN NULL "
        f"WHEN _n = '0' THEN '0' ELSE {body} END",
    )


def flipped_text(number: str) -> str:
    """A number's text with the other sign."""
    return let(
        number, "_v",
        "CASE WHEN _v = '0' THEN '0' WHEN _v LIKE '-%' THEN substring(_v, 2) ELSE concat('-', _v) END",
    )


def hex_key(b: str) -> str:
    """``0x`` and lowercase hex of a byte column."""
    return f"concat('0x', lower(hex({b})))"
