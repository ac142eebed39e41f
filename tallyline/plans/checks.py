"""SQL fragments shared by the checks of valued and encoded columns."""

from __future__ import annotations

from tallyline.plans.state import POOL_SQL

# 2^128 / sqrt(1.0001)^(2^i) for the bits of ticks below 1024.
TICK_FACTORS = (
    340265354078544963557816517032075149313,
    340248342086729790484326174814286782778,
    340214320654664324051920982716015181260,
    340146287995602323631171512101879684304,
    340010263488231146823593991679159461444,
    339738377640345403697157401104375502016,
    339195258003219555707034227454543997025,
    338111622100601834656805679988414885971,
    335954724994790223023589805789778977700,
    331682121138379247127172139078559817300,
)
TWO64 = "'18446744073709551616'::UHUGEINT"


def minimal_hex(v: str) -> str:
    """Shortest signed big-endian hex of a BIGINT; empty when NULL."""
    sizes = " ".join(
        f"WHEN {v} BETWEEN {-(2 ** (8 * n - 1))} AND {2 ** (8 * n - 1) - 1} THEN {2 * n}"
        for n in range(1, 8)
    )
    return (
        f"CASE WHEN {v} IS NULL THEN '' ELSE right(lpad(lower(to_hex(CAST({v} AS BIGINT))), 16, "
        f"'0'), CASE {sizes} ELSE 16 END) END"
    )


def _mul_shift(a: str, b: int) -> str:
    """(a * b) >> 128 for values below 2^128, in 64-bit halves."""
    bh, bl = f"'{b >> 64}'::UHUGEINT", f"'{b % 2**64}'::UHUGEINT"
    ah, al = f"({a} // {TWO64})", f"({a} % {TWO64})"
    mid = (
        f"({al} * {bl}) // {TWO64} + ({ah} * {bl}) % {TWO64} + ({al} * {bh}) % {TWO64}"
    )
    return (
        f"{ah} * {bh} + ({ah} * {bl}) // {TWO64} + ({al} * {bh}) // {TWO64} + ({mid}) // {TWO64}"
    )


def ratio_ctes(ticks: str) -> str:
    """CTEs ending in ``ratios(bound, ratio)`` for |bound| < 1024.

    NULL stands for 2^128, which no 128-bit column holds.  Positive ticks take
    a bitwise long division of 2^256 - 1.
    """
    steps, previous = [], "f_start"
    for bit, factor in enumerate(TICK_FACTORS):
        name = f"f_{bit}"
        steps.append(
            f"{name} AS (SELECT bound, CASE WHEN (abs(bound) >> {bit}) & 1 = 0 THEN r "
            f"WHEN r IS NULL THEN '{factor}'::UHUGEINT ELSE {_mul_shift('r', factor)} END AS r "
            f"FROM {previous})"
        )
        previous = name
    top = 2**128 - 1
    return f"""
f_start AS (SELECT bound, CAST(NULL AS UHUGEINT) AS r FROM ({ticks})),
{", ".join(steps)},
division AS (
  SELECT bound, r, 0 AS i, '{top}'::UHUGEINT - r AS rem, 1::UHUGEINT AS q, false AS low
  FROM {previous} WHERE bound > 0
  UNION ALL
  SELECT bound, r, i + 1,
         CASE WHEN hit AND rem >= r - rem THEN rem - (r - rem) + 1::UHUGEINT WHEN hit THEN 0::UHUGEINT
              ELSE rem + rem + 1::UHUGEINT END,
         CASE WHEN i < 96 THEN q + q + CASE WHEN hit THEN 1::UHUGEINT ELSE 0::UHUGEINT END ELSE q END,
         low OR (i >= 96 AND hit)
  FROM (SELECT *, rem >= r - rem OR r - rem = rem + 1::UHUGEINT AS hit FROM division WHERE i < 128)),
ratios AS (
  SELECT bound, CAST(79228162514264337593543950336 AS HUGEINT) AS ratio
  FROM {previous} WHERE bound = 0
  UNION ALL
  SELECT bound, CAST(r // 4294967296::UHUGEINT AS HUGEINT)
    + CASE WHEN r % 4294967296::UHUGEINT = 0 THEN 0 ELSE 1 END
  FROM {previous} WHERE bound < 0
  UNION ALL
  SELECT bound, CAST(q AS HUGEINT) + CASE WHEN low THEN 1 ELSE 0 END
  FROM division WHERE i = 128)"""


BOUNDS_SQL = "SELECT lower AS bound FROM L WHERE lower IS NOT NULL" \
    " UNION SELECT upper FROM L WHERE upper IS NOT NULL"


def _ceil_if(up: str, a: str, b: str) -> str:
    return f"(({a}) // ({b}) + CASE WHEN {up} AND ({a}) % ({b}) <> 0 THEN 1 ELSE 0 END)"


# Token rows, decimals known per token as of each Initialize, then per pool.
TOKENS_SQL = """
I AS (
  SELECT event_id, block, ordinal, pool, 0 AS side, k AS token FROM L WHERE kind = 'Initialize'
  UNION ALL
  SELECT event_id, block, ordinal, pool, 1, cents % 300 + 1 FROM L WHERE kind = 'Initialize'),
M AS (
  SELECT I.*, p_partkey, p_brand, p_name,
         CAST(CASE WHEN token = 0 THEN 18 WHEN p_partkey IS NULL OR (block + token) % 5 = 0
                     OR p_partkey % 11 = 5 THEN NULL ELSE p_size % 19 END AS BIGINT) AS decimals,
         CASE WHEN token = 0 THEN 'ETH' WHEN p_partkey IS NULL OR p_partkey % 9 = 8
                OR p_partkey % 4 = 2 THEN 'unknown' ELSE p_brand END AS symbol,
         CASE WHEN token = 0 THEN 'Ethereum' WHEN p_partkey IS NULL THEN 'unknown'
              WHEN p_partkey % 7 = 3 THEN replace(p_name, ' ', chr(0)) ELSE p_name END AS name,
         CASE WHEN token = 0 OR p_partkey IS NULL OR p_partkey % 6 = 5 THEN '0'
              ELSE CAST(p_partkey * 1000 AS VARCHAR) END AS total_supply
  FROM I LEFT JOIN part ON p_partkey = token),
K AS (
  SELECT *, last_value(decimals IGNORE NULLS) OVER (
           PARTITION BY token ORDER BY block, ordinal, side
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS known_after
  FROM M),
D AS (
  SELECT event_id, max(CASE WHEN side = 0 THEN known_after END) AS set0,
         max(CASE WHEN side = 1 THEN known_after END) AS set1
  FROM K GROUP BY event_id),
DP AS (
  SELECT S.*, last_value(set0 IGNORE NULLS) OVER w AS decimals0,
         last_value(set1 IGNORE NULLS) OVER w AS decimals1
  FROM S LEFT JOIN D USING (event_id)
  WINDOW w AS (PARTITION BY pool ORDER BY block, ordinal
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

# Raw amounts: x * 2^96 / b by four 24-bit steps, each within 128 bits.
_P2 = "CAST(price_before AS HUGEINT) * 1208925819614629174706176"
AMOUNTS_SQL = f"""
V0 AS (
  SELECT DP.*, lo.ratio AS rl, hi.ratio AS ru, {_P2} AS pb, abs(CAST(delta AS HUGEINT)) AS liq,
         delta > 0 AS up
  FROM DP LEFT JOIN ratios lo ON lo.bound = DP.lower LEFT JOIN ratios hi ON hi.bound = DP.upper),
V1 AS (
  SELECT *, CASE WHEN tick_before < lower THEN rl ELSE pb END AS a0, ru AS b0,
         rl AS a1, CASE WHEN tick_before < upper THEN pb ELSE ru END AS b1
  FROM V0),
V2 AS (SELECT *, greatest(a0, b0) AS h0, least(a0, b0) AS l0, liq * abs(b0 - a0) AS x FROM V1),
V3 AS (SELECT *, x // h0 AS q0, x % h0 AS r0 FROM V2),
V4 AS (SELECT *, q0 * 16777216 + (r0 * 16777216) // h0 AS q1, (r0 * 16777216) % h0 AS r1 FROM V3),
V5 AS (SELECT *, q1 * 16777216 + (r1 * 16777216) // h0 AS q2, (r1 * 16777216) % h0 AS r2 FROM V4),
V6 AS (SELECT *, q2 * 16777216 + (r2 * 16777216) // h0 AS q3, (r2 * 16777216) % h0 AS r3 FROM V5),
V7 AS (SELECT *, q3 * 16777216 + (r3 * 16777216) // h0
         + CASE WHEN up AND (r3 * 16777216) % h0 <> 0 THEN 1 ELSE 0 END AS q FROM V6),
V AS (
  SELECT *,
    CASE WHEN delta IS NULL OR tick_before IS NULL THEN NULL
         WHEN tick_before >= upper THEN 0
         ELSE CASE WHEN up THEN 1 ELSE -1 END * {_ceil_if('up', 'q', 'l0')} END AS raw0,
    CASE WHEN delta IS NULL OR tick_before IS NULL THEN NULL
         WHEN tick_before < lower THEN 0
         ELSE CASE WHEN up THEN 1 ELSE -1 END
              * {_ceil_if('up', 'liq * abs(b1 - a1)', '79228162514264337593543950336')}
         END AS raw1
  FROM V7)"""

VALUED_SQL = (
    POOL_SQL.replace("WITH e AS", "WITH RECURSIVE e AS", 1)
    + ", "
    + ratio_ctes(BOUNDS_SQL)
    + ", "
    + TOKENS_SQL
    + ", "
    + AMOUNTS_SQL
)


def scaled_sql(amount: str, decimals: str) -> str:
    """amount / 10^decimals as plain text without trailing zeros."""
    digits = f"lpad(CAST(abs({amount}) AS VARCHAR), 40, '0')"
    whole = f"ltrim(left({digits}, length({digits}) - CAST({decimals} AS INTEGER)), '0')"
    frac = f"rtrim(right({digits}, CAST({decimals} AS INTEGER)), '0')"
    return (
        f"CASE WHEN {amount} = 0 THEN '0' ELSE CASE WHEN {amount} < 0 THEN '-' ELSE '' END "
        f"|| CASE WHEN {whole} = '' THEN '0' ELSE {whole} END "
        f"|| CASE WHEN {decimals} = 0 OR {frac} = '' THEN '' ELSE '.' || {frac} END END"
    )


def _digits34(value: str) -> str:
    """A positive integer rounded half up to 34 digits, as a fragment."""
    drop = f"greatest(length(CAST({value} AS VARCHAR)) - 34, 0)"
    half = f"CASE WHEN {drop} > 0 THEN 5 * CAST('1' || repeat('0', {drop} - 1) AS HUGEINT) ELSE 0 END"
    return f"(({value} + {half}) // CAST('1' || repeat('0', {drop}) AS HUGEINT))"


def _dropped(value: str) -> str:
    return f"greatest(length(CAST({value} AS VARCHAR)) - 34, 0)"


def _long_division(name: str, source: str, top: str, bottom: str) -> str:
    """CTEs adding ``q``: top / bottom times 10^36 without rounding, four digits a step."""
    steps = [f"{name}_0 AS (SELECT *, {top} // {bottom} AS q, {top} % {bottom} AS rest FROM {source})"]
    for i in range(9):
        steps.append(
            f"{name}_{i + 1} AS (SELECT * REPLACE (q * 10000 + (rest * 10000) // {bottom} AS q, "
            f"(rest * 10000) % {bottom} AS rest) FROM {name}_{i})"
        )
    return ",\n".join(steps)


def plain_sql(digits: str, exponent: str) -> str:
    """digits * 10^exponent in plain notation without trailing zeros."""
    text = f"rtrim(CAST({digits} AS VARCHAR), '0')"
    shift = f"({exponent} + length(CAST({digits} AS VARCHAR)) - length({text}))"
    padded = f"lpad({text}, greatest(length({text}), 1 - {shift})::INTEGER, '0')"
    return (
        f"CASE WHEN {shift} >= 0 THEN {text} || repeat('0', {shift}) ELSE "
        f"left({padded}, length({padded}) + {shift}) || '.' || right({padded}, -{shift}) END"
    )


def price_ctes(source: str) -> str:
    """CTEs ending in ``prices(event_id, price0, price1)`` with all 34 digits.

    ``source`` has event_id, price (sqrt price / 2^80), decimals0 and decimals1.
    Operands are rounded to 34 digits before each division, as the prices are
    defined; products run in two halves of 24 digits.
    """
    e24 = "1000000000000000000000000::HUGEINT"
    high, low = divmod(2**160, 10**24)
    bottom = f"'{str(2**192)[:34]}'::HUGEINT"  # the digit after these is a 4
    digits = "length(CAST(hi AS VARCHAR))"
    power = lambda n: f"CAST('1' || repeat('0', {n}) AS HUGEINT)"
    return f"""
pr_a AS (SELECT event_id, decimals0, decimals1, CAST(price AS HUGEINT) * price AS n FROM {source}),
pr_b AS (SELECT *, n * {high}::HUGEINT + (n * {low}::HUGEINT) // {e24} AS hi, (n * {low}::HUGEINT) % {e24} AS lo FROM pr_a),
pr_c AS (SELECT *, greatest(34 - {digits}, 0) AS g FROM pr_b),
pr_d AS (
  SELECT event_id, decimals0, decimals1,
    CASE WHEN {digits} > 34 THEN {_digits34('hi')}
         ELSE hi * {power('g')} + lo // {power('24 - g')}
           + CASE WHEN lo % {power('24 - g')} >= 5 * {power('23 - g')} THEN 1 ELSE 0 END END AS m,
    CASE WHEN {digits} > 34 THEN {digits} - 34 ELSE -g END AS e
  FROM pr_c),
{_long_division('pr_e', 'pr_d', 'm', bottom)},
pr_f AS (
  SELECT event_id, {_digits34('q')} AS ratio, e - 36 + {_dropped('q')} + decimals0 - decimals1 AS ex
  FROM pr_e_9),
{_long_division('pr_g', 'pr_f', "'10000000000000000000000000000000000'::HUGEINT", 'ratio')},
prices AS (
  SELECT event_id, {plain_sql('ratio', 'ex')} AS price1,
    {plain_sql(_digits34('q'), f"(-70 - ex + {_dropped('q')})")} AS price0
  FROM pr_g_9)"""
