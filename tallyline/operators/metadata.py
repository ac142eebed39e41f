"""Token metadata: required calls, fallback decode, join with defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions import words as W
from tallyline.operators.fold import SEGMENT, Put, fold, with_sql
from tallyline.operators.snapshot import drop_seed, with_seed
from tallyline.operators.unpivot import currencies

# The call fields and the defaults of the zero address and of
# tokens that do not answer.
CALL_FIELDS = ("symbol", "name", "totalSupply", "decimals")
ZERO_ADDRESS = "X'" + "0" * 40 + "'"
NATIVE = {"symbol": "'ETH'", "name": "'Ethereum'", "total_supply": "'0'", "decimals": "18L"}
UNKNOWN = {
    "symbol": "'unknown'", "name": "'unknown'", "total_supply": "'0'",
    "decimals": "CAST(NULL AS BIGINT)",
}
NO_DECIMALS = 255


def wanted_tokens(inits: DataFrame) -> DataFrame:
    """Distinct non-zero (block, token) pairs that Initialize rows need."""
    return (
        currencies(inits.select("block", "currency0", "currency1"))
        .where(f"token <> {ZERO_ADDRESS}")
        .select("block", "token")
        .distinct()
    )


def required_calls(inits: DataFrame) -> DataFrame:
    """The four calls of every wanted token."""
    fields = F.explode(F.array(*[F.lit(f) for f in CALL_FIELDS]))
    return wanted_tokens(inits).select("block", "token", fields.alias("field"))


def answered_calls(required: DataFrame, calls: DataFrame) -> DataFrame:
    """Required calls and whether there is a response; a complete snapshot answers all."""
    keys = ["block", "token", "field"]
    found = calls.select(*keys).distinct().withColumn("answered", F.lit(True))
    return required.join(found, keys, "left").selectExpr(
        *keys, "coalesce(answered, false) AS answered"
    )


def _dynamic_text(raw: str) -> str:
    """The ABI string in ``raw``, or NULL when offset or length do not fit."""
    size = f"octet_length({raw})"
    offset = W.word_to_bigint(f"substring({raw}, 1, 32)")
    length = W.word_to_bigint(f"substring({raw}, CAST(_o AS INT) + 1, 32)")
    text = f"make_valid_utf8(CAST(substring({raw}, CAST(_o AS INT) + 33, CAST(_n AS INT)) AS STRING))"
    body = W.let(length, "_n", f"IF(_n >= 0 AND _n <= {size} - _o - 32, {text}, NULL)")
    return W.let(offset, "_o", f"IF(_o >= 0 AND _o <= {size} - 32, {body}, NULL)")


def decode_text(raw: str, failed: str) -> str:
    """Dynamic string, else 32 fixed bytes up to the first NUL.

    A failed call and the bare 32-byte value 1 have no text.
    """
    fixed = f"make_valid_utf8(substring_index(CAST(substring({raw}, 1, 32) AS STRING), chr(0), 1))"
    return (
        f"CASE WHEN {failed} THEN NULL ELSE coalesce({_dynamic_text(raw)}, "
        f"CASE WHEN {raw} = X'{'0' * 63}1' THEN NULL "
        f"WHEN octet_length({raw}) >= 32 THEN {fixed} END) END"
    )


def decode_number(raw: str, failed: str) -> str:
    """The first word of a successful response."""
    return f"IF({failed} OR octet_length({raw}) < 32, NULL, substring({raw}, 1, 32))"


def decode_metadata(calls: DataFrame) -> DataFrame:
    """One row per (block, token) with decoded metadata.

    Each call is decoded on its own row; at most four rows meet per group.
    """
    values = with_sql(
        calls,
        {
            "_text": f"IF(field IN ('symbol', 'name'), {decode_text('raw', 'failed')}, NULL)",
            "_word": "IF(field IN ('totalSupply', 'decimals'), "
            f"{decode_number('raw', 'failed')}, NULL)",
        },
    )
    bits = " ".join(f"WHEN '{f}' THEN {1 << i}" for i, f in enumerate(CALL_FIELDS))
    grouped = values.groupBy("block", "token").agg(
        *[
            F.max(F.when(F.col("field") == field, F.col(col))).alias(name)
            for field, col, name in (
                ("symbol", "_text", "symbol"),
                ("name", "_text", "name"),
                ("totalSupply", "_word", "_supply"),
                ("decimals", "_word", "_decimals"),
            )
        ],
        # One bit per call that has a response, failed or not.
        F.expr(f"bit_or(CASE field {bits} ELSE 0 END)").alias("answers"),
    )
    decimals = W.let(
        W.word_to_bigint("_decimals"), "_v", f"IF(_v >= 0 AND _v < {NO_DECIMALS}, _v, NULL)"
    )
    return grouped.selectExpr(
        "block",
        "token",
        "answers",
        "coalesce(symbol, 'unknown') AS symbol",
        "coalesce(name, 'unknown') AS name",
        f"coalesce({W.unsigned_word_text('_supply')}, '0') AS total_supply",
        f"{decimals} AS decimals",
    )


def token_rows(inits: DataFrame, metadata: DataFrame, complete: bool = False) -> DataFrame:
    """Initialize rows as (side, token) rows with metadata or defaults.

    With ``complete`` a token without a response to each of its calls is an
    error: an incomplete snapshot must not pass for tokens that do not answer.
    """
    names = list(NATIVE)
    joined = currencies(inits).join(
        metadata.withColumn("_known", F.lit(True)), ["block", "token"], "left"
    )
    if complete:
        every = (1 << len(CALL_FIELDS)) - 1
        absent = f"token <> {ZERO_ADDRESS} AND coalesce(answers, 0) <> {every}"
        problem = "concat('metadata responses missing for block ', block, ', token ', hex(token))"
        joined = with_sql(
            joined, {"_known": f"IF({absent}, CAST(raise_error({problem}) AS BOOLEAN), _known)"}
        )
    joined = joined.drop("answers")
    filled = {
        n: f"CASE WHEN token = {ZERO_ADDRESS} THEN {NATIVE[n]} "
        f"WHEN _known THEN {n} ELSE {UNKNOWN[n]} END"
        for n in names
    }
    return with_sql(joined, filled).drop("_known")


def by_side(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Both token rows of an Initialize side by side."""
    return rows.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("side") == side, F.col(n))).alias(f"{n}{side}")
            for n in names
            for side in (0, 1)
        ]
    )


def token_decimals(rows: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """SET: decimals per token as of each (Initialize, side) row.

    Missing decimals write nothing, so an earlier value stays.  The zero address
    is fixed; a pool whose token never answered gets NULL (no write).  ``seeds``
    are ledger rows (token, known) that come before all others.
    """
    if seeds is not None:
        before = seeds.withColumnRenamed("known", "decimals").withColumn("side", F.lit(0))
        rows = with_seed(rows, before)
    done = fold(rows, ["token"], [Put("known", "decimals")], ["block", "ordinal", "side"])
    if seeds is not None:
        done = drop_seed(done)
    return with_sql(
        done, {"pool_decimals": f"IF(token = {ZERO_ADDRESS}, 18L, known_after)"}
    )


def pool_decimals(rows: DataFrame) -> DataFrame:
    """Decimals that each Initialize writes for its pool, one row per event."""
    return by_side(
        token_decimals(rows).select("block", "ordinal", SEGMENT, "side", "pool_decimals"),
        ["block", "ordinal"],
        ["pool_decimals"],
    )
