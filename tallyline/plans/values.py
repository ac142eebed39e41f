"""Queries of the metadata and derived-value families."""

from __future__ import annotations

from tallyline.functions import words as W
from tallyline.operators import metadata as M
from tallyline.operators import valuation as V
from tallyline.operators.decode import decode
from tallyline.operators.enrich import initialize_tokens, pool_values
from tallyline.operators.fold import SEGMENT, Put, fold
from tallyline.plans.checks import (
    BOUNDS_SQL,
    TOKENS_SQL,
    VALUED_SQL,
    minimal_hex,
    ratio_ctes,
    price_ctes,
    scaled_sql,
)
from tallyline.plans.decode import key_sql, keys
from tallyline.plans.registry import query
from tallyline.plans.state import POOL_SQL
from tallyline.sources.encoded import encoded_logs, token_calls
from tallyline.sources.ledger import LEDGER_SQL, ledger, ledger_segments
from tallyline.sources.stage import stage


def segmented_events(spark, sf_dir):
    """Decoded events with their segment, planned from one id column."""
    segments = ledger_segments(spark, sf_dir)
    return decode(encoded_logs(spark, sf_dir)).withColumn(SEGMENT, segments.of())


def initializations(spark, sf_dir):
    return segmented_events(spark, sf_dir).where("kind = 'Initialize'")


def calls_for(spark, sf_dir, inits):
    return token_calls(spark, sf_dir, M.wanted_tokens(inits))


def metadata_for(spark, sf_dir, events):
    inits = events.where("kind = 'Initialize'")
    return M.decode_metadata(calls_for(spark, sf_dir, inits))


META_SQL = POOL_SQL + ", " + TOKENS_SQL


@query(
    "meta_required_calls",
    META_SQL
    + f""", N AS (SELECT DISTINCT block, token, p_partkey FROM M WHERE token <> 0)
SELECT block, {key_sql('token')} AS token, field,
  NOT (field = 'totalSupply' AND token % 97 = 13) AS answered
FROM N, (VALUES ('symbol'), ('name'), ('totalSupply'), ('decimals')) f(field)""",
)
def meta_required_calls(spark, sf_dir):
    """Every call the metadata needs, and whether the snapshot answers it."""
    inits = initializations(spark, sf_dir)
    required = M.required_calls(inits)
    index = W.bytes_to_bigint("token", 14, 7)
    calls = calls_for(spark, sf_dir, inits).where(
        f"NOT (field = 'totalSupply' AND {index} % 97 = 13)"
    )
    return M.answered_calls(required, calls).selectExpr("block", *keys("token"), "field", "answered")


@query(
    "meta_fallback_chain",
    META_SQL
    + f"""SELECT DISTINCT block, {key_sql('token')} AS token, symbol, hex(name) AS name,
  total_supply, decimals
FROM M WHERE token <> 0""",
)
def meta_fallback_chain(spark, sf_dir):
    """Raw responses to metadata, with each fallback."""
    metadata = metadata_for(spark, sf_dir, segmented_events(spark, sf_dir))
    return metadata.selectExpr(
        "block", *keys("token"), "symbol", "hex(name) AS name", "total_supply", "decimals"
    )


@query(
    "meta_join_defaults",
    META_SQL
    + """SELECT block, ordinal, CAST(side AS INTEGER) AS side, token, symbol, hex(name) AS name,
  total_supply, decimals FROM M""",
)
def meta_join_defaults(spark, sf_dir):
    """Metadata joined on (block, token); zero address and unknowns get defaults."""
    events = segmented_events(spark, sf_dir)
    # Only tokens that answered something stay in the snapshot.
    known = metadata_for(spark, sf_dir, events).where("name <> 'unknown'")
    rows = M.token_rows(events.where("kind = 'Initialize'"), known)
    return rows.selectExpr(
        "block", "ordinal", "side", f"{W.bytes_to_bigint('token', 14, 7)} AS token", "symbol",
        "hex(name) AS name", "total_supply", "decimals",
    )


def _token_rows(spark, sf_dir):
    events = segmented_events(spark, sf_dir)
    inits = events.where("kind = 'Initialize'").select(
        "block", "ordinal", SEGMENT, "pool", "currency0", "currency1"
    )
    return M.token_rows(inits, metadata_for(spark, sf_dir, events))


@query(
    "state_token_attr",
    META_SQL
    + """SELECT block, ordinal, CAST(side AS INTEGER) AS side, token, decimals,
  known_after FROM K""",
)
def state_token_attr(spark, sf_dir):
    """SET: decimals per token; a missing answer keeps the earlier value."""
    done = fold(
        _token_rows(spark, sf_dir), ["token"], [Put("known", "decimals")],
        ["block", "ordinal", "side"],
    )
    return done.selectExpr(
        "block", "ordinal", "side", f"{W.bytes_to_bigint('token', 14, 7)} AS token",
        "decimals", "known_after",
    )


@query(
    "state_dependent_set",
    META_SQL
    + """SELECT block, ordinal, CAST(side AS INTEGER) AS side,
  CASE WHEN token = 0 THEN 18 ELSE known_after END AS pool_decimals
FROM K WHERE token = 0 OR known_after IS NOT NULL""",
)
def state_dependent_set(spark, sf_dir):
    """SET fed by another state: decimals written per (side, pool)."""
    rows = M.token_decimals(_token_rows(spark, sf_dir))
    return rows.where("pool_decimals IS NOT NULL").select(
        "block", "ordinal", "side", "pool_decimals"
    )


@query(
    "tick_dimension",
    LEDGER_SQL.replace("WITH e", "WITH RECURSIVE e", 1)
    + ", "
    + ratio_ctes(BOUNDS_SQL)
    + " SELECT bound, CAST(ratio AS VARCHAR) AS ratio FROM ratios",
)
def tick_dimension(spark, sf_dir):
    """Q96 square-root ratio of every bound in the ledger."""
    return V.tick_dimension(ledger(spark, sf_dir)).selectExpr(
        "bound", f"{W.word_text('ratio')} AS ratio"
    )


@query(
    "muldiv_round",
    LEDGER_SQL
    + """, X AS (SELECT event_id, delta, k + 1 AS num, cents + 3 AS den,
  abs(delta) * (k + 1) AS p FROM L WHERE delta IS NOT NULL)
SELECT event_id, CAST(CASE WHEN delta > 0 THEN p // den + CASE WHEN p % den = 0 THEN 0 ELSE 1 END
  ELSE -(p // den) END AS BIGINT) AS quotient FROM X""",
)
def muldiv_round(spark, sf_dir):
    """Multiply, divide, round up above zero and toward zero below."""
    product, den = "(delta * (k + 1))", "(cents + 3)"
    up = f"IF(delta > 0 AND {product} % {den} <> 0, 1, 0)"
    return ledger(spark, sf_dir).where("delta IS NOT NULL").selectExpr(
        "event_id", f"{product} div {den} + {up} AS quotient"
    )


def _valued(spark, sf_dir):
    events = stage(segmented_events(spark, sf_dir), "events")
    tokens = stage(
        initialize_tokens(events, metadata_for(spark, sf_dir, events)), "tokens"
    )
    return pool_values(events, tokens)


@query(
    "position_valuation",
    VALUED_SQL
    + """ SELECT block, ordinal, CAST(raw0 AS VARCHAR) AS amount0, CAST(raw1 AS VARCHAR) AS amount1
FROM V WHERE kind = 'ModifyLiquidity'""",
)
def position_valuation(spark, sf_dir):
    """Raw token amounts of each liquidity change."""
    return (
        _valued(spark, sf_dir)
        .where("kind = 'ModifyLiquidity'")
        .selectExpr(
            "block", "ordinal", f"{W.word_text('raw0')} AS amount0",
            f"{W.word_text('raw1')} AS amount1",
        )
    )


RAW_SQL = """
CASE kind WHEN 'Swap' THEN CASE WHEN k % 2 = 1 THEN cents ELSE -cents END
  WHEN 'ModifyLiquidity' THEN raw0 END AS flow0,
CASE kind WHEN 'Swap' THEN (CASE WHEN k % 2 = 1 THEN -cents ELSE cents END) * (k + 1)
  WHEN 'ModifyLiquidity' THEN raw1 END AS flow1"""
BOTH_SQL = "decimals0 IS NOT NULL AND decimals1 IS NOT NULL"
TOKEN_AMOUNTS_SQL = ",\n".join(
    f"CASE WHEN {BOTH_SQL} THEN {scaled_sql(f'flow{i}', f'decimals{i}')} END AS token_amount{i}"
    for i in (0, 1)
)


@query(
    "token_amounts",
    VALUED_SQL
    + f""", Z AS (SELECT *, {RAW_SQL} FROM V)
SELECT block, ordinal, kind, {TOKEN_AMOUNTS_SQL} FROM Z""",
)
def token_amounts(spark, sf_dir):
    """Amounts over 10^decimals as plain 34-digit text."""
    return _valued(spark, sf_dir).select(
        "block", "ordinal", "kind", "token_amount0", "token_amount1"
    )


PRICED_SQL = f"kind IN ('Initialize', 'Swap') AND {BOTH_SQL}"
PRICES_SQL = price_ctes(f"(SELECT * FROM V WHERE {PRICED_SQL})")


@query(
    "pool_prices",
    VALUED_SQL
    + f""", {PRICES_SQL} SELECT block, ordinal, coalesce(price0, '') AS price0, coalesce(price1, '') AS price1
FROM V LEFT JOIN prices USING (event_id)""",
)
def pool_prices(spark, sf_dir):
    """Token prices to all 34 digits; empty text where there is none."""
    return _valued(spark, sf_dir).selectExpr(
        "block", "ordinal", *[f"token{i}_price_after AS price{i}" for i in (0, 1)]
    )


@query(
    "encode_signed_bytes",
    LEDGER_SQL
    + f"SELECT event_id, {minimal_hex('delta')} AS delta, {minimal_hex('tick')} AS tick FROM L",
)
def encode_signed_bytes(spark, sf_dir):
    """Shortest signed big-endian bytes; absent is empty, zero keeps one byte."""
    return ledger(spark, sf_dir).selectExpr(
        "event_id",
        *[
            f"lower(hex({W.minimal_signed_bytes(W.bigint_to_word(c))})) AS {c}"
            for c in ("delta", "tick")
        ],
    )
