"""Raw logs derived from ``events``: the test ledger written as ABI bytes.

Each event row becomes one log of the kind it has in the test ledger, with real
addresses and topics, so the decode operators run on what they would read from
a chain.  ``dirty=True`` also truncates some data, moves some logs to a foreign
address, and spreads blocks over the sources' start blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tallyline.functions import words as W
from tallyline.operators.fold import with_sql
from tallyline.sources.catalog import FIRST_BLOCK, REGISTRY, SIGNATURES
from tallyline.sources.ledger import event_rows, ledger_columns
from tallyline.sources.tables import spread, table

WORD = W.bigint_to_word
PRICE_WORD = f"unhex(lpad(concat(hex(price), '{'0' * 20}'), 64, '0'))"  # price * 2^80
POOL_WORD = "unhex(concat(md5(CAST(CAST(pool AS STRING) AS BINARY)), " \
    "md5(CAST(CAST(pool AS STRING) AS BINARY))))"
TOKEN0, TOKEN1 = "k", "(cents % 300 + 1)"
AMOUNT0 = "IF(k % 2 = 1, -cents, cents)"
AMOUNT1 = f"(-({AMOUNT0}) * (k + 1))"
DIRTY_STRIDE = 4000
DIRTY_BLOCK = FIRST_BLOCK - 8


def address(value: str) -> str:
    return f"unhex(lpad(hex({value}), 40, '0'))"


def _bytes(parts: list[str]) -> str:
    return f"concat({', '.join(parts)})" if parts else "X''"


_TOPICS = {
    "Initialize": [POOL_WORD, WORD(TOKEN0), WORD(TOKEN1)],
    "ModifyLiquidity": [POOL_WORD, WORD("pool + 1")],
    "Swap": [POOL_WORD, WORD("pool + 1")],
    "Subscription": [WORD("event_id"), WORD("pool + 1")],
    "Unsubscription": [WORD("event_id"), WORD("pool + 1")],
    "Transfer": [WORD("pool + 1"), WORD("k + 1"), WORD("event_id")],
    "LogCreatePrivateHook": [WORD("pool + 1"), WORD("k + 1")],
}
_DATA = {
    "Initialize": [
        WORD("cents"), WORD("(k - 50)"), WORD("pool + 1"), PRICE_WORD, WORD("tick"),
    ],
    "ModifyLiquidity": [WORD("lower"), WORD("upper"), WORD("delta"), WORD("event_id")],
    "Swap": [
        WORD(f"({AMOUNT0})"), WORD(AMOUNT1), PRICE_WORD, WORD("liquidity"), WORD("tick"),
        WORD("k"),
    ],
    "LogCreatePrivateHook": [WORD("event_id")],
}


def _by_kind(values: dict[str, str]) -> str:
    return (
        "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"
    )


def encode_logs(ledger: DataFrame, dirty: bool = False) -> DataFrame:
    addresses = {s.name: s.address for s in REGISTRY}
    emitter = _by_kind({s.kind: f"X'{addresses[s.source]}'" for s in SIGNATURES})
    topics = _by_kind(
        {s.kind: f"array(X'{s.topic0}', {', '.join(_TOPICS[s.kind])})" for s in SIGNATURES}
    )
    data = _by_kind({s.kind: _bytes(_DATA.get(s.kind, [])) for s in SIGNATURES})
    block = "block"
    if dirty:
        # One byte short where there is data, one byte long where there is none.
        data = (
            f"(CASE WHEN k % 25 <> 7 THEN {data} WHEN octet_length({data}) = 0 THEN X'00' "
            f"ELSE substring({data}, 1, octet_length({data}) - 1) END)"
        )
        emitter = f"IF(k % 25 = 8, {address('0')}, {emitter})"
        block = f"{DIRTY_BLOCK} + (event_id div 10) * {DIRTY_STRIDE}"
    tx = "slot div 4"
    columns = {
        "block": block,
        "block_hash": WORD("block"),
        "parent_hash": WORD("block - 1"),
        "seconds": "block * 2",
        "nanos": "0L",
        "tx_index": tx,
        "tx_hash": WORD(f"(block * 10 + {tx})"),
        "origin": address(f"block * 10 + {tx}"),
        "recipient": address("1"),
        "gas_price": f"IF(block % 3 = 0, NULL, {WORD('block')})",
        "status": f"IF((block + {tx}) % 7 = 0, 0L, 1L)",
        "address": emitter,
        "topics": topics,
        "data": data,
        "tx_log_index": "slot % 4",
        "log_index": "slot",
        "ordinal": "ordinal",
    }
    # A generator hands on finished columns: filters of the decode stay above
    # it, as they would above a stored log table.  The columns are made below
    # it, in generated code; a generator evaluates its own expressions node by node.
    finished = ledger.selectExpr(*(f"{sql} AS {name}" for name, sql in columns.items()))
    parts = ", ".join(f"'{name}', {name}" for name in columns)
    return finished.selectExpr(f"inline(array(named_struct({parts})))")


def encoded_logs(
    spark: SparkSession, sf_dir: str, dirty: bool = False, part: Column | None = None
) -> DataFrame:
    """All logs, or those of the ledger rows in ``part``: only these are encoded."""
    rows = ledger_columns(spread(event_rows(spark, sf_dir), "event_id"))
    return encode_logs(rows if part is None else rows.where(part), dirty)


def token_calls(spark: SparkSession, sf_dir: str, wanted: DataFrame) -> DataFrame:
    """Responses of the four metadata calls for each wanted (block, token).

    Texts come as dynamic strings, fixed 32-byte strings or the value 1; numbers
    as words; some calls fail.  Tokens without a ``part`` row fail entirely.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size")
    keyed = with_sql(wanted, {"p_partkey": W.bytes_to_bigint("token", 14, 7)})
    rows = keyed.join(part, "p_partkey", "left")
    nul_name = "IF(p_partkey % 7 = 3, replace(p_name, ' ', chr(0)), p_name)"
    fixed = "unhex(rpad(hex(p_brand), 64, '0'))"
    symbol = (
        f"CASE p_partkey % 4 WHEN 1 THEN {fixed} WHEN 2 THEN {WORD('1')} "
        f"ELSE {dynamic_string('p_brand')} END"
    )
    decimals = WORD("IF(p_partkey % 11 = 5, 255L, CAST(p_size % 19 AS BIGINT))")
    calls = [
        ("symbol", "p_partkey % 9 = 8", symbol),
        ("name", "false", dynamic_string(nul_name)),
        ("totalSupply", "p_partkey % 6 = 5", WORD("p_partkey * 1000")),
        ("decimals", "(block + p_partkey) % 5 = 0", decimals),
    ]
    structs = ", ".join(
        f"named_struct('field', '{field}', 'failed', p_brand IS NULL OR {failed}, "
        f"'raw', IF(p_brand IS NULL OR {failed}, X'', {raw}))"
        for field, failed, raw in calls
    )
    return rows.selectExpr("block", "token", f"inline(array({structs}))")


def dynamic_string(text: str) -> str:
    """ABI encoding of one string: offset, byte length, padded bytes."""
    size = f"octet_length({text})"
    return (
        f"unhex(concat(lpad('20', 64, '0'), lpad(hex({size}), 64, '0'), "
        f"rpad(hex({text}), CAST(ceil({size} / 32) AS INT) * 64, '0')))"
    )

