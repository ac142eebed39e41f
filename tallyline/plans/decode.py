"""Queries of the source and decode families."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.functions import words as W
from tallyline.operators import decode as D
from tallyline.operators.fold import with_sql
from tallyline.operators.pool_state import pool_events
from tallyline.operators.unpivot import currencies, tick_ids, tick_operations
from tallyline.plans.registry import query
from tallyline.plans.state import OPS_SQL
from tallyline.sources.blocks import block_range, explode_logs, nest_blocks
from tallyline.sources.catalog import FIRST_BLOCK, REGISTRY, SIGNATURES
from tallyline.sources.encoded import DIRTY_BLOCK, DIRTY_STRIDE, encoded_logs
from tallyline.sources.ledger import LEDGER_BLOCK, LEDGER_SQL, ledger


def key_sql(value: str, digits: int = 40) -> str:
    """SQL check: an address or word as ``0x`` hex."""
    return f"'0x' || lpad(lower(to_hex({value})), {digits}, '0')"


POOL_KEY_SQL = "'0x' || md5(CAST(pool AS VARCHAR)) || md5(CAST(pool AS VARCHAR))"
AMOUNT0_SQL = "CASE WHEN k % 2 = 1 THEN -cents ELSE cents END"
PRICE_SQL = "CAST(CAST(price AS HUGEINT) * 1208925819614629174706176 AS VARCHAR)"  # 2^80


def keys(*names: str) -> list[str]:
    return [f"{W.hex_key(n)} AS {n}" for n in names]


def text(*names: str) -> list[str]:
    return [f"{W.word_text(n)} AS {n}" for n in names]


def decoded(spark, sf_dir, kind, *columns):
    rows = D.decode(encoded_logs(spark, sf_dir)).where(F.col("kind") == kind)
    return rows.selectExpr("block", "ordinal", *columns)


@query(
    "src_explode_logs",
    LEDGER_SQL
    + f"""SELECT block, slot // 4 AS tx_index, slot % 4 AS tx_log_index, slot AS log_index, ordinal,
  CAST(CASE kind {" ".join(f"WHEN '{s.kind}' THEN {s.topics}" for s in SIGNATURES)} END
       AS INTEGER) AS topics,
  CAST(CASE kind {" ".join(f"WHEN '{s.kind}' THEN {s.data_bytes}" for s in SIGNATURES)} END
       AS INTEGER) AS data_bytes
FROM L WHERE (block + slot // 4) % 7 <> 0 AND (block + slot // 4) % 11 <> 0""",
)
def src_explode_logs(spark, sf_dir):
    """Nested blocks to logs; failed transactions and missing receipts give none."""
    nested = nest_blocks(encoded_logs(spark, sf_dir))
    no_receipt = F.transform(
        "transactions",
        lambda tx: tx.withField(
            "logs", F.when((F.col("block") + tx["tx_index"]) % 11 != 0, tx["logs"])
        ),
    )
    logs = explode_logs(nested.withColumn("transactions", no_receipt))
    return logs.selectExpr(
        "block", "tx_index", "tx_log_index", "log_index", "ordinal",
        "size(topics) AS topics", "octet_length(data) AS data_bytes",
    )


@query(
    "src_block_range",
    LEDGER_SQL
    + f"""SELECT block, count(*) AS logs FROM L
WHERE block >= {FIRST_BLOCK} AND block >= {LEDGER_BLOCK + 25} AND block < {LEDGER_BLOCK + 75}
GROUP BY block""",
)
def src_block_range(spark, sf_dir):
    """Start inclusive, stop exclusive, never before the job's first block."""
    rows = block_range(
        encoded_logs(spark, sf_dir), LEDGER_BLOCK + 25, LEDGER_BLOCK + 75, FIRST_BLOCK
    )
    return rows.groupBy("block").agg(F.count(F.lit(1)).alias("logs"))


SOURCE_SQL = (
    "CASE kind " + " ".join(f"WHEN '{s.kind}' THEN '{s.source}'" for s in SIGNATURES) + " END"
)
START_SQL = (
    f"CASE {SOURCE_SQL} "
    + " ".join(f"WHEN '{s.name}' THEN {s.start_block}" for s in REGISTRY)
    + " END"
)
DIRTY_SQL = (
    LEDGER_SQL
    + f""", B AS (SELECT * EXCLUDE (block), {DIRTY_BLOCK} + (event_id // 10) * {DIRTY_STRIDE}
  AS block, {SOURCE_SQL} AS source, {START_SQL} AS start_block FROM L)
"""
)


@query(
    "route_sources",
    DIRTY_SQL
    + "SELECT block, slot AS log_index, source FROM B WHERE k % 25 <> 8 AND block >= start_block",
)
def route_sources(spark, sf_dir):
    """Known addresses, each from its start block."""
    return D.route(encoded_logs(spark, sf_dir, dirty=True)).select(
        "block", "log_index", "source"
    )


@query(
    "match_signature",
    DIRTY_SQL
    + """SELECT block, slot AS log_index, source, CASE WHEN k % 25 <> 7 THEN kind END AS kind
FROM B WHERE k % 25 <> 8 AND block >= start_block""",
)
def match_signature(spark, sf_dir):
    """Topic, arity and exact data length."""
    routed = D.route(encoded_logs(spark, sf_dir, dirty=True))
    return D.match_kind(routed).select("block", "log_index", "source", "kind")


@query(
    "drop_malformed",
    DIRTY_SQL
    + "SELECT block, slot AS log_index, CASE WHEN k % 25 = 8 THEN 'unknown source'"
    " WHEN block < start_block THEN 'not started' ELSE 'no signature' END AS reason FROM B"
    " WHERE k % 25 IN (7, 8) OR block < start_block",
)
def drop_malformed(spark, sf_dir):
    """Everything that gives no event, and why."""
    return D.rejected_logs(encoded_logs(spark, sf_dir, dirty=True)).select(
        "block", "log_index", "reason"
    )


@query(
    "decode_initialize",
    LEDGER_SQL
    + f"""SELECT block, ordinal, {POOL_KEY_SQL} AS pool, {key_sql('k')} AS currency0,
  {key_sql('cents % 300 + 1')} AS currency1, cents AS fee, k - 50 AS tick_spacing,
  {key_sql('pool + 1')} AS hooks, {PRICE_SQL} AS price, tick
FROM L WHERE kind = 'Initialize'""",
)
def decode_initialize(spark, sf_dir):
    return decoded(
        spark, sf_dir, "Initialize", *keys("pool", "currency0", "currency1"), "fee",
        "tick_spacing", *keys("hooks"), *text("price"), "tick",
    )


@query(
    "decode_modify",
    LEDGER_SQL
    + f"""SELECT block, ordinal, {POOL_KEY_SQL} AS pool, {key_sql('pool + 1')} AS sender,
  lower, upper, CAST(delta AS VARCHAR) AS delta, {key_sql('event_id', 64)} AS salt
FROM L WHERE kind = 'ModifyLiquidity'""",
)
def decode_modify(spark, sf_dir):
    return decoded(
        spark, sf_dir, "ModifyLiquidity", *keys("pool", "sender"), "lower", "upper",
        *text("delta"), *keys("salt"),
    )


@query(
    "decode_swap",
    LEDGER_SQL
    + f"""SELECT block, ordinal, {POOL_KEY_SQL} AS pool, {key_sql('pool + 1')} AS sender,
  CAST({AMOUNT0_SQL} AS VARCHAR) AS amount0,
  CAST(-({AMOUNT0_SQL}) * (k + 1) AS VARCHAR) AS amount1, {PRICE_SQL} AS price,
  CAST(liquidity AS VARCHAR) AS liquidity, tick, k AS fee
FROM L WHERE kind = 'Swap'""",
)
def decode_swap(spark, sf_dir):
    return decoded(
        spark, sf_dir, "Swap", *keys("pool", "sender"),
        *text("amount0", "amount1", "price", "liquidity"), "tick", "fee",
    )


@query(
    "decode_subscription",
    LEDGER_SQL
    + f"""SELECT block, ordinal, kind, CAST(event_id AS VARCHAR) AS token_id,
  {key_sql('pool + 1')} AS subscriber
FROM L WHERE kind IN ('Subscription', 'Unsubscription')""",
)
def decode_subscription(spark, sf_dir):
    rows = D.decode(encoded_logs(spark, sf_dir))
    return rows.where(F.col("kind").isin("Subscription", "Unsubscription")).selectExpr(
        "block", "ordinal", "kind", f"{W.unsigned_word_text('token_id')} AS token_id",
        *keys("subscriber"),
    )


@query(
    "decode_transfer",
    LEDGER_SQL
    + f"""SELECT block, ordinal, {key_sql('pool + 1')} AS from_address,
  {key_sql('k + 1')} AS to_address, CAST(event_id AS VARCHAR) AS token_id
FROM L WHERE kind = 'Transfer'""",
)
def decode_transfer(spark, sf_dir):
    return decoded(
        spark, sf_dir, "Transfer", *keys("from_address", "to_address"),
        f"{W.unsigned_word_text('token_id')} AS token_id",
    )


@query(
    "decode_hook",
    LEDGER_SQL
    + f"""SELECT block, ordinal, {key_sql('pool + 1')} AS hook, {key_sql('k + 1')} AS module,
  {key_sql('event_id', 64)} AS salt
FROM L WHERE kind = 'LogCreatePrivateHook'""",
)
def decode_hook(spark, sf_dir):
    return decoded(
        spark, sf_dir, "LogCreatePrivateHook", *keys("hook", "module", "salt")
    )


@query(
    "event_envelope",
    LEDGER_SQL
    + f"""SELECT block AS number, {key_sql('block', 64)} AS hash,
  CASE WHEN block % 13 = 0 THEN '0x' ELSE {key_sql('block - 1', 64)} END AS parent_hash,
  CASE WHEN block % 13 = 0 THEN 0 ELSE block * 2 END AS timestamp_seconds,
  slot // 4 AS tx_index, {key_sql('block * 10 + slot // 4', 64)} AS tx_hash,
  {key_sql('block * 10 + slot // 4')} AS origin, {key_sql('1')} AS recipient,
  CASE WHEN block % 3 = 0 THEN '0' ELSE CAST(block AS VARCHAR) END AS gas_price,
  slot % 4 AS tx_log_index, slot AS trigger_order, ordinal, {SOURCE_SQL} AS source, kind
FROM L""",
)
def event_envelope(spark, sf_dir):
    """Block, transaction and log references; a missing header gives zeros."""
    bare = "block % 13 = 0"
    logs = with_sql(
        encoded_logs(spark, sf_dir),
        {c: f"IF({bare}, NULL, {c})" for c in ("parent_hash", "seconds", "nanos")},
    )
    return D.to_events(D.decode(logs)).selectExpr(
        "block_ref.number",
        f"{W.hex_key('block_ref.hash')} AS hash",
        f"{W.hex_key('block_ref.parent_hash')} AS parent_hash",
        "block_ref.timestamp_seconds",
        "transaction_ref.index AS tx_index",
        f"{W.hex_key('transaction_ref.hash')} AS tx_hash",
        f"{W.hex_key('transaction_ref.origin')} AS origin",
        f"{W.hex_key('transaction_ref.to')} AS recipient",
        "transaction_ref.gas_price",
        "log_ref.transaction_log_index AS tx_log_index",
        "log_ref.trigger_order",
        "log_ref.ordinal",
        "source",
        "kind",
    )


@query(
    "word_to_int",
    LEDGER_SQL
    + """SELECT event_id, delta, lower, upper, tick,
  CAST(CAST(delta AS HUGEINT) * 18446744073709551616 AS VARCHAR) AS wide,
  delta IS NULL OR delta BETWEEN -32768 AND 32767 AS fits_16
FROM L""",
)
def word_to_int(spark, sf_dir):
    """Integers to words and back at 24, 64 and more bits, sign kept."""
    from tallyline.plans.state import widen

    rows = with_sql(
        ledger(spark, sf_dir),
        {f"{c}_w": W.bigint_to_word(c) for c in ("delta", "lower", "upper", "tick")}
        | {"wide_w": widen("delta")},
    )
    return rows.selectExpr(
        "event_id",
        f"{W.word_to_bigint('delta_w')} AS delta",
        *[f"{W.signed_word(f'{c}_w', 24)} AS {c}" for c in ("lower", "upper", "tick")],
        f"{W.word_text('wide_w')} AS wide",
        f"delta IS NULL OR {W.signed_word('delta_w', 16)} IS NOT NULL AS fits_16",
    )


@query(
    "canonical_order",
    LEDGER_SQL
    + """SELECT block, slot AS log_index, slot // 4 AS tx_index, slot % 4 AS tx_log_index, kind,
  CAST(row_number() OVER (PARTITION BY block ORDER BY slot) AS INTEGER) AS event_seq
FROM L""",
)
def canonical_order(spark, sf_dir):
    """Events numbered inside each block, ordered for output."""
    rows = D.canonical_sequence(D.decode(encoded_logs(spark, sf_dir), ["fee", "tick"]))
    return D.canonical_order(rows).select(
        "block", "log_index", "tx_index", "tx_log_index", "kind", "event_seq"
    )


@query(
    "filter_pool_events",
    LEDGER_SQL
    + "SELECT block, ordinal, kind FROM L"
    " WHERE kind IN ('Initialize', 'ModifyLiquidity', 'Swap')",
)
def filter_pool_events(spark, sf_dir):
    return pool_events(ledger(spark, sf_dir)).select("block", "ordinal", "kind")


@query(
    "lenient_parse",
    LEDGER_SQL
    + """SELECT event_id, CAST(CASE k % 4 WHEN 0 THEN cents WHEN 1 THEN -cents
  WHEN 2 THEN CAST(cents AS HUGEINT) * 1267650600228229401496703205376 END AS VARCHAR) AS parsed
FROM L WHERE k % 4 <> 3""",
)
def lenient_parse(spark, sf_dir):
    """Decimal text to exact integers; text that is no integer drops its row."""
    big = "CAST(CAST(cents AS DECIMAL(7,0)) * CAST('1267650600228229401496703205376' AS " \
        "DECIMAL(31,0)) AS STRING)"
    raw = (
        "CASE k % 4 WHEN 0 THEN CAST(cents AS STRING) WHEN 1 THEN concat('-', cents) "
        f"WHEN 2 THEN {big} ELSE concat(cents, '.5') END"
    )
    rows = with_sql(ledger(spark, sf_dir), {"word": W.text_to_word(raw)})
    return rows.where("word IS NOT NULL").selectExpr(
        "event_id", f"{W.word_text('word')} AS parsed"
    )


@query(
    "hex_keys",
    LEDGER_SQL + f"SELECT event_id, {POOL_KEY_SQL} AS pool, {key_sql('pool + 1')} AS owner FROM L",
)
def hex_keys(spark, sf_dir):
    from tallyline.sources.encoded import POOL_WORD, address

    rows = with_sql(ledger(spark, sf_dir), {"id": POOL_WORD, "owner": address("pool + 1")})
    return rows.selectExpr("event_id", f"{W.hex_key('id')} AS pool", *keys("owner"))


@query(
    "composite_keys",
    LEDGER_SQL
    + f"""SELECT event_id, 'gross:' || {POOL_KEY_SQL} || '#' || CAST(lower AS VARCHAR) AS gross_key,
  'net:' || {POOL_KEY_SQL} || '#' || CAST(upper AS VARCHAR) AS net_key,
  '0:' || {POOL_KEY_SQL} AS token0_key, '1:' || {POOL_KEY_SQL} AS token1_key
FROM L WHERE kind = 'ModifyLiquidity'""",
)
def composite_keys(spark, sf_dir):
    """Text keys for output; the folds themselves key on separate columns."""
    from tallyline.sources.encoded import POOL_WORD

    rows = with_sql(
        ledger(spark, sf_dir).where("kind = 'ModifyLiquidity'"), {"id": W.hex_key(POOL_WORD)}
    )
    return rows.selectExpr(
        "event_id", "concat('gross:', id, '#', lower) AS gross_key",
        "concat('net:', id, '#', upper) AS net_key", "concat('0:', id) AS token0_key",
        "concat('1:', id) AS token1_key",
    )


@query(
    "unpivot_tick_ops",
    OPS_SQL
    + "SELECT block, ordinal, CAST(op_seq AS INTEGER) AS op_seq, side, pool, bound, amount FROM O",
)
def unpivot_tick_ops(spark, sf_dir):
    return tick_operations(pool_events(ledger(spark, sf_dir))).select(
        "block", "ordinal", "op_seq", "side", "pool", "bound", "amount"
    )


@query(
    "unpivot_currencies",
    LEDGER_SQL
    + """SELECT block, ordinal, CAST(0 AS INTEGER) AS side, k AS token
FROM L WHERE kind = 'Initialize'
UNION ALL SELECT block, ordinal, 1, cents % 300 + 1 FROM L WHERE kind = 'Initialize'""",
)
def unpivot_currencies(spark, sf_dir):
    inits = D.decode(encoded_logs(spark, sf_dir)).where("kind = 'Initialize'")
    return currencies(inits).selectExpr(
        "block", "ordinal", "side", f"{W.bytes_to_bigint('token', 14, 7)} AS token"
    )


@query(
    "unpivot_tick_ids",
    LEDGER_SQL
    + """SELECT block, ordinal, CAST(0 AS INTEGER) AS position, lower AS bound
FROM L WHERE kind = 'ModifyLiquidity'
UNION ALL SELECT block, ordinal, 1, upper FROM L WHERE kind = 'ModifyLiquidity'""",
)
def unpivot_tick_ids(spark, sf_dir):
    changes = ledger(spark, sf_dir).where("kind = 'ModifyLiquidity'")
    return tick_ids(changes).select("block", "ordinal", "position", "bound")
