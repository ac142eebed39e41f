"""Queries of the lookup family and the enriched ledger itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.functions import words as W
from tallyline.operators import enrich as E
from tallyline.operators import lookup as L
from tallyline.operators.fold import ORDER, SEGMENT, Put, Tally, fold, with_sql
from tallyline.operators.pool_state import pool_states, with_contribution
from tallyline.operators.unpivot import tick_operations
from tallyline.plans.checks import VALUED_SQL, minimal_hex
from tallyline.plans.decode import POOL_KEY_SQL, SOURCE_SQL
from tallyline.plans.registry import ORACLES, query
from tallyline.plans.state import ID, OPS_SQL, POOL_ID, POOL_SQL, pool_ledger, shard_of
from tallyline.plans.values import (
    PRICES_SQL,
    RAW_SQL,
    TOKEN_AMOUNTS_SQL,
    metadata_for,
    segmented_events,
)
from tallyline.sources.ledger import LEDGER_SQL, ledger_segments, segmented_ledger
from tallyline.sources.sinks import write_and_read
from tallyline.sources.stage import new_path, stage


def with_bucket(spark, sf_dir, rows):
    """Block buckets planned from the rows: a fixed number of blocks would make
    more folders and files, of a few rows each, the longer the ledger is."""
    return rows.withColumn("block_bucket", ledger_segments(spark, sf_dir).of())


@query(
    "asof_inclusive",
    POOL_SQL + "SELECT block, ordinal, pool, kind, tick_after AS tick_found FROM T",
)
def asof_inclusive(spark, sf_dir):
    """Latest written tick at or before each pool event, from a separate table."""
    rows = pool_ledger(spark, sf_dir)
    writes = rows.where("tick IS NOT NULL")
    probes = rows.select(*ID, SEGMENT)
    done = L.asof_lookup(writes, probes, ["pool"], "tick", "tick_found")
    return done.select(*ID, "tick_found")


@query(
    "asof_strict",
    POOL_SQL + "SELECT block, ordinal, pool, kind, tick_before AS tick_found FROM T",
)
def asof_strict(spark, sf_dir):
    """Latest written tick strictly before each pool event."""
    rows = pool_ledger(spark, sf_dir)
    writes = rows.where("tick IS NOT NULL")
    probes = rows.select(*ID, SEGMENT)
    done = L.asof_lookup(writes, probes, ["pool"], "tick", "tick_found", inclusive=False)
    return done.select(*ID, "tick_found")


STATE_COLUMNS = [
    f"{s}_{w}" for s in ("tick", "price", "liquidity", "tx_count") for w in ("before", "after")
]


@query(
    "before_after",
    POOL_SQL + f"SELECT block, ordinal, pool, kind, {', '.join(STATE_COLUMNS)} FROM S",
)
def before_after(spark, sf_dir):
    """All four pool states around each event, over one partitioning."""
    return pool_states(pool_ledger(spark, sf_dir)).select(*ID, *STATE_COLUMNS)


@query(
    "in_range_contribution",
    POOL_SQL
    + """SELECT block, ordinal, pool, tick_after AS tick_now, lower, upper, contribution
FROM C WHERE kind = 'ModifyLiquidity'""",
)
def in_range_contribution(spark, sf_dir):
    """What each change adds to pool liquidity: its delta inside the range, else nothing."""
    rows = fold(pool_ledger(spark, sf_dir), ["pool"], [Put("tick", "tick")])
    return (
        with_contribution(rows)
        .where("kind = 'ModifyLiquidity'")
        .selectExpr(
            "block", "ordinal", "pool", "tick_after AS tick_now", "lower", "upper",
            "contribution",
        )
    )


TICK_COLUMNS = [
    f"{side}_{name}" for side in ("lower", "upper") for name in L.TICK_VALUES
]
_TICK_PICKS = ",\n".join(
    f"max(CASE WHEN side = '{kind}' AND op_seq = CASE WHEN lower = upper THEN {seq + 2 - 2 * i} "
    f"ELSE {seq} END THEN value_{w} END) AS {side}_{kind}_{w}"
    for i, side in enumerate(("lower", "upper"))
    for j, kind in enumerate(("gross", "net"))
    for seq in (2 * i + j,)
    for w in ("before", "after")
)
NESTED_TICKS_SQL = (
    OPS_SQL
    + f""", RB AS (SELECT R.*, L.lower, L.upper FROM R JOIN L USING (block, ordinal)),
NT AS (SELECT block, ordinal, {_TICK_PICKS} FROM RB GROUP BY block, ordinal)
"""
)


@query(
    "delta_lookup",
    NESTED_TICKS_SQL
    + f"SELECT block, ordinal, {', '.join(TICK_COLUMNS)}, 0 AS missing FROM NT",
)
def delta_lookup(spark, sf_dir):
    """Both bounds' deltas on each change, with the count of deltas not found."""
    changes = pool_ledger(spark, sf_dir).where("kind = 'ModifyLiquidity'")
    deltas = L.tick_deltas(changes)
    missing = (
        L.missing_deltas(changes, deltas)
        .groupBy("block", "ordinal")
        .agg(F.count(F.lit(1)).cast("int").alias("missing"))
    )
    rows = L.nest_ticks(deltas).join(missing, ["block", "ordinal"], "left")
    return rows.selectExpr(
        "block", "ordinal", *TICK_COLUMNS, "coalesce(missing, 0) AS missing"
    )


PARTITION_SQL = """CASE WHEN kind IN ('Initialize', 'ModifyLiquidity', 'Swap')
  THEN CAST(('0x' || substr(md5(CAST(pool AS VARCHAR)), 1, 2)) AS BIGINT) % 64 // 16
  ELSE 0 END"""


def partition_of(pool_id: str) -> str:
    """Four partitions of 16 shards; events without a pool go to the first."""
    return f"coalesce({shard_of(pool_id)} div 16, 0L)"


@query(
    "partition_reassemble",
    POOL_SQL
    + f"""SELECT L.block, L.ordinal, {PARTITION_SQL.replace('kind', 'L.kind').replace('pool', 'L.pool')}
  AS partition, tick_after, 'ok' AS status
FROM L LEFT JOIN T USING (event_id)""",
)
def partition_reassemble(spark, sf_dir):
    """Partition outputs put back in event order, with missing and extra events named.

    The partition is a column, so all four share one scan and one exchange.
    """
    pool_id = (
        f"IF(kind IN ('Initialize', 'ModifyLiquidity', 'Swap'), {POOL_ID}, NULL)"
    )
    rows = with_sql(segmented_ledger(spark, sf_dir), {"partition": partition_of(pool_id)})
    is_pool = F.col("kind").isin("Initialize", "ModifyLiquidity", "Swap")
    states = fold(rows.where(is_pool), ["partition", "pool"], [Put("tick", "tick")])
    outputs = states.select("block", "ordinal", "partition", "tick_after").unionByName(
        rows.where(~is_pool).select("block", "ordinal", "partition"),
        allowMissingColumns=True,
    )
    expected = rows.select("block", "ordinal", F.col("partition").alias("expected"))
    status = (
        "CASE WHEN partition IS NULL THEN 'missing' WHEN expected IS NULL THEN 'extra' "
        "WHEN partition <> expected THEN 'misplaced' ELSE 'ok' END AS status"
    )
    joined = outputs.join(expected, ["block", "ordinal"], "full_outer")
    return joined.selectExpr(
        "block", "ordinal", "partition", "tick_after", status
    ).orderBy("block", "ordinal")


def staged_events(spark, sf_dir):
    """Decoded events as a stage table: every later step scans it pruned."""
    return stage(segmented_events(spark, sf_dir), "events")


HEX_STATES = ["tick", "price", "liquidity", "tx_count"]


def _hex_sql(name: str) -> str:
    if name.startswith("price"):
        # price * 2^80: the same leading bytes, then ten zero bytes.
        return f"CASE WHEN {name} IS NULL THEN '' ELSE {minimal_hex(name)} || repeat('00', 10) END"
    return minimal_hex(name)


ENRICHED_SQL = (
    VALUED_SQL
    + ", "
    + NESTED_TICKS_SQL[NESTED_TICKS_SQL.index("O AS (") :].strip()
    + f""",
Z AS (SELECT *, {RAW_SQL} FROM V),
ZZ AS (
  SELECT event_id, {", ".join(f"{_hex_sql(c)} AS {c}" for c in STATE_COLUMNS)},
    CAST(raw0 AS VARCHAR) AS amount0_raw, CAST(raw1 AS VARCHAR) AS amount1_raw,
    {TOKEN_AMOUNTS_SQL}
  FROM Z),
{PRICES_SQL},
MM AS (
  SELECT event_id, max(CASE WHEN side = 0 THEN symbol END) AS symbol0,
         max(CASE WHEN side = 1 THEN symbol END) AS symbol1,
         max(CASE WHEN side = 0 THEN decimals END) AS decimals0,
         max(CASE WHEN side = 1 THEN decimals END) AS decimals1
  FROM M GROUP BY event_id)
"""
)


@query(
    "enriched_ledger",
    ENRICHED_SQL
    + f"""SELECT L.block, L.ordinal, L.kind, {SOURCE_SQL.replace('kind', 'L.kind')} AS source,
  CASE WHEN L.kind IN ('Initialize', 'ModifyLiquidity', 'Swap')
    THEN {POOL_KEY_SQL.replace('pool', 'L.pool')} END AS pool,
  {", ".join(f"coalesce({c}, '') AS {c}" for c in STATE_COLUMNS)},
  {", ".join(f"{minimal_hex(c)} AS {c}" for c in TICK_COLUMNS)},
  amount0_raw, amount1_raw, token_amount0, token_amount1,
  coalesce(price0, '') AS price0, coalesce(price1, '') AS price1,
  symbol0, symbol1, decimals0, decimals1, CAST(3 AS INTEGER) AS state_version
FROM L LEFT JOIN ZZ USING (event_id) LEFT JOIN NT ON NT.block = L.block AND NT.ordinal = L.ordinal
  LEFT JOIN MM USING (event_id) LEFT JOIN prices USING (event_id)""",
)
def enriched_ledger(spark, sf_dir):
    """Flagship: raw logs to one enriched row per event.

    Two stage tables: the decoded events, and the tokens of the Initialize rows.
    """
    return shown(enriched_rows(spark, sf_dir))


def enriched_rows(spark, sf_dir):
    events = staged_events(spark, sf_dir)
    tokens = stage(
        E.initialize_tokens(events, metadata_for(spark, sf_dir, events)), "tokens"
    )
    return E.enriched_ledger(events, tokens)


def shown(rows):
    """The columns that the check compares, bytes as hex and amounts as text."""
    return rows.selectExpr(
        "block", "ordinal", "kind", "source", f"{W.hex_key('pool')} AS pool",
        *[f"coalesce(lower(hex({c})), '') AS {c}" for c in (*STATE_COLUMNS, *TICK_COLUMNS)],
        *[f"{W.word_text(W.signed_bytes_to_word(f'raw{i}'))} AS amount{i}_raw" for i in (0, 1)],
        "token_amount0", "token_amount1",
        *[f"coalesce(token{i}_price_after, '') AS price{i}" for i in (0, 1)],
        "symbol0", "symbol1", "decimals0", "decimals1", "state_version",
    )


@query("sink_reducer_inputs", ORACLES["enriched_ledger"])
def sink_reducer_inputs(spark, sf_dir):
    """Nested enriched records written in block buckets, read back and flattened."""
    records = with_bucket(spark, sf_dir, E.enriched_records(enriched_rows(spark, sf_dir)))
    back = write_and_read(records, new_path(spark, "reducer-inputs"), "block_bucket")
    flat = back.selectExpr(
        "block_ref.number AS block", "log_ref.ordinal AS ordinal", "kind", "source",
        "pool.pool_id AS pool",
        *[f"pool.{c} AS {c}" for c in STATE_COLUMNS],
        *[
            f"ticks[{i}].{name} AS {side}_{name}"
            for i, side in enumerate(("lower", "upper"))
            for name in L.TICK_VALUES
        ],
        "position_amounts.*", "token_amounts.*",
        *[f"coalesce(pool.token{i}_price_after, '') AS token{i}_price_after" for i in (0, 1)],
        *[f"initialize.token{i}_metadata.symbol AS symbol{i}" for i in (0, 1)],
        *[f"CAST(initialize.token{i}_metadata.decimals AS BIGINT) AS decimals{i}" for i in (0, 1)],
        "state_version",
    )
    return shown(flat)


@query(
    "tick_only_ledger",
    NESTED_TICKS_SQL
    + f"""SELECT L.block, L.ordinal, L.kind,
  {", ".join(f"{minimal_hex(c)} AS {c}" for c in TICK_COLUMNS)},
  CAST(0 AS INTEGER) AS state_version
FROM L LEFT JOIN NT ON NT.block = L.block AND NT.ordinal = L.ordinal""",
)
def tick_only_ledger(spark, sf_dir):
    """Events with tick liquidity before and after only."""
    rows = E.tick_only_ledger(staged_events(spark, sf_dir))
    return rows.selectExpr(
        "block", "ordinal", "kind",
        *[f"coalesce(lower(hex({c})), '') AS {c}" for c in TICK_COLUMNS], "state_version",
    )


@query(
    "state_probe",
    POOL_SQL
    + OPS_SQL[len(LEDGER_SQL) :].rstrip()
    + """
SELECT 'pool' AS record, block, ordinal, CAST(0 AS INTEGER) AS seq, CAST(pool AS VARCHAR) AS key,
  coalesce(CAST(tick_after AS VARCHAR), '') AS tick,
  coalesce(CAST(liquidity_after AS VARCHAR), '') AS liquidity,
  coalesce(CAST(tx_count_after AS VARCHAR), '') AS tx_count,
  NULL AS old_value, NULL AS new_value, CAST(NULL AS INTEGER) AS operation
FROM S
UNION ALL
SELECT 'tick', block, ordinal, CAST(op_seq AS INTEGER),
  side || ':' || CAST(pool AS VARCHAR) || '#' || CAST(bound AS VARCHAR), NULL, NULL, NULL,
  CAST(coalesce(value_before, 0) AS VARCHAR), CAST(value_after AS VARCHAR),
  CAST(CASE WHEN write_no = 1 THEN 1 ELSE 2 END AS INTEGER)
FROM R""",
)
def state_probe(spark, sf_dir):
    """Pool states as text (empty when absent) and every tick delta, in one table."""
    rows = pool_ledger(spark, sf_dir)
    pools = pool_states(rows, puts=[Put("tick", "tick")]).selectExpr(
        "'pool' AS record", "block", "ordinal", "0 AS seq", "CAST(pool AS STRING) AS key",
        "coalesce(CAST(tick_after AS STRING), '') AS tick",
        "coalesce(CAST(liquidity_after AS STRING), '') AS liquidity",
        "coalesce(CAST(tx_count_after AS STRING), '') AS tx_count",
    )
    ops = fold(
        tick_operations(rows), ["side", "pool", "bound"], [Tally("value", "amount")],
        [*ORDER, "op_seq"],
    ).selectExpr(
        "'tick' AS record", "block", "ordinal", "op_seq AS seq",
        "concat(side, ':', pool, '#', bound) AS key",
        "CAST(coalesce(value_before, 0) AS STRING) AS old_value",
        "CAST(value_after AS STRING) AS new_value",
        "IF(value_before IS NULL, 1, 2) AS operation",
    )
    return pools.unionByName(ops, allowMissingColumns=True)


@query("sink_state_probe", ORACLES["state_probe"])
def sink_state_probe(spark, sf_dir):
    """The state probe written in block buckets and read back."""
    rows = with_bucket(spark, sf_dir, state_probe(spark, sf_dir))
    return write_and_read(rows, new_path(spark, "state-probe"), "block_bucket").drop("block_bucket")
