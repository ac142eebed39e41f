"""Queries of the running-state and snapshot families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions import words as W
from tallyline.functions.segments import block_span
from tallyline.operators import snapshot as S
from tallyline.operators.fold import ORDER, SEGMENT, Narrow, Put, Tally, Wide, fold
from tallyline.operators.pool_state import (
    continue_pool_states,
    pool_events,
    pool_snapshot,
    pool_states,
    with_contribution,
    with_count,
)
from tallyline.operators.state_index import StateIndex
from tallyline.operators.unpivot import tick_operations
from tallyline.plans.registry import query
from tallyline.sources.ledger import (
    LEDGER_SQL,
    ledger,
    ledger_blocks,
    segmented_ledger,
)
from tallyline.sources.stage import new_path, stage

ID = ["block", "ordinal", "pool", "kind"]

POOL_SQL = (
    LEDGER_SQL
    + """,
P AS (SELECT *, CASE WHEN kind IN ('Swap', 'ModifyLiquidity') THEN 1 END AS touch
      FROM L WHERE kind IN ('Initialize', 'ModifyLiquidity', 'Swap')),
T AS (
  SELECT *, last_value(tick IGNORE NULLS) OVER w AS tick_after,
         last_value(tick IGNORE NULLS) OVER b AS tick_before,
         last_value(price IGNORE NULLS) OVER w AS price_after,
         last_value(price IGNORE NULLS) OVER b AS price_before,
         CAST(sum(touch) OVER w AS BIGINT) AS tx_count_after,
         CAST(sum(touch) OVER b AS BIGINT) AS tx_count_before,
         count(liquidity) OVER w AS run
  FROM P
  WINDOW w AS (PARTITION BY pool ORDER BY block, ordinal
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         b AS (PARTITION BY pool ORDER BY block, ordinal
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
C AS (
  SELECT *, CASE WHEN lower <= tick_after AND tick_after < upper THEN delta END AS contribution
  FROM T),
Q AS (
  SELECT *, CAST(sum(coalesce(liquidity, contribution)) OVER (
           PARTITION BY pool, run ORDER BY block, ordinal
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS liquidity_after
  FROM C),
S AS (
  SELECT *, lag(liquidity_after) OVER (PARTITION BY pool ORDER BY block, ordinal)
           AS liquidity_before
  FROM Q)
"""
)

OPS_SQL = (
    LEDGER_SQL
    + """,
O AS (
  SELECT block, ordinal, pool, 0 AS op_seq, 'gross' AS side, lower AS bound, delta AS amount
  FROM L WHERE kind = 'ModifyLiquidity'
  UNION ALL SELECT block, ordinal, pool, 1, 'net', lower, delta
  FROM L WHERE kind = 'ModifyLiquidity'
  UNION ALL SELECT block, ordinal, pool, 2, 'gross', upper, delta
  FROM L WHERE kind = 'ModifyLiquidity'
  UNION ALL SELECT block, ordinal, pool, 3, 'net', upper, -delta
  FROM L WHERE kind = 'ModifyLiquidity'),
R AS (
  SELECT *, CAST(sum(amount) OVER w AS BIGINT) AS value_after,
         CAST(sum(amount) OVER b AS BIGINT) AS value_before,
         row_number() OVER w AS write_no
  FROM O
  WINDOW w AS (PARTITION BY side, pool, bound ORDER BY block, ordinal, op_seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         b AS (PARTITION BY side, pool, bound ORDER BY block, ordinal, op_seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
"""
)


def pool_ledger(spark, sf_dir) -> DataFrame:
    return pool_events(segmented_ledger(spark, sf_dir))


@query(
    "state_set_last",
    POOL_SQL + "SELECT block, ordinal, pool, kind, tick_before, tick_after FROM T",
)
def state_set_last(spark, sf_dir):
    """SET: pool tick before and after each pool event."""
    done = fold(pool_ledger(spark, sf_dir), ["pool"], [Put("tick", "tick")])
    return done.select(*ID, "tick_before", "tick_after")


@query(
    "state_add_count",
    POOL_SQL + "SELECT block, ordinal, pool, kind, tx_count_before, tx_count_after FROM T",
)
def state_add_count(spark, sf_dir):
    """ADD: transactions per pool; absent until the first one."""
    done = fold(
        with_count(pool_ledger(spark, sf_dir)), ["pool"], [Tally("tx_count", "touch")]
    )
    return done.select(*ID, "tx_count_before", "tx_count_after")


def _tick_ops(spark, sf_dir):
    return tick_operations(pool_ledger(spark, sf_dir))


@query(
    "state_add_liquidity",
    OPS_SQL + "SELECT block, ordinal, CAST(op_seq AS INTEGER) AS op_seq, side, pool, bound,"
    " amount, value_before, value_after FROM R",
)
def state_add_liquidity(spark, sf_dir):
    """ADD: signed liquidity per (side, pool, tick)."""
    done = fold(
        _tick_ops(spark, sf_dir),
        ["side", "pool", "bound"],
        [Tally("value", "amount")],
        [*ORDER, "op_seq"],
    )
    return done.select(
        "block", "ordinal", "op_seq", "side", "pool", "bound", "amount",
        "value_before", "value_after",
    )


def widen(c: str) -> str:
    """A BIGINT times 2^64, as a word."""
    return f"unhex(concat(substring(hex({W.bigint_to_word(c)}), 17, 48), '{'0' * 16}'))"


@query(
    "state_add_wide",
    OPS_SQL
    + """SELECT block, ordinal, CAST(op_seq AS INTEGER) AS op_seq, side, pool, bound,
  CAST(CAST(value_before AS HUGEINT) * 18446744073709551616 AS VARCHAR) AS value_before,
  CAST(CAST(value_after AS HUGEINT) * 18446744073709551616 AS VARCHAR) AS value_after
FROM R""",
)
def state_add_wide(spark, sf_dir):
    """ADD on values beyond 64 bits, summed limb by limb."""
    rows = pool_ledger(spark, sf_dir).withColumn("delta", F.expr(widen("delta")))
    done = fold(
        tick_operations(rows, Wide),
        ["side", "pool", "bound"],
        [Tally("value", "amount", Wide)],
        [*ORDER, "op_seq"],
    )
    return done.select(
        "block", "ordinal", "op_seq", "side", "pool", "bound",
        F.expr(W.word_text("value_before")).alias("value_before"),
        F.expr(W.word_text("value_after")).alias("value_after"),
    )


def shard_of(pool_id: str, shards: int = 64) -> str:
    """First id byte modulo the shard count; an empty id goes to shard 0."""
    return f"IF(octet_length({pool_id}) > 0, {W.bytes_to_bigint(pool_id, 1, 1)} % {shards}, 0L)"


POOL_ID = "unhex(md5(CAST(CAST(pool AS STRING) AS BINARY)))"


@query(
    "state_add_sharded",
    OPS_SQL
    + """SELECT CAST(('0x' || substr(md5(CAST(pool AS VARCHAR)), 1, 2)) AS BIGINT) % 64 AS shard,
  block, ordinal, CAST(op_seq AS INTEGER) AS op_seq, side, pool, bound, value_after FROM R""",
)
def state_add_sharded(spark, sf_dir):
    """ADD routed by shard: the shard joins the key and changes no value."""
    ops = _tick_ops(spark, sf_dir).withColumn("shard", F.expr(shard_of(POOL_ID)))
    done = fold(
        ops, ["shard", "side", "pool", "bound"], [Tally("value", "amount")], [*ORDER, "op_seq"]
    )
    return done.select(
        "shard", "block", "ordinal", "op_seq", "side", "pool", "bound", "value_after"
    )


@query(
    "state_set_sum",
    POOL_SQL + "SELECT block, ordinal, pool, kind, liquidity_before, liquidity_after FROM S",
)
def state_set_sum(spark, sf_dir):
    """SET_SUM: pool liquidity, reset by prices and moved by in-range changes."""
    return pool_states(pool_ledger(spark, sf_dir), puts=[Put("tick", "tick")]).select(
        *ID, "liquidity_before", "liquidity_after"
    )


@query(
    "state_set_price",
    POOL_SQL
    + """, X AS (SELECT block, ordinal, pool, kind,
  CASE WHEN k % 10 <> 3 THEN price END AS parsed FROM P)
SELECT block, ordinal, pool, kind,
  CAST(last_value(parsed IGNORE NULLS) OVER b AS VARCHAR) AS price_before,
  CAST(last_value(parsed IGNORE NULLS) OVER w AS VARCHAR) AS price_after
FROM X
WINDOW w AS (PARTITION BY pool ORDER BY block, ordinal
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       b AS (PARTITION BY pool ORDER BY block, ordinal
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def state_set_price(spark, sf_dir):
    """SET from decimal text; text that is no integer writes nothing."""
    text = "IF(k % 10 = 3, 'n/a', CAST(price AS STRING))"
    rows = pool_ledger(spark, sf_dir).withColumn("word", F.expr(W.text_to_word(text)))
    done = fold(rows, ["pool"], [Put("price", "word", Wide)])
    return done.drop("price").select(
        *ID,
        F.expr(W.word_text("price_before")).alias("price_before"),
        F.expr(W.word_text("price_after")).alias("price_after"),
    )


@query(
    "state_deltas",
    OPS_SQL
    + """SELECT block, ordinal, CAST(op_seq AS INTEGER) AS op_seq,
  side || ':' || CAST(pool AS VARCHAR) || '#' || CAST(bound AS VARCHAR) AS key,
  coalesce(value_before, 0) AS old_value, value_after AS new_value,
  CAST(CASE WHEN write_no = 1 THEN 1 ELSE 2 END AS INTEGER) AS operation FROM R""",
)
def state_deltas(spark, sf_dir):
    """One row per write: old value (0 when absent), new value, create or update."""
    done = fold(
        _tick_ops(spark, sf_dir),
        ["side", "pool", "bound"],
        [Tally("value", "amount")],
        [*ORDER, "op_seq"],
    )
    return done.select(
        "block", "ordinal", "op_seq",
        F.concat(
            "side", F.lit(":"), F.col("pool").cast("string"),
            F.lit("#"), F.col("bound").cast("string"),
        ).alias("key"),
        F.coalesce("value_before", F.lit(0).cast("bigint")).alias("old_value"),
        F.col("value_after").alias("new_value"),
        F.when(F.col("value_before").isNull(), 1).otherwise(2).alias("operation"),
    )


@query(
    "snap_set",
    POOL_SQL + "SELECT pool, arg_max(tick, event_id) AS tick FROM P"
    " WHERE tick IS NOT NULL GROUP BY pool",
)
def snap_set(spark, sf_dir):
    """SET snapshot: map-side max_by, no window."""
    return S.snapshot_set(ledger(spark, sf_dir), ["pool"], "tick")


@query(
    "snap_add",
    OPS_SQL + "SELECT side, pool, bound, CAST(sum(amount) AS BIGINT) AS total"
    " FROM O GROUP BY side, pool, bound",
)
def snap_add(spark, sf_dir):
    """ADD snapshot: map-side sum, no window."""
    ops = tick_operations(pool_events(ledger(spark, sf_dir)))
    return S.snapshot_add(ops, ["side", "pool", "bound"], "amount", "total")


def _contributions(spark, sf_dir):
    return with_contribution(
        fold(pool_ledger(spark, sf_dir), ["pool"], [Put("tick", "tick")])
    )


SNAP_SET_SUM = (
    POOL_SQL
    + """SELECT pool, arg_max(liquidity_after, event_id) AS liquidity FROM S
WHERE liquidity_after IS NOT NULL GROUP BY pool"""
)


@query("snap_set_sum", SNAP_SET_SUM)
def snap_set_sum(spark, sf_dir):
    """SET_SUM snapshot: last set plus what was added after it."""
    partials = S.set_sum_partials(
        _contributions(spark, sf_dir), ["pool"], "liquidity", "contribution"
    )
    return S.merge_set_sum(partials, ["pool"], "liquidity")


@query(
    "merge_partials",
    POOL_SQL
    + """SELECT pool, arg_max(tick_after, event_id) AS tick,
  arg_max(tx_count_after, event_id) AS tx_count,
  arg_max(liquidity_after, event_id) AS liquidity
FROM S GROUP BY pool""",
)
def merge_partials(spark, sf_dir):
    """Segments folded apart, then merged by each policy's rule."""
    rows = with_count(_contributions(spark, sf_dir))
    simple = rows.groupBy("pool", SEGMENT).agg(
        S.last_value("tick").alias("tick"), F.sum("touch").alias("touch")
    )
    merged = simple.groupBy("pool").agg(
        F.max_by("tick", F.when(F.col("tick").isNotNull(), F.col(SEGMENT))).alias("tick"),
        F.sum("touch").alias("tx_count"),
    )
    partials = S.set_sum_partials(rows, ["pool"], "liquidity", "contribution")
    return merged.join(S.merge_set_sum(partials, ["pool"], "liquidity"), "pool", "left")


@query(
    "seed_continue",
    POOL_SQL
    + "SELECT block, ordinal, pool, kind, tick_after, tx_count_after, liquidity_after FROM S",
)
def seed_continue(spark, sf_dir):
    """State through a seed block, then the rest continued from its snapshot."""
    low, high, _ = block_span(ledger_blocks(spark, sf_dir))
    seed_block = (low + high) // 2
    rows = pool_ledger(spark, sf_dir)
    head = rows.where(F.col("block") <= seed_block)
    tail = rows.where(F.col("block") > seed_block)
    out = [*ID, "tick_after", "tx_count_after", "liquidity_after"]
    first = stage(pool_states(head, puts=[Put("tick", "tick")]).select(*out), "head")
    snapshot = stage(pool_snapshot(first), "snapshot")
    rest = S.drop_seed(continue_pool_states(tail, snapshot, seed_block))
    return first.select(*out).unionByName(rest.select(*out))


@query(
    "state_at",
    POOL_SQL
    + """, PR AS (SELECT DISTINCT pool, block - 7 AS block FROM P),
EN AS (SELECT * FROM S QUALIFY row_number() OVER (PARTITION BY pool, block ORDER BY ordinal DESC) = 1)
SELECT PR.pool, PR.block, tick_after AS tick, price_after AS price, tx_count_after AS tx_count,
  liquidity_after AS liquidity
FROM PR ASOF LEFT JOIN EN ON PR.pool = EN.pool AND PR.block >= EN.block""",
)
def state_at(spark, sf_dir):
    """All pool states seven blocks before every pool event, from the point-in-time index."""
    rows = pool_ledger(spark, sf_dir)
    values = {"tick": Narrow, "price": Narrow, "tx_count": Narrow, "liquidity": Narrow}
    index = StateIndex(new_path(spark, "state-index"), {"pool": "BIGINT"}, values, width=50)
    states = pool_states(rows).select("pool", *ORDER, *(f"{v}_after" for v in values))
    index.write(stage(states, "indexed-states"))
    return index.at(rows.select("pool", F.expr("block - 7 AS block")).distinct())
