"""Queries of the streaming family."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.functions.segments import block_span
from tallyline.operators.decode import decode
from tallyline.operators.pool_state import pool_events
from tallyline.plans.decode import SOURCE_SQL
from tallyline.plans.enriched import shown
from tallyline.plans.registry import ORACLES, query
from tallyline.plans.state import ID, POOL_SQL, SNAP_SET_SUM
from tallyline.plans.values import metadata_for
from tallyline.sources.encoded import encoded_logs
from tallyline.sources.ledger import LEDGER_SQL, ledger, ledger_blocks
from tallyline.sources.stage import new_path
from tallyline.streaming import jobs as J
from tallyline.streaming.enriched import EnrichedJob

RANGES = 3


def thirds(spark, sf_dir):
    """The ledger's block range cut in three, as predicates."""
    low, high, _ = block_span(ledger_blocks(spark, sf_dir))
    width = -(-(high - low + 1) // RANGES)
    return [
        (F.col("block") >= low + i * width) & (F.col("block") < low + (i + 1) * width)
        for i in range(RANGES)
    ]


@query(
    "stream_decode",
    LEDGER_SQL + f"SELECT block, ordinal, {SOURCE_SQL} AS source, kind, tick FROM L",
)
def stream_decode(spark, sf_dir):
    """The batch decode on a stream of landed ranges; appends exactly once."""
    root = new_path(spark, "stream-decode")
    for part in thirds(spark, sf_dir):
        logs = encoded_logs(spark, sf_dir, part=part)
        J.land(logs, f"{root}/landing")
        source = J.landed(spark, f"{root}/landing", logs.schema)
        decoded = decode(source, ["fee", "tick"]).select(
            "block", "ordinal", "source", "kind", "tick"
        )
        J.append_available(decoded, f"{root}/checkpoint", f"{root}/events")
    return spark.read.parquet(f"{root}/events")


def pool_state_job(spark, sf_dir, order=range(RANGES)):
    rows = pool_events(ledger(spark, sf_dir))
    root = new_path(spark, "stream-state")
    job = J.PoolStateJob(spark, root, rows.schema)
    parts = thirds(spark, sf_dir)
    for i in order:
        J.land(rows.where(parts[i]), f"{root}/landing")
        source = J.landed(spark, f"{root}/landing", rows.schema)
        J.run_available(source, f"{root}/checkpoint", job.process)
    return job


@query(
    "stream_state_add",
    POOL_SQL + "SELECT block, ordinal, pool, kind, tx_count_before, tx_count_after FROM T",
)
def stream_state_add(spark, sf_dir):
    """ADD continued over three ranges equals the one-pass fold."""
    return pool_state_job(spark, sf_dir).rows(RANGES).select(
        *ID, "tx_count_before", "tx_count_after"
    )


@query(
    "stream_state_set_sum",
    POOL_SQL + "SELECT block, ordinal, pool, kind, liquidity_before, liquidity_after FROM S",
)
def stream_state_set_sum(spark, sf_dir):
    """SET_SUM continued over three ranges equals the one-pass fold."""
    return pool_state_job(spark, sf_dir).rows(RANGES).select(
        *ID, "liquidity_before", "liquidity_after"
    )


@query("stream_snapshot_merge", SNAP_SET_SUM)
def stream_snapshot_merge(spark, sf_dir):
    """The last snapshot version equals the batch snapshot."""
    job = pool_state_job(spark, sf_dir)
    return job.snapshot(RANGES - 1).where("liquidity IS NOT NULL").select("pool", "liquidity")


@query(
    "late_ranges",
    LEDGER_SQL
    + """, W AS (SELECT min(block) AS lo, (max(block) - min(block) + 3) // 3 AS width FROM L)
SELECT block, ordinal, pool, kind FROM L, W
WHERE kind IN ('Initialize', 'ModifyLiquidity', 'Swap')
  AND block >= lo + width AND block < lo + 2 * width""",
)
def late_ranges(spark, sf_dir):
    """A range that lands after a later one goes to the side table."""
    return pool_state_job(spark, sf_dir, order=(0, 2, 1)).late(RANGES).select(*ID)


@query(
    "stream_totals",
    POOL_SQL + "SELECT pool, count(touch) AS tx_count FROM P GROUP BY pool HAVING count(touch) > 0",
)
def stream_totals(spark, sf_dir):
    """ADD totals by streaming aggregation with partial sums before the shuffle."""
    rows = pool_events(ledger(spark, sf_dir))
    root = new_path(spark, "stream-totals")
    for part in thirds(spark, sf_dir):
        J.land(rows.where(part), f"{root}/landing")
        source = J.landed(spark, f"{root}/landing", rows.schema)
        J.incremental_totals(source, f"{root}/checkpoint", f"{root}/totals")
    updates = spark.read.parquet(*[f"{root}/totals/batch={i}" for i in range(RANGES)])
    return updates.groupBy("pool").agg(F.max_by("tx_count", "last_event").alias("tx_count"))


def enriched_job(spark, sf_dir, order=range(RANGES)):
    root = new_path(spark, "stream-enriched")
    job = EnrichedJob(spark, root, lambda events: metadata_for(spark, sf_dir, events))
    parts = thirds(spark, sf_dir)
    for i in order:
        logs = encoded_logs(spark, sf_dir, part=parts[i])
        J.land(logs, f"{root}/landing")
        source = J.landed(spark, f"{root}/landing", logs.schema)
        J.run_available(source, f"{root}/checkpoint", job.process)
    return job


@query("stream_enriched", ORACLES["enriched_ledger"])
def stream_enriched(spark, sf_dir):
    """The flagship continued over three landed ranges equals one run over all."""
    return shown(enriched_job(spark, sf_dir).rows())
