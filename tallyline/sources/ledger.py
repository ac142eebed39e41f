"""The test ledger: ``events`` rows read as pool events.

One definition serves the Spark queries and, as :data:`LEDGER_SQL`, their SQL
checks.  ``user_id`` is the pool, ``event_id`` gives block and ordinal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.segments import Segments, plan_segments
from tallyline.operators.fold import SEGMENT
from tallyline.sources.catalog import REGISTRY
from tallyline.sources.tables import table


# All three sources are live from here on, so routing drops nothing.
LEDGER_BLOCK = max(s.start_block for s in REGISTRY)


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with exact cents and the integer inside ``props``."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("k"),
    )


def ledger_columns(events: DataFrame) -> DataFrame:
    """Map event rows to ledger rows; narrow, so it also runs on a stream."""
    t = F.col("event_type")
    price_kind = t.isin("signup", "purchase")
    change = t.isin("view", "click")
    slot = F.col("event_id") % 10
    other = (
        F.when(F.col("k") % 4 == 0, "Subscription")
        .when(F.col("k") % 4 == 1, "Unsubscription")
        .when(F.col("k") % 4 == 2, "Transfer")
        .otherwise("LogCreatePrivateHook")
    )
    kind = (
        F.when(t == "signup", "Initialize")
        .when(t == "purchase", "Swap")
        .when(change, "ModifyLiquidity")
        .otherwise(other)
    )
    cents = F.col("cents")
    return events.select(
        "event_id",
        F.expr(f"event_id div 10 + {LEDGER_BLOCK} AS block"),
        slot.alias("slot"),
        (slot * 2 + 1).alias("ordinal"),
        F.col("user_id").alias("pool"),
        kind.alias("kind"),
        "cents",
        "k",
        F.when(price_kind, cents % 2001 - 1000).alias("tick"),
        F.when(price_kind, cents * 2 + 1).alias("price"),
        F.when(t == "signup", F.lit(0).cast("bigint"))
        .when(t == "purchase", cents)
        .alias("liquidity"),
        F.when(t == "view", cents).when(t == "click", -cents).alias("delta"),
        F.when(change, F.col("k") * -10).alias("lower"),
        F.when(change, F.col("k") * 10).alias("upper"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_columns(event_rows(spark, sf_dir))


def ledger_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block numbers from the ``event_id`` column alone."""
    return table(spark, sf_dir, "events").select(
        F.expr(f"event_id div 10 + {LEDGER_BLOCK} AS block")
    )


def ledger_segments(spark: SparkSession, sf_dir: str) -> Segments:
    return plan_segments(ledger_blocks(spark, sf_dir))


def segmented_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = ledger_segments(spark, sf_dir)
    return ledger(spark, sf_dir).withColumn(SEGMENT, segments.of())


LEDGER_SQL = f"""
WITH e AS (
  SELECT event_id, user_id, event_type,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
  FROM events),
L AS (
  SELECT event_id, {LEDGER_BLOCK} + event_id // 10 AS block, event_id % 10 AS slot,
         2 * (event_id % 10) + 1 AS ordinal, user_id AS pool,
         CASE event_type WHEN 'signup' THEN 'Initialize' WHEN 'purchase' THEN 'Swap'
              WHEN 'view' THEN 'ModifyLiquidity' WHEN 'click' THEN 'ModifyLiquidity'
              ELSE CASE k % 4 WHEN 0 THEN 'Subscription' WHEN 1 THEN 'Unsubscription'
                   WHEN 2 THEN 'Transfer' ELSE 'LogCreatePrivateHook' END END AS kind,
         cents, k,
         CASE WHEN event_type IN ('signup', 'purchase') THEN cents % 2001 - 1000 END AS tick,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 2 * cents + 1 END AS price,
         CASE event_type WHEN 'signup' THEN 0 WHEN 'purchase' THEN cents END AS liquidity,
         CASE event_type WHEN 'view' THEN cents WHEN 'click' THEN -cents END AS delta,
         CASE WHEN event_type IN ('view', 'click') THEN -10 * k END AS lower,
         CASE WHEN event_type IN ('view', 'click') THEN 10 * k END AS upper
  FROM e)
"""
