"""Pool state: tick, price, transaction count, token decimals, liquidity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.fold import Narrow, Put, Tally, fold, fold_set_sum, with_sql
from tallyline.operators.snapshot import last_value, seed_rows, with_seed
from tallyline.sources.catalog import CHANGE_KINDS, POOL_KINDS
from tallyline.sources.stage import stage


def pool_events(ledger: DataFrame) -> DataFrame:
    """Rows of the kinds that name a pool."""
    return ledger.where(F.col("kind").isin(*POOL_KINDS))


def in_range(lower: str, upper: str, tick: str) -> str:
    """Lower bound inclusive, upper exclusive; an unknown tick is not in range."""
    return f"coalesce({lower} <= {tick} AND {tick} < {upper}, false)"


def with_count(ledger: DataFrame) -> DataFrame:
    """Mark the rows that count as a transaction; others stay NULL (no write)."""
    return ledger.withColumn(
        "touch", F.when(F.col("kind").isin(*CHANGE_KINDS), F.lit(1).cast("bigint"))
    )


def with_contribution(ledger: DataFrame, tick: str = "tick_after") -> DataFrame:
    """A change counts toward pool liquidity only when the as-of tick is inside."""
    active = in_range("lower", "upper", tick)
    return with_sql(ledger, {"contribution": f"IF({active}, delta, NULL)"})


def pool_states(
    ledger: DataFrame,
    keys: Sequence[str] = ("pool",),
    puts: Sequence[Put] = (Put("tick", "tick"), Put("price", "price")),
    lane: type = Narrow,
    staged: bool = False,
    counted: bool = False,
) -> DataFrame:
    """All pool states before and after each pool event.

    Two scans of the same (pool, segment) partitions: the simple states first,
    then liquidity, whose in-range test needs the tick.  ``staged`` writes the
    first result, so that the second scan does not compute it twice; ``counted``
    says that the ledger has its ``touch`` already.
    """
    simple = fold(ledger if counted else with_count(ledger), keys, [*puts, Tally("tx_count", "touch")])
    if staged:
        simple = stage(simple, "pool-states")
    return fold_set_sum(
        with_contribution(simple), keys, "liquidity", "liquidity", "contribution", lane
    ).drop("touch", "contribution")


STATES = ("tick", "tx_count", "liquidity")


def pool_snapshot(states: DataFrame, keys: Sequence[str] = ("pool",)) -> DataFrame:
    """State per pool after the last row of ``states``."""
    return states.groupBy(*keys).agg(
        *[last_value(f"{s}_after").alias(s) for s in STATES]
    )


def continue_pool_states(
    rows: DataFrame, snapshot: DataFrame, seed_block: int, keys: Sequence[str] = ("pool",)
) -> DataFrame:
    """Fold ``rows`` on top of a snapshot taken at ``seed_block``.

    Seed rows stay in the result, marked by ``seed``, so that pools without new
    rows survive into the next snapshot.
    """
    seeds = seed_rows(snapshot, seed_block).withColumnRenamed("tx_count", "touch")
    seeded = with_seed(with_count(rows), seeds)
    simple = fold(seeded, keys, [Put("tick", "tick"), Tally("tx_count", "touch")])
    return fold_set_sum(
        with_contribution(simple), keys, "liquidity", "liquidity", "contribution"
    )
