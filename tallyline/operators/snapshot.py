"""State at the end of a range, partial-state merge, and seeded continuation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators.fold import ORDER, SEGMENT, Narrow, plus, rank, total


def last_value(value: str, order: Sequence[str] = ORDER, lane: type = Narrow):
    """Aggregate: the last non-NULL ``value`` in ledger order."""
    return F.expr(lane.last(value, rank(order)))


def snapshot_set(
    ledger: DataFrame, keys: Sequence[str], value: str, lane: type = Narrow
) -> DataFrame:
    """Last value per key; a key that was never written has no row."""
    return (
        ledger.where(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(last_value(value, ORDER, lane).alias(value))
    )


def snapshot_add(
    ledger: DataFrame, keys: Sequence[str], amount: str, out: str, lane: type = Narrow
) -> DataFrame:
    """Sum per key; a key that was never written has no row."""
    return (
        ledger.where(F.col(amount).isNotNull())
        .groupBy(*keys)
        .agg(F.expr(total(lane, amount)).alias(out))
    )


def set_sum_partials(
    ledger: DataFrame,
    keys: Sequence[str],
    put: str,
    add: str,
    order: Sequence[str] = ORDER,
    lane: type = Narrow,
) -> DataFrame:
    """Per (keys, segment): the last set value, and the sum added since.

    ``put_value`` is NULL where the segment holds no set.
    """
    group = [*keys, SEGMENT]
    pos = F.expr(rank(order))
    is_put = F.col(put).isNotNull()
    last_put = F.max(F.when(is_put, pos)).over(Window.partitionBy(*group))
    later = F.col("_last").isNull() | (pos > F.col("_last"))
    return (
        ledger.withColumn("_last", last_put)
        .withColumn("_later", F.when(later & ~is_put, F.col(add)))
        .groupBy(*group)
        .agg(
            last_value(put, order, lane).alias("put_value"),
            F.expr(total(lane, "_later")).alias("add_value"),
        )
    )


def merge_set_sum(
    partials: DataFrame, keys: Sequence[str], out: str, lane: type = Narrow
) -> DataFrame:
    """Merge partials: a later set replaces, otherwise sums add up.

    One row per (keys, segment) comes in, so a hot key stays small here.
    """
    has_put = F.col("put_value").isNotNull()
    last_put = F.max(F.when(has_put, F.col(SEGMENT))).over(Window.partitionBy(*keys))
    counted = F.col("_last").isNull() | (F.col(SEGMENT) >= F.col("_last"))
    return (
        partials.withColumn("_last", last_put)
        .where(counted)
        .groupBy(*keys)
        .agg(
            last_value("put_value", [SEGMENT], lane).alias("_put"),
            F.expr(total(lane, "add_value")).alias("_add"),
        )
        .selectExpr(*keys, f"{plus(lane, '_put', '_add')} AS {out}")
        .where(F.col(out).isNotNull())
    )


def seed_rows(snapshot: DataFrame, block: int) -> DataFrame:
    """Turn a snapshot into ledger rows that precede everything after ``block``.

    They get a segment of their own, before all others.
    """
    return snapshot.withColumns(
        {
            "block": F.lit(block).cast("bigint"),
            "ordinal": F.lit(2**62).cast("bigint"),
            SEGMENT: F.lit(-1).cast("bigint"),
            "seed": F.lit(True),
        }
    )


def with_seed(ledger: DataFrame, seeds: DataFrame) -> DataFrame:
    return ledger.withColumn("seed", F.lit(False)).unionByName(
        seeds, allowMissingColumns=True
    )


def drop_seed(ledger: DataFrame) -> DataFrame:
    return ledger.where(~F.col("seed")).drop("seed")
