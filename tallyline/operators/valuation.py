"""Derived values: tick prices, position amounts, token amounts, pool prices.

Small Arrow kernels do the arithmetic beyond 256 bits; choosing the operands
stays in Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions import words as W
from tallyline.functions.kernels import (
    MAX_TICK,
    price_digits,
    price_text,
    tick_ratio_word,
    token0_word,
    token1_word,
)
from tallyline.operators.fold import with_sql


def tick_dimension(changes: DataFrame) -> DataFrame:
    """Q96 ratio of every distinct bound; a bound out of range fails the job.

    At most 2 * 887,272 + 1 rows of 40 bytes, whatever the ledger's size.
    """
    ticks = changes.select(F.explode(F.array("lower", "upper")).alias("bound")).distinct()
    checked = (
        f"CASE WHEN abs(bound) <= {MAX_TICK} THEN bound "
        "ELSE CAST(raise_error(concat('tick out of range: ', bound)) AS BIGINT) END"
    )
    return (
        with_sql(ticks.where("bound IS NOT NULL"), {"checked": checked})
        .select("bound", tick_ratio_word("checked").alias("ratio"))
    )


def with_bound_ratios(changes: DataFrame, dimension: DataFrame) -> DataFrame:
    """Ratios of both bounds; the dimension's row bound allows the broadcast."""
    lower = dimension.select(F.col("bound").alias("lower"), F.col("ratio").alias("ratio_lower"))
    upper = dimension.select(F.col("bound").alias("upper"), F.col("ratio").alias("ratio_upper"))
    return changes.join(F.broadcast(lower), "lower", "left").join(
        F.broadcast(upper), "upper", "left"
    )


def position_amounts(changes: DataFrame) -> DataFrame:
    """Raw amounts of each liquidity change from tick and price before it.

    Below the range all value is in token0, above it all in token1; inside, the
    price splits it.  NULL while the pool has no state.
    """
    known = "delta IS NOT NULL AND tick_before IS NOT NULL AND price_before IS NOT NULL"
    zero = W.zero_word()
    operands = {
        "_a0": "IF(tick_before < lower, ratio_lower, price_before)",
        "_d0": f"IF({known} AND tick_before < upper, delta, NULL)",
        "_b1": "IF(tick_before < upper, price_before, ratio_upper)",
        "_d1": f"IF({known} AND tick_before >= lower, delta, NULL)",
    }
    rows = with_sql(changes, operands)
    rows = rows.withColumn("_v0", token0_word("_d0", "_a0", "ratio_upper")).withColumn(
        "_v1", token1_word("_d1", "ratio_lower", "_b1")
    )
    return with_sql(
        rows,
        {
            "raw0": f"IF({known}, IF(tick_before < upper, _v0, {zero}), NULL)",
            "raw1": f"IF({known}, IF(tick_before < lower, {zero}, _v1), NULL)",
        },
    ).drop("_a0", "_d0", "_b1", "_d1", "_v0", "_v1")


def token_amounts(rows: DataFrame) -> DataFrame:
    """Decimal amounts: raw for changes, the swap's own amounts with the sign flipped.

    NULL unless both tokens' decimals are known.
    """
    both = "decimals0 IS NOT NULL AND decimals1 IS NOT NULL"
    step = with_sql(
        rows,
        {
            f"_raw{i}": f"IF({both}, CASE kind WHEN 'Swap' THEN amount{i} "
            f"WHEN 'ModifyLiquidity' THEN raw{i} END, NULL)"
            for i in (0, 1)
        }
        | {"_flip": "kind = 'Swap'"},
    )
    amounts = {f"token_amount{i}": W.scaled_text(f"_raw{i}", f"decimals{i}") for i in (0, 1)}
    flipped = {name: f"IF(_flip, {W.flipped_text(name)}, {name})" for name in amounts}
    return with_sql(with_sql(step, amounts), flipped).drop("_raw0", "_raw1", "_flip")


def pool_prices(rows: DataFrame) -> DataFrame:
    """Token prices after Initialize and Swap; empty text where there is none."""
    step = with_sql(
        rows, {"_p": "IF(kind IN ('Initialize', 'Swap'), price_after, NULL)"}
    )
    step = step.withColumn("_t", price_digits("_p", "decimals0", "decimals1"))
    return with_sql(
        step, {f"token{i}_price_after": f"coalesce({price_text('_t', i)}, '')" for i in (0, 1)}
    ).drop("_p", "_t")
