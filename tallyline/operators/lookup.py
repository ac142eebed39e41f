"""As-of and exact lookups between ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.fold import ORDER, SEGMENT, Narrow, Put, Tally, fold
from tallyline.operators.snapshot import drop_seed, with_seed
from tallyline.operators.unpivot import tick_bounds


def asof_lookup(
    writes: DataFrame,
    probes: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    inclusive: bool = True,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Latest ``value`` written at or before (or strictly before) each probe.

    Both sides go through one exchange as one ledger with a tie rank, so the
    cost is linear; no range join, and hot keys split by segment.
    """
    tie = 0 if inclusive else 2
    key_cols = [*keys, *order, SEGMENT]
    w = writes.select(*key_cols, F.col(value).alias("_w"), F.lit(tie).alias("_tie"))
    p = probes.withColumn("_tie", F.lit(1)).withColumn("_probe", F.lit(True))
    both = p.unionByName(w, allowMissingColumns=True)
    done = fold(both, keys, [Put("_found", "_w")], [*order, "_tie"])
    return done.where("_probe").select(
        *probes.columns, F.col("_found_after").alias(out)
    )


TICK_VALUES = ("gross_before", "gross_after", "net_before", "net_after")


def tick_deltas(
    changes: DataFrame, lane: type = Narrow, seeds: DataFrame | None = None
) -> DataFrame:
    """Gross and net liquidity of both bounds before and after each change.

    ``seeds`` are ledger rows (pool, bound, gross, net) that come before all others.
    """
    rows = tick_bounds(
        changes.select("block", "ordinal", SEGMENT, "pool", "lower", "upper", "delta"), lane
    )
    if seeds is not None:
        before = seeds.withColumnsRenamed({"gross": "gross_amount", "net": "net_amount"})
        rows = with_seed(rows, before.withColumn("position", F.lit(0)))
    done = fold(
        rows,
        ["pool", "bound"],
        [Tally("gross", "gross_amount", lane), Tally("net", "net_amount", lane)],
        [*ORDER, "position"],
    )
    return done if seeds is None else drop_seed(done)


def nest_ticks(deltas: DataFrame) -> DataFrame:
    """Back to one row per change: lower and upper values side by side.

    When both bounds are the same tick, the later write's delta is the one
    recorded at that ordinal, so both sides show it.
    """
    same = F.col("lower") == F.col("upper")

    def pick(position: int, name: str):
        wanted = F.when(same, F.lit(1)).otherwise(F.lit(position))
        return F.max(F.when(F.col("position") == wanted, F.col(name)))

    return deltas.groupBy("block", "ordinal").agg(
        *[
            pick(position, name).alias(f"{side}_{name}")
            for position, side in enumerate(("lower", "upper"))
            for name in TICK_VALUES
        ]
    )


def missing_deltas(changes: DataFrame, deltas: DataFrame) -> DataFrame:
    """Required (event, tick) pairs that have no recorded delta; must be empty."""
    need = changes.select(
        "block", "ordinal", "pool", F.explode(F.array("lower", "upper")).alias("bound")
    )
    return need.join(deltas, ["block", "ordinal", "pool", "bound"], "left_anti")
