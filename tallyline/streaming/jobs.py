"""Incremental jobs over block ranges that land as files.

Each range is one ``availableNow`` run.  Keyed state lives in versioned
snapshot tables, not in a per-key state store: a batch is folded by the same
segmented folds as a full run, seeded with the last snapshot, so a hot pool is
spread over tasks here too.  Every batch writes only paths that carry its id
and overwrites them, so a replayed batch gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.segments import plan_batch
from tallyline.operators.fold import SEGMENT
from tallyline.operators.pool_state import (
    STATES,
    continue_pool_states,
    pool_snapshot,
    with_count,
)
from tallyline.operators.snapshot import drop_seed
from tallyline.sources.stage import stage

COMPACT = 16
MARK_SCHEMA = "block BIGINT, ordinal BIGINT"
SNAPSHOT_SCHEMA = "pool BIGINT, tick BIGINT, tx_count BIGINT, liquidity BIGINT"


def run_available(
    source: DataFrame, checkpoint: str, handler: Callable[[DataFrame, int], None]
) -> None:
    """Process everything that has landed, then stop."""
    (
        source.writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def append_available(source: DataFrame, checkpoint: str, path: str) -> None:
    """A stateless job: append everything that has landed to a table."""
    (
        source.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
        .awaitTermination()
    )


def land(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def landed(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


class PoolStateJob:
    """Running pool states over landed ranges.

    Tables under ``root``: ``rows`` (before/after per event), ``deltas`` (state of
    the pools that a batch touched), ``full`` (state of all pools, every
    ``COMPACT`` batches), ``marks`` (last position of each batch, by block and
    ordinal, so a block may be split over batches) and ``late`` (rows at or before
    the last processed position; blocks are final and land in order, so these
    break the input contract and never reach the state).

    A batch reads its rows once, and of the state only the pools it touches, so
    its cost follows the batch.
    """

    def __init__(self, spark: SparkSession, root: str, row_schema) -> None:
        self.spark, self.root, self.row_schema = spark, root, row_schema

    def _path(self, name: str, batch: int) -> str:
        return f"{self.root}/{name}/batch={batch}"

    def _mark(self, batch: int) -> tuple[int, int] | None:
        """Block and ordinal of the last row processed before ``batch``."""
        if batch == 0:
            return None
        marks = self.spark.read.schema(MARK_SCHEMA).parquet(self._path("marks", batch - 1))
        row = marks.first()
        return None if row["block"] is None else (row["block"], row["ordinal"])

    def snapshot(self, batch: int) -> DataFrame:
        """State of every pool after ``batch``: the last full table and the deltas since."""
        if batch < 0:
            return self.spark.createDataFrame([], SNAPSHOT_SCHEMA)
        full = (batch + 1) // COMPACT * COMPACT - 1
        read = self.spark.read.schema(SNAPSHOT_SCHEMA)
        parts = [read.parquet(self._path("full", full)).withColumn("version", F.lit(full))] if full >= 0 else []
        parts += [
            read.parquet(self._path("deltas", b)).withColumn("version", F.lit(b))
            for b in range(full + 1, batch + 1)
        ]
        states = [c for c in parts[0].columns if c not in ("pool", "version")]
        newest = reduce(DataFrame.unionByName, parts).groupBy("pool").agg(
            *(F.max_by(F.col(s), F.col("version")).alias(s) for s in states)
        )
        return newest if len(parts) > 1 else parts[0].drop("version")

    def process(self, batch_rows: DataFrame, batch: int) -> None:
        mark = self._mark(batch)
        done = "false" if mark is None else f"block < {mark[0]} OR (block = {mark[0]} AND ordinal <= {mark[1]})"
        # The batch is read once; everything after reads the columns it needs of this copy.
        rows = stage(batch_rows.withColumn("_late", F.expr(done)), "batch-rows")
        fresh, late = rows.where("NOT _late").drop("_late"), rows.where("_late").drop("_late")
        late.write.mode("overwrite").parquet(self._path("late", batch))

        segments, first, last = plan_batch(fresh)
        # Seeds come before every row of the batch, also in a block that was split.
        seed_block = (first or 0) - 1
        touched = self.snapshot(batch - 1).join(fresh.select("pool").distinct(), "pool", "left_semi")
        states = continue_pool_states(
            fresh.withColumn(SEGMENT, segments.of()), touched, seed_block
        )
        # The rows table is written once; the delta is taken from it.
        drop_seed(states).select(
            "block", "ordinal", "pool", "kind",
            *[f"{s}_{w}" for s in STATES for w in ("before", "after")],
        ).write.mode("overwrite").parquet(self._path("rows", batch))
        written = self.spark.read.parquet(self._path("rows", batch))
        pool_snapshot(written).write.mode("overwrite").parquet(self._path("deltas", batch))
        position = last or mark or (None, None)
        self.spark.createDataFrame([position], MARK_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            self._path("marks", batch)
        )
        if (batch + 1) % COMPACT == 0:
            previous = self.snapshot(batch - 1).withColumn("version", F.lit(0))
            delta = self.spark.read.schema(SNAPSHOT_SCHEMA).parquet(self._path("deltas", batch))
            both = previous.unionByName(delta.withColumn("version", F.lit(1)))
            both.groupBy("pool").agg(
                *(F.max_by(F.col(s), F.col("version")).alias(s) for s in STATES)
            ).write.mode("overwrite").parquet(self._path("full", batch))

    def rows(self, batches: int) -> DataFrame:
        """Before/after rows of all batches."""
        return self._batches("rows", batches).drop("batch")

    def late(self, batches: int) -> DataFrame:
        return self._batches("late", batches).drop("batch")

    def _batches(self, name: str, batches: int) -> DataFrame:
        """A table's first batches, read as partitions of one folder."""
        return self.spark.read.parquet(f"{self.root}/{name}").where(f"batch < {batches}")


def incremental_totals(source: DataFrame, checkpoint: str, path: str) -> None:
    """Transaction totals per pool by Spark's own streaming aggregation.

    Partial sums are combined before the shuffle and only pools touched by a
    batch are emitted; the latest row per pool is the total.  A pool without a
    transaction has no total.
    """
    totals = (
        with_count(source)
        .groupBy("pool")
        .agg(F.sum("touch").alias("tx_count"), F.max("event_id").alias("last_event"))
        .where("tx_count IS NOT NULL")
    )

    def emit(updated: DataFrame, batch: int) -> None:
        updated.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    (
        totals.writeStream.outputMode("update")
        .foreachBatch(emit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
