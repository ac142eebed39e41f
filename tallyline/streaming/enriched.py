"""The enriched ledger, continued over landed block ranges.

A batch finds the pools, (pool, tick) pairs and tokens that it touches, reads
their states after the batch before, and runs the same folds as a full run with
those states as seed rows.  Its cost follows the batch: the ledger before it is
never read again, and states of other keys stay where they are.  The folds are
segmented, so a pool with most of a batch is spread over tasks.

Outputs of a batch become visible together: rows, the three kinds of state and
the rejected late rows are written under the batch's number, and the mark, which
tells where the batch ended, is written last.  Readers follow the marks.  A batch
that fails between two writes leaves nothing visible, and when it is run again it
overwrites what it left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.segments import plan_batch
from tallyline.operators.decode import decode
from tallyline.operators.enrich import (
    EVENT,
    TOKEN_VALUES,
    assembled,
    initialize_token_rows,
    pool_values,
)
from tallyline.operators.fold import SEGMENT, Wide
from tallyline.operators.lookup import nest_ticks, tick_deltas
from tallyline.operators.metadata import by_side
from tallyline.operators.pool_state import pool_events
from tallyline.operators.snapshot import last_value, seed_rows
from tallyline.operators.unpivot import currencies, tick_ids
from tallyline.sources.stage import stage
from tallyline.streaming.state_tables import StateTable

POOL_STATE = {
    "tick": "BIGINT", "price": "BINARY", "tx_count": "BIGINT", "liquidity": "BINARY",
    "d0": "BIGINT", "d1": "BIGINT",
}
# State -> its column in the valued rows, and whether it is a word.
_LAST = {
    "tick": ("tick_after", False), "price": ("price_after", True), "tx_count": ("tx_count_after", False),
    "liquidity": ("liquidity_after", True), "d0": ("decimals0", False), "d1": ("decimals1", False),
}
MARK_SCHEMA = "block BIGINT, ordinal BIGINT"


class EnrichedJob:
    """Enriched rows over landed logs; ``metadata`` gives the metadata that events need."""

    def __init__(
        self, spark: SparkSession, root: str, metadata: Callable[[DataFrame], DataFrame]
    ) -> None:
        self.spark, self.root, self.metadata = spark, root, metadata
        self.pools = StateTable(spark, f"{root}/pools", {"pool": "BINARY"}, POOL_STATE)
        self.ticks = StateTable(
            spark, f"{root}/ticks", {"pool": "BINARY", "bound": "BIGINT"},
            {"gross": "BINARY", "net": "BINARY"},
        )
        self.tokens = StateTable(spark, f"{root}/tokens", {"token": "BINARY"}, {"known": "BIGINT"})

    def _path(self, name: str, batch: int) -> str:
        return f"{self.root}/{name}/batch={batch}"

    def mark(self, batch: int) -> tuple[int, int] | None:
        """Position of the last row up to and including ``batch``; None before any."""
        if batch < 0:
            return None
        row = self.spark.read.schema(MARK_SCHEMA).parquet(self._path("marks", batch)).first()
        return None if row["block"] is None else (row["block"], row["ordinal"])

    def process(self, logs: DataFrame, batch: int) -> None:
        mark = self.mark(batch - 1)
        done = "false" if mark is None else f"block < {mark[0]} OR (block = {mark[0]} AND ordinal <= {mark[1]})"
        # The only pass over the landed logs.
        batch_events = stage(decode(logs).withColumn("_late", F.expr(done)), "batch-events")
        batch_events.where("_late").select(*EVENT, "kind", "pool").write.mode("overwrite").parquet(
            self._path("late", batch)
        )
        fresh = batch_events.where("NOT _late").drop("_late")
        segments, first, last = plan_batch(fresh)
        events = fresh.withColumn(SEGMENT, segments.of())
        self._enrich(events, batch, (first or 0) - 1)
        position = last or mark or (None, None)
        self.spark.createDataFrame([position], MARK_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            self._path("marks", batch)
        )

    def _enrich(self, events: DataFrame, batch: int, seed_block: int) -> None:
        inits = events.where("kind = 'Initialize'")
        changes = events.where("kind = 'ModifyLiquidity'")

        def seeds(table: StateTable, wanted: DataFrame) -> DataFrame:
            # A fold reads its input twice.
            states = table.after(batch - 1, wanted)
            return seed_rows(stage(states, "batch-seeds") if batch else states, seed_block)

        token_rows = stage(
            initialize_token_rows(events, self.metadata(events), seeds(self.tokens, currencies(inits))),
            "batch-token-rows",
        )
        tokens = stage(by_side(token_rows, EVENT, TOKEN_VALUES), "batch-tokens")
        values = stage(
            pool_values(events, tokens, seeds(self.pools, pool_events(events))), "batch-values"
        )
        ticks = stage(
            tick_deltas(changes, Wide, seeds(self.ticks, tick_ids(changes.select("pool", "lower", "upper")))),
            "batch-ticks",
        )
        assembled(events.drop(SEGMENT), tokens, values, nest_ticks(ticks)).write.mode("overwrite").parquet(
            self._path("rows", batch)
        )
        self.tokens.write(
            batch,
            token_rows.groupBy("token").agg(last_value("known_after", [*EVENT, "side"]).alias("known"))
            .where("known IS NOT NULL"),
        )
        self.pools.write(
            batch,
            values.groupBy("pool").agg(
                *(
                    last_value(column, EVENT, **({"lane": Wide} if wide else {})).alias(name)
                    for name, (column, wide) in _LAST.items()
                )
            ),
        )
        self.ticks.write(
            batch,
            ticks.groupBy("pool", "bound").agg(
                *(last_value(f"{s}_after", [*EVENT, "position"], Wide).alias(s) for s in ("gross", "net"))
            ),
        )

    def committed(self) -> int:
        """How many batches are complete, counted from the first."""
        batch = 0
        while self._exists(self._path("marks", batch)):
            batch += 1
        return batch

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        name = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return name.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(name)

    def _table(self, name: str) -> DataFrame | None:
        paths = [self._path(name, b) for b in range(self.committed())]
        return self.spark.read.parquet(*paths) if paths else None

    def rows(self) -> DataFrame | None:
        """Enriched rows of all complete batches; None before the first."""
        return self._table("rows")

    def late(self) -> DataFrame | None:
        """Rows that landed at or before a position that was already done."""
        return self._table("late")
