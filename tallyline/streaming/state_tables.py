"""Versioned keyed state in tables: small deltas, full tables now and then.

A batch writes the new state of the keys that it changed.  Every ``COMPACT``
batches the newest states of all keys are written too, so a state is read from
one full table and a bounded number of deltas.  Deltas are as small as their
batch; full tables are cut into buckets of their keys, and a batch that asks for
some keys reads only their buckets.  Paths
carry the batch and are overwritten, so a batch that is run again gives the same
tables; a reader names the batch and never sees what later ones have begun.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.sources.stage import stage

COMPACT = 16
BUCKETS = 64


class StateTable:
    """The state of one kind of key; ``columns`` maps state columns to their types."""

    def __init__(
        self, spark: SparkSession, root: str, keys: dict[str, str], columns: dict[str, str],
        compact: int = COMPACT,
    ) -> None:
        self.spark, self.root, self.compact = spark, root, compact
        self.keys, self.columns = list(keys), list(columns)
        self.schema = ", ".join(f"{c} {kind}" for c, kind in (keys | columns).items())

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.hash(*self.keys), F.lit(BUCKETS)))

    def _path(self, kind: str, batch: int) -> str:
        return f"{self.root}/{kind}/batch={batch}"

    def _delta(self, batch: int) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(self._path("deltas", batch))
        return rows.withColumn("_version", F.lit(batch))

    def _full(self, batch: int, wanted: DataFrame | None) -> DataFrame:
        rows = self.spark.read.schema(f"{self.schema}, bucket INT").parquet(self._path("full", batch))
        if wanted is not None:
            # At most BUCKETS numbers.
            buckets = self._bucketed(wanted).select("bucket").distinct().collect()
            rows = rows.where(F.col("bucket").isin(*(r["bucket"] for r in buckets)))
        return rows.drop("bucket").withColumn("_version", F.lit(batch))

    def _newest(self, parts: list[DataFrame]) -> DataFrame:
        state = F.struct(*self.columns)
        rows = reduce(DataFrame.unionByName, parts)
        return rows.groupBy(*self.keys).agg(F.max_by(state, F.col("_version")).alias("_state")).select(
            *self.keys, "_state.*"
        )

    def after(self, batch: int, wanted: DataFrame | None = None) -> DataFrame:
        """States after ``batch``; of the keys in ``wanted``, or of all."""
        if batch < 0:
            return self.spark.createDataFrame([], self.schema)
        if wanted is not None:
            wanted = stage(wanted.select(*self.keys).distinct(), "wanted-keys")
        full = (batch + 1) // self.compact * self.compact - 1
        parts = [self._full(full, wanted)] if full >= 0 else []
        parts += [self._delta(b) for b in range(full + 1, batch + 1)]
        if wanted is not None:
            parts = [p.join(wanted, self.keys, "left_semi") for p in parts]
        return self._newest(parts)

    def write(self, batch: int, changed: DataFrame) -> None:
        """The states that ``batch`` leaves behind for the keys it changed."""
        rows = changed.select(*self.keys, *self.columns)
        rows.write.mode("overwrite").parquet(self._path("deltas", batch))
        if (batch + 1) % self.compact == 0:
            earlier = self.after(batch - 1).withColumn("_version", F.lit(batch - 1))
            newest = self._bucketed(self._newest([earlier, self._delta(batch)]))
            newest.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
                self._path("full", batch)
            )
