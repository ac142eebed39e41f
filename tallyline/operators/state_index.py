"""Point-in-time index of keyed state: the value at any block, without folding.

The index holds, per key, one row for every block that changed the state, and
one row for every run of *eras* (``SPAN`` buckets of ``WIDTH`` blocks) that start
with the same state.  A new run begins only after an era with a change, so the
index grows with the changes, not with keys times eras: a key that is quiet for
a thousand eras costs one row.

A probe needs the rows of its key in its own era, up to its block, and the run
that its era is in.  Rows, run and probes of a (key, era) meet in one exchange
and are put in order there; the runs are found by one row per (key, era) that is
asked for.  So neither a hot key nor a long quiet time gathers rows in one task,
no range join is made, and no probe is paired with each row before it.

Files are partitioned by a hash of the key and sorted by time and key, with a
Bloom filter on the key, so a lookup reads the partitions of its keys and, of
their files, the row groups that can hold its buckets and keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.operators.fold import Narrow, Wide
from tallyline.operators.snapshot import last_value

WIDTH = 1_000
SPAN = 8
LANES = 32
# Parts of a lane, by era, that are put in order apart from each other.
DEALS = 8
_TYPES = {Narrow: "BIGINT", Wide: "BINARY"}


@dataclass(frozen=True)
class StateIndex:
    """An index under ``path``: keys with their types, and values with their lanes."""

    path: str
    keys: dict[str, str]
    values: dict[str, type]
    width: int = WIDTH
    span: int = SPAN

    def _lane(self) -> Column:
        return F.pmod(F.hash(*self.keys), F.lit(LANES))

    def _bucket(self, block: str = "block") -> Column:
        return F.expr(f"{block} div {self.width}L")

    def _era(self, block: str = "block") -> Column:
        return F.expr(f"{block} div {self.width}L div {self.span}L")

    def write(self, states: DataFrame) -> None:
        """Index the rows of a fold: keys, block, ordinal and ``<value>_after`` columns."""
        spark, names = states.sparkSession, list(self.values)
        # One exchange of plain rows by file and time serves the aggregate, the window and the files.
        dealt = (
            states.select(*self.keys, "block", "ordinal", *(f"{n}_after" for n in names))
            .withColumns({"lane": self._lane(), "_era": self._era()})
            .withColumn("_deal", F.pmod("_era", F.lit(DEALS)))
            .repartition("lane", "_deal")
        )
        near = ["lane", "_deal", "_era", *self.keys]
        changes = dealt.groupBy(*near, "block").agg(
            *(self._last(f"{n}_after", kind).alias(n) for n, kind in self.values.items())
        )
        order = Window.partitionBy(*near).orderBy("block")
        so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = changes.select(
            self._bucket().alias("bucket"), "block", *self.keys,
            *(F.last(n, ignorenulls=True).over(so_far).alias(n) for n in names),
            F.lead(F.lit(1)).over(order).isNull().alias("ends"), "lane",
        )
        self._put(rows, "rows", "bucket", *self.keys, "block")
        end = self.read(spark).agg(F.max("block").alias("block"))
        end.coalesce(1).write.parquet(f"{self.path}/end")
        self._put(self._runs(self.read(spark), self._end(spark)), "runs", "since", *self.keys)

    def _put(self, rows: DataFrame, part: str, *order: str) -> None:
        writer = rows.sortWithinPartitions("lane", *order).write.partitionBy("lane")
        for key in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.parquet(f"{self.path}/{part}")

    def _end(self, spark: SparkSession) -> int:
        """The last block that the index knows; -1 for an empty one."""
        block = spark.read.schema("block BIGINT").parquet(f"{self.path}/end").first()["block"]
        return -1 if block is None else block

    @staticmethod
    def _last(column: str, lane: type) -> Column:
        return last_value(column, lane=lane) if lane is not Narrow else last_value(column)

    def _runs(self, rows: DataFrame, end: int) -> DataFrame:
        """The state of every key at the start of each era, as runs of eras ``since`` .. ``until``.

        One row per key and era with a change is put in order, however many changes there are.
        """
        newest = rows.where("ends AND block IS NOT NULL").withColumn("_era", self._era()).repartition("lane")
        order = Window.partitionBy("lane", *self.keys).orderBy("_era")
        so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # From the era after the change to the next one with a change, or to the end.
        until = F.coalesce(F.lead("_era").over(order), F.lit(end // self.width // self.span))
        return newest.select(
            (F.col("_era") + 1).alias("since"), until.alias("until"), *self.keys,
            *(F.last(n, ignorenulls=True).over(so_far).alias(n) for n in self.values), "lane",
        ).where("since <= until")

    def _read(self, spark: SparkSession, part: str, times: Sequence[str], more: dict[str, str]) -> DataFrame:
        values = {name: _TYPES[lane] for name, lane in self.values.items()}
        columns = dict.fromkeys(times, "BIGINT") | self.keys | values | more | {"lane": "INT"}
        schema = ", ".join(f"{name} {kind}" for name, kind in columns.items())
        return spark.read.schema(schema).parquet(f"{self.path}/{part}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The state after every block that changed it; ``ends`` marks the last one of a key and era."""
        return self._read(spark, "rows", ["bucket", "block"], {"ends": "BOOLEAN"})

    def read_runs(self, spark: SparkSession) -> DataFrame:
        """The states at the starts of eras ``since`` .. ``until``."""
        return self._read(spark, "runs", ["since", "until"], {})

    def _filled(self, rows: DataFrame, *partition: str) -> DataFrame:
        """The rows of ``rows`` that ask, with the values last stored at or before their place."""
        order = Window.partitionBy(*partition).orderBy(F.asc_nulls_first("_place"), F.asc_nulls_first("_asks"))
        so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        others = [c for c in rows.columns if c not in self.values]
        filled = (F.last(v, ignorenulls=True).over(so_far).alias(v) for v in self.values)
        return rows.select(*others, *filled).where("_asks").drop("_asks")

    def at(self, probes: DataFrame, block: str = "block") -> DataFrame:
        """``probes`` (with the keys and a block) and the values after that block; NULL before any."""
        spark = probes.sparkSession
        keys, values = list(self.keys), list(self.values)
        # Nothing changes after the last block.
        known = F.least(F.col(block), F.lit(self._end(spark)))
        own = probes.drop(*values).withColumns({"_place": known, "_asks": F.lit(True)})
        own = own.withColumn("_era", F.when(F.col("_place") >= 0, self._era("_place")))
        ends = own.agg(
            F.min("_place").alias("low"), F.max("_place").alias("high"), F.collect_set(self._lane()).alias("lanes")
        ).first()
        if ends["low"] is None:
            ends = {"low": 0, "high": -1, "lanes": [0]}
        low, high = ends["low"] // self.width // self.span, ends["high"] // self.width // self.span
        # A NULL key equals no key.
        near = F.col("lane").isin(*ends["lanes"])
        for key in keys:
            near = near & F.col(key).isNotNull()
        rows = self.read(spark).where(near & F.col("bucket").between(low * self.span, ends["high"] // self.width))
        runs = self.read_runs(spark).where(near & (F.col("since") <= high) & (F.col("until") >= low))

        eras = own.select(*keys, F.col("_era").alias("_place"), "_asks").distinct()
        stored = runs.select(*keys, F.col("since").alias("_place"), *values)
        starts = self._filled(stored.unionByName(eras, allowMissingColumns=True), *keys)

        changed = rows.select(*keys, self._era().alias("_era"), F.col("block").alias("_place"), *values)
        begun = starts.withColumnRenamed("_place", "_era").withColumn("_place", F.lit(None).cast("bigint"))
        met = own.unionByName(changed.unionByName(begun), allowMissingColumns=True)
        return self._filled(met, *keys, "_era").drop("_place", "_era")
