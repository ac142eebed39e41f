"""Data-quality jobs: embedded NUL, coverage, ranges, order, contracts, differences."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.operators.fold import Put, Tally, fold, with_sql
from tallyline.operators.unpivot import text_fields
from tallyline.sources.catalog import KINDS, REGISTRY

EVENT_PAYLOADS = (
    "initialize", "modify_liquidity", "swap", "subscription", "unsubscription", "transfer",
    "log_create_private_hook",
)


def nul_occurrences(inits: DataFrame) -> DataFrame:
    """Token texts that contain U+0000, with the value cut at the first one."""
    return (
        text_fields(inits)
        .where("instr(text, chr(0)) > 0")
        .selectExpr(
            "block", "block_hash", "tx_hash", "ordinal", "field_seq", "token", "field",
            "CAST(text AS BINARY) AS raw_utf8",
            "substring_index(text, chr(0), 1) AS corrected_value",
        )
    )


def nul_corrections(occurrences: DataFrame) -> DataFrame:
    """The exact set of corrections."""
    return occurrences.select("token", "field", "raw_utf8", "corrected_value").distinct()


def dense_counts(
    spark: SparkSession, rows: DataFrame, start: int, stop: int, block: str = "block"
) -> DataFrame:
    """One frame per block of ``[start, stop)`` with the number of rows, zero-filled."""
    counts = rows.groupBy(block).agg(F.count(F.lit(1)).alias("n"))
    frames = spark.range(start, stop).withColumnRenamed("id", block)
    return frames.join(counts, block, "left").select(
        block, F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )


def coverage_exceptions(dense: DataFrame) -> DataFrame:
    """Blocks that are missing or present more than once."""
    return dense.where("n <> 1").selectExpr(
        "block", "IF(n = 0, 'gap', 'duplicate') AS problem", "n"
    )


def coverage_report(
    spark: SparkSession, rows: DataFrame, start: int, stop: int, first_exception: int | None
) -> DataFrame:
    """One row on how ``rows`` cover the fixed target ``[start, stop)``.

    Counts the target's blocks, those present, gaps, duplicates and rows outside
    the target, names the first exception, and says whether nothing lies outside
    and the first exception is the expected one (None: there must be none).
    """
    inside = rows.where(f"block >= {start} AND block < {stop}")
    dense = dense_counts(spark, inside, start, stop).agg(
        F.count(F.lit(1)).alias("target_blocks"),
        F.count_if(F.col("n") > 0).alias("present"),
        F.count_if(F.col("n") == 0).alias("gaps"),
        F.count_if(F.col("n") > 1).alias("duplicates"),
        F.min(F.when(F.col("n") != 1, F.col("block"))).alias("first_exception"),
    )
    outside = rows.where(f"block < {start} OR block >= {stop}").agg(
        F.count(F.lit(1)).alias("outside"), F.max("block").alias("last_outside")
    )
    wanted = F.lit(first_exception).cast("bigint")
    # Both sides are one row.
    return dense.withColumn("_k", F.lit(1)).join(outside.withColumn("_k", F.lit(1)), "_k").drop("_k").withColumn(
        "as_expected",
        (F.col("outside") == 0) & F.col("first_exception").eqNullSafe(wanted),
    )


def islands(blocks: DataFrame) -> DataFrame:
    """Maximal runs of consecutive blocks.

    ``blocks`` has distinct ``block`` and its segment.  Both folds run per
    segment, so no task sees more than one segment plus the segment totals.
    """
    seen = fold(blocks, [], [Put("previous", "block")], ["block"])
    starts = with_sql(
        seen, {"is_start": "IF(block - previous_before = 1, CAST(NULL AS BIGINT), 1L)"}
    )
    numbered = fold(starts, [], [Tally("island", "is_start")], ["block"])
    return numbered.groupBy(F.col("island_after").alias("island")).agg(
        F.min("block").alias("first_block"),
        F.max("block").alias("last_block"),
        F.count(F.lit(1)).alias("blocks"),
    )


@dataclass(frozen=True)
class BlockRange:
    """A named verification range, inclusive at both ends."""

    name: str
    first: int
    last: int
    first_hash: str | None = None
    last_hash: str | None = None


def in_ranges(rows: DataFrame, ranges: Sequence[BlockRange]) -> DataFrame:
    """Each row once per range that holds its block; the range list is a literal.

    The ranges also reach the scan as a plain predicate, so blocks outside all
    of them are not read.
    """
    literal = ", ".join(
        f"named_struct('range', '{r.name}', 'first', {r.first}L, 'last', {r.last}L)"
        for r in ranges
    )
    hits = f"filter(array({literal}), r -> block BETWEEN r.first AND r.last)"
    inside = " OR ".join(f"block BETWEEN {r.first} AND {r.last}" for r in ranges)
    return rows.where(inside).selectExpr(
        "*", f"explode(transform({hits}, r -> r.range)) AS range"
    )


def range_kind_counts(rows: DataFrame, ranges: Sequence[BlockRange]) -> DataFrame:
    """Counts per range, one zero-filled column per kind."""
    kinds = {k: f"CAST(count_if(kind = '{k}') AS BIGINT)" for k in KINDS}
    counted = (
        in_ranges(rows, ranges)
        .groupBy("range")
        .agg(*[F.expr(sql).alias(k) for k, sql in kinds.items()])
    )
    names = ", ".join(f"'{r.name}'" for r in ranges)
    every = rows.sparkSession.range(1).selectExpr(f"explode(array({names})) AS range")
    return every.join(counted, "range", "left").selectExpr(
        "range", *[f"coalesce({k}, 0L) AS {k}" for k in KINDS]
    )


def range_boundaries(rows: DataFrame, ranges: Sequence[BlockRange]) -> DataFrame:
    """Hashes of the first and last block present in each range.

    Ends first, by a numeric aggregate over one column; then the hashes of
    those blocks only, at most two per range, which bounds the broadcast.
    """
    ends = in_ranges(rows.select("block"), ranges).groupBy("range").agg(
        F.min("block").alias("first_block"), F.max("block").alias("last_block")
    )
    wanted = ends.select(F.explode(F.array("first_block", "last_block")).alias("block"))
    hashes = (
        rows.select("block", "block_hash")
        .join(F.broadcast(wanted.distinct()), "block", "left_semi")
        .groupBy("block")
        .agg(F.max("block_hash").alias("block_hash"))
    )
    first = hashes.toDF("first_block", "first_hash")
    last = hashes.toDF("last_block", "last_hash")
    return ends.join(first, "first_block").join(last, "last_block")


def boundary_check(rows: DataFrame, ranges: Sequence[BlockRange]) -> DataFrame:
    """Hashes seen at each range's own first and last block against the expected ones.

    Only rows of those blocks are read.  A block that is absent, or seen with
    two hashes, is not as expected; a range without an expected hash accepts any.
    """
    ends = [
        BlockRange(f"{side}:{r.name}", block, block)
        for r in ranges
        for side, block in (("first", r.first), ("last", r.last))
    ]
    seen = (
        in_ranges(rows.select("block", "block_hash"), ends)
        .groupBy("range")
        .agg(F.min("block_hash").alias("low"), F.max("block_hash").alias("high"))
    )
    literal = ", ".join(
        f"struct('{r.name}' AS range, '{side}' AS side, '{side}:{r.name}' AS at, {block}L AS block, "
        f"{f"X'{wanted}'" if wanted else 'CAST(NULL AS BINARY)'} AS expected)"
        for r in ranges
        for side, block, wanted in (("first", r.first, r.first_hash), ("last", r.last, r.last_hash))
    )
    every = rows.sparkSession.range(1).selectExpr(f"inline(array({literal}))")
    return every.join(seen.withColumnRenamed("range", "at"), "at", "left").selectExpr(
        "range", "side", "block", "low AS block_hash", "expected",
        "coalesce(low = high AND (expected IS NULL OR low = expected), false) AS as_expected",
    )


def range_block_counts(rows: DataFrame, ranges: Sequence[BlockRange]) -> DataFrame:
    """Distinct blocks with output per range: distinct first, then a plain count."""
    return (
        in_ranges(rows.select("block"), ranges)
        .distinct()
        .groupBy("range")
        .agg(F.count(F.lit(1)).alias("blocks"))
    )


def missing_anchors(anchors: DataFrame, events: DataFrame) -> DataFrame:
    """Expected logs that the events do not hold; must be empty.

    The events are first cut down to the few that an anchor names, so that only
    the anchors can make the second join large.
    """
    keys = ["tx_hash", "tx_index", "log_index"]
    hits = events.select(*keys).join(anchors.select(*keys), keys, "left_semi")
    return anchors.join(hits, keys, "left_anti")


def order_violations(rows: DataFrame) -> DataFrame:
    """Rows whose trigger order does not rise inside the block, or is not the log index."""
    before = F.lag("trigger_order").over(Window.partitionBy("block").orderBy("position"))
    return rows.withColumn("previous", before).where(
        "previous >= trigger_order OR trigger_order <> log_index"
    )


def row_contracts(events: DataFrame) -> DataFrame:
    """Per kind: rows, and rows that break each contract."""
    payloads = " + ".join(f"CAST({p} IS NOT NULL AS INT)" for p in EVENT_PAYLOADS)
    address = " ".join(f"WHEN '{s.name}' THEN X'{s.address}'" for s in REGISTRY)
    return events.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"count_if({payloads} <> 1)").alias("bad_payload"),
        F.expr(f"count_if(log_ref.address <> CASE source {address} END)").alias("bad_address"),
        F.expr("count_if(octet_length(transaction_ref.origin) <> 20)").alias("bad_origin"),
    )


def differences(
    first: DataFrame, second: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Records that two runs do not share, keyed so that both sides show."""
    a = first.selectExpr(*keys, f"struct({', '.join(values)}) AS first_run")
    b = second.selectExpr(*keys, f"struct({', '.join(values)}) AS second_run")
    return a.join(b, list(keys), "full_outer").where("NOT (first_run <=> second_run)")


def range_differential(
    first: DataFrame,
    second: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    ranges: Sequence[BlockRange],
) -> DataFrame:
    """Two runs compared per range: blocks, records, duplicates, differences, verdict.

    ``keys`` include ``block``.  Both runs are cut to the ranges at the scan and
    counted in one grouping by key, so duplicates show and nothing is joined.
    """
    def side(df: DataFrame, number: int) -> DataFrame:
        return in_ranges(df, ranges).selectExpr(
            "range", *keys, f"struct({', '.join(values)}) AS v", f"{number} AS run"
        )

    records = side(first, 1).unionByName(side(second, 2)).groupBy("range", *keys).agg(
        F.count_if(F.col("run") == 1).alias("n1"),
        F.count_if(F.col("run") == 2).alias("n2"),
        # Equal sums of value digests: the same values equally often.
        F.expr("sum(CAST(IF(run = 1, xxhash64(v), -xxhash64(v)) AS DECIMAL(38,0))) = 0").alias("same"),
    )
    per_block = records.groupBy("range", "block").agg(
        F.sum("n1").alias("n1"),
        F.sum("n2").alias("n2"),
        F.sum(F.greatest(F.col("n1") - 1, F.lit(0)) + F.greatest(F.col("n2") - 1, F.lit(0))).alias("duplicates"),
        F.count_if(~(F.col("same") & (F.col("n1") == F.col("n2")))).alias("different"),
    )
    counted = per_block.groupBy("range").agg(
        F.count(F.lit(1)).alias("blocks"),
        F.sum("n1").alias("first_records"),
        F.sum("n2").alias("second_records"),
        F.sum("duplicates").alias("duplicates"),
        F.sum("different").alias("different"),
    )
    names = ", ".join(f"'{r.name}'" for r in ranges)
    every = first.sparkSession.range(1).selectExpr(f"explode(array({names})) AS range")
    numbers = ("blocks", "first_records", "second_records", "duplicates", "different")
    return every.join(counted, "range", "left").selectExpr(
        "range", *[f"coalesce({n}, 0L) AS {n}" for n in numbers],
        "coalesce(duplicates + different, 0L) = 0 AS agrees",
    )


def kinds_represented(events: DataFrame) -> DataFrame:
    """Every expected kind with its number of events, zero when it never occurs."""
    seen = events.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    names = ", ".join(f"'{k}'" for k in KINDS)
    every = events.sparkSession.range(1).selectExpr(f"explode(array({names})) AS kind")
    return every.join(seen, "kind", "left").selectExpr("kind", "coalesce(n, 0L) AS n")


def shard_histogram(rows: DataFrame) -> DataFrame:
    """Rows and distinct first bytes per shard."""
    per_byte = rows.groupBy("shard", "first_byte").agg(F.count(F.lit(1)).alias("n"))
    return per_byte.groupBy("shard").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("byte_values")
    )

