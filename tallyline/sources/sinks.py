"""Sinks: partitioned tables of events, records, probes and audits; fixture documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.fold import rank
from tallyline.sources.blocks import nest_blocks, read_blocks


def write_events(events: DataFrame, path: str, bucket: str) -> None:
    """Write events partitioned by block bucket.

    The rows are rebalanced by bucket: a task writes few buckets, and a large
    bucket is split over several files, whatever the size.
    """
    events.hint("rebalance", bucket).write.partitionBy(bucket).parquet(path)


def write_and_read(rows: DataFrame, path: str, bucket: str) -> DataFrame:
    """Write rows in buckets and read them back with their own schema."""
    write_events(rows, path, bucket)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def first_per_kind(events: DataFrame) -> DataFrame:
    """The earliest log of each kind: a map-side minimum, one row per kind."""
    at = rank(["block", "log_index"])
    return events.groupBy("kind").agg(
        *[F.expr(f"min_by({c}, {at})").alias(c) for c in ("block", "log_index", "tx_index")]
    )


def fixture_blocks(logs: DataFrame, events: DataFrame) -> DataFrame:
    """Nested blocks of the transactions that hold each kind's first log.

    At most one transaction per kind is wanted, so that side is broadcast.
    """
    wanted = first_per_kind(events).select("block", "tx_index").distinct()
    chosen = events.select("block", "tx_index", "log_index").join(
        F.broadcast(wanted), ["block", "tx_index"], "left_semi"
    )
    picked = logs.join(F.broadcast(wanted), ["block", "tx_index"], "left_semi").join(
        chosen, ["block", "tx_index", "log_index"], "left_semi"
    )
    return nest_blocks(picked)


def write_fixture(blocks: DataFrame, path: str) -> DataFrame:
    """Write nested blocks as JSON and read them back with the block schema."""
    blocks.write.json(path)
    return read_blocks(blocks.sparkSession, path, "json")
