"""Nested block source: schema, range scan and log explosion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_TYPE = (
    "STRUCT<address: BINARY, topics: ARRAY<BINARY>, data: BINARY, tx_log_index: BIGINT, "
    "log_index: BIGINT, ordinal: BIGINT>"
)
TRANSACTION_TYPE = (
    "STRUCT<tx_index: BIGINT, hash: BINARY, origin: BINARY, recipient: BINARY, "
    f"gas_price: BINARY, status: BIGINT, logs: ARRAY<{LOG_TYPE}>>"
)
BLOCK_SCHEMA = (
    "block BIGINT, hash BINARY, header STRUCT<parent_hash: BINARY, seconds: BIGINT, "
    f"nanos: BIGINT>, transactions ARRAY<{TRANSACTION_TYPE}>"
)


def read_blocks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Blocks with an explicit schema; JSON carries bytes as base64 text."""
    return spark.read.schema(BLOCK_SCHEMA).format(fmt).load(path)


def block_range(
    blocks: DataFrame,
    start: int,
    stop: int,
    first: int = 0,
    bucket: str | None = None,
    bucket_blocks: int = 1,
) -> DataFrame:
    """Blocks of ``[start, stop)`` that are not before the job's first block.

    Plain comparisons on stored columns: row groups prune by ``block``, and
    partitions by ``bucket``, the block divided by ``bucket_blocks``, where a
    table is partitioned by it.
    """
    start = max(start, first)
    rows = blocks.where((F.col("block") >= start) & (F.col("block") < stop))
    if bucket is None:
        return rows
    return rows.where(F.col(bucket).between(start // bucket_blocks, (stop - 1) // bucket_blocks))


def explode_logs(blocks: DataFrame) -> DataFrame:
    """One row per log of each successful transaction that has a receipt."""
    transactions = blocks.select(
        "block", "hash", "header", F.explode("transactions").alias("tx")
    ).where("tx.status = 1")
    return transactions.select("*", F.explode("tx.logs").alias("log")).select(
        "block",
        F.col("hash").alias("block_hash"),
        F.col("header.parent_hash").alias("parent_hash"),
        F.col("header.seconds").alias("seconds"),
        F.col("header.nanos").alias("nanos"),
        "tx.tx_index",
        F.col("tx.hash").alias("tx_hash"),
        "tx.origin",
        "tx.recipient",
        "tx.gas_price",
        "log.*",
    )


def nest_blocks(logs: DataFrame) -> DataFrame:
    """Inverse of :func:`explode_logs`: logs to transactions to blocks, ordered.

    Groups are bounded by what one block holds.
    """
    log_cols = ["tx_log_index", "address", "topics", "data", "log_index", "ordinal"]
    tx_cols = ["hash", "origin", "recipient", "gas_price", "status"]
    block_cols = ["block", "block_hash", "parent_hash", "seconds", "nanos"]
    transactions = logs.groupBy(
        *block_cols, "tx_index", F.col("tx_hash").alias("hash"), *tx_cols[1:]
    ).agg(F.sort_array(F.collect_list(F.struct(*log_cols))).alias("logs"))
    return (
        transactions.groupBy(*block_cols)
        .agg(
            F.sort_array(F.collect_list(F.struct("tx_index", *tx_cols, "logs"))).alias(
                "transactions"
            )
        )
        .select(
            "block",
            F.col("block_hash").alias("hash"),
            F.struct("parent_hash", "seconds", "nanos").alias("header"),
            "transactions",
        )
    )
