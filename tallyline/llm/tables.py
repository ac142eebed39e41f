"""Small helpers for joins and column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_IDS = 1_000_000
ARROW_ROWS = 500
ARROW_BYTES = 4 << 20
SCAN_ROWS = 1_024


def few(ids: DataFrame) -> DataFrame:
    """A written table of ids, broadcast only when it is small; else a merge join."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def small_batches(spark: SparkSession) -> None:
    """Whole texts are read and travel to Python: fewer rows a batch than Spark's defaults, which suit numbers.

    A batch is held several times over, in the JVM's heap, outside it and in the
    Python worker, by every task of an executor; a long session keeps the largest.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    while name in df.columns:
        name = f"_{name}"
    return name
