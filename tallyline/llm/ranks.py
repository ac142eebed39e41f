"""Row numbers and running sums over groups that may hold any share of all rows.

A window over a hot group would put the group into one task.  Here a group is
cut into buckets by a hash: buckets are counted (pre-aggregated before the
exchange), the bucket totals are summed up in order, and rows are numbered
inside their bucket only.  The table of totals has one row per group and
bucket; it is the only thing that one task orders per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST_BUCKETS = 256
BUCKET_ROWS = 250_000


def bucket_count(rows: int) -> int:
    """Buckets per group, so that a bucket stays small however many rows there are."""
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


def running(
    df: DataFrame, group: list[str], bucket: str, order: list[Column | str], weight: Column, into: str
) -> DataFrame:
    """``df`` with the sum of ``weight`` over the rows before each row of its group.

    The order is by bucket, then by ``order``.  Group and bucket are never null.
    ``df`` is read twice: pass a written table.  The sum is a BIGINT and exact.
    """
    inner = Window.partitionBy(*group, bucket).orderBy(*order)
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = df.groupBy(*group, bucket).agg(F.sum(weight).alias("_total"))
    offsets = totals.select(
        *group, bucket, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
    )
    placed = df.withColumn(
        into,
        F.coalesce(
            F.sum(weight).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
    )
    return placed.join(offsets, [*group, bucket]).withColumn(
        into, F.col(into) + F.col("_offset")
    ).drop("_offset")
