"""Segments follow the rows, and positions out of range fail."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyline.functions.segments import ROWS_CONF, Segments, plan_segments
from tallyline.operators.audit import BlockRange, in_ranges, missing_anchors
from tallyline.operators.fold import rank
from tallyline.sources.blocks import block_range
from tallyline.streaming import jobs
from tallyline.streaming.jobs import PoolStateJob


def per_segment(spark, blocks, wanted):
    spark.conf.set(ROWS_CONF, str(wanted))
    try:
        segments = plan_segments(blocks)
    finally:
        spark.conf.unset(ROWS_CONF)
    rows = blocks.withColumn("s", segments.of()).groupBy("s").agg(
        F.count(F.lit(1)).alias("n"), F.min("block").alias("lo"), F.max("block").alias("hi")
    )
    found = sorted(rows.collect(), key=lambda r: r.s)
    assert all(a.hi < b.lo for a, b in zip(found, found[1:]))
    return found


@pytest.mark.parametrize("wanted", [20_000, 5_000, 500])
def test_one_far_block_does_not_fill_a_segment(spark, wanted):
    blocks = spark.range(200_000).select("id").union(spark.range(1).select(F.lit(10**12))).toDF("block")
    found = per_segment(spark, blocks, wanted)
    assert max(r.n for r in found) <= max(2 * wanted, 200_000 // 100)


def test_dense_tail(spark):
    """Nine tenths of the rows in the last tenth of the blocks."""
    early = spark.range(10_000).selectExpr("id * 9 AS block")
    late = spark.range(90_000).selectExpr("90000 + id div 9 AS block")
    found = per_segment(spark, early.union(late), 5_000)
    assert max(r.n for r in found) <= 10_000 and len(found) >= 10


def test_segments_of_nothing_and_of_one_block(spark):
    empty = spark.range(0).toDF("block")
    assert plan_segments(empty) == Segments.even(0, 1)
    one = spark.range(100).selectExpr("7L AS block")
    assert Counter(r.s for r in one.withColumn("s", plan_segments(one).of()).collect()) == {0: 100}


def test_positions_out_of_range_fail_without_ansi(spark):
    rows = spark.createDataFrame([(5, 1), (10**18, 1)], "block BIGINT, ordinal BIGINT")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="position out of range"):
            rows.selectExpr(f"max_by(block, {rank(['block', 'ordinal'])}) AS b").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranges_and_buckets_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "blocks")
    rows = spark.range(1000).selectExpr("id AS block", "id div 100 AS bucket")
    rows.write.partitionBy("bucket").parquet(path)
    stored = spark.read.parquet(path)
    ranged = in_ranges(stored, [BlockRange("a", 5, 9), BlockRange("b", 8, 20)])
    assert ranged.count() == 5 + 13
    assert "GreaterThanOrEqual(block,5)" in plan_of(ranged)
    some = block_range(stored, 250, 301, bucket="bucket", bucket_blocks=100)
    assert some.count() == 51 and len(some.inputFiles()) > 0
    files = {f for (f,) in some.select(F.input_file_name()).distinct().collect()}
    assert all("bucket=2" in f or "bucket=3" in f for f in files)
    assert "PartitionFilters: [isnotnull(bucket" in plan_of(some)


def test_missing_anchors(spark):
    kinds = "tx_hash STRING, tx_index INT, log_index INT"
    anchors = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], kinds)
    events = spark.createDataFrame([("a", 1, 1), ("a", 1, 1), ("c", 1, 3)], kinds)
    assert [tuple(r) for r in missing_anchors(anchors, events).collect()] == [("b", 1, 2)]


def test_a_block_split_over_batches_reaches_the_state(spark, tmp_path):
    columns = "block BIGINT, ordinal BIGINT, pool BIGINT, kind STRING, tick BIGINT, liquidity BIGINT, delta BIGINT, lower BIGINT, upper BIGINT"
    rows = [(10, i, 1, "Swap", i, 100 + i, None, None, None) for i in range(12)]
    df = spark.createDataFrame(rows, columns)
    job = PoolStateJob(spark, str(tmp_path / "job"), df.schema)
    job.process(df.where("ordinal < 6"), 0)
    job.process(df.where("ordinal >= 6"), 1)
    assert job.late(2).count() == 0 and job.rows(2).count() == 12
    (state,) = job.snapshot(1).collect()
    assert (state.tick, state.tx_count, state.liquidity) == (11, 12, 111)
    job.process(df.where("ordinal = 3"), 2)
    assert job.late(3).count() == 1 and job.snapshot(2).collect() == [state]


def test_a_batch_writes_state_of_the_pools_it_touches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "COMPACT", 3)
    columns = "block BIGINT, ordinal BIGINT, pool BIGINT, kind STRING, tick BIGINT, liquidity BIGINT, delta BIGINT, lower BIGINT, upper BIGINT"
    rows = [(b, 1, p, "Swap", b, 10 * b, None, None, None) for b in range(1, 8) for p in ([1, 2, 3] if b == 1 else [b % 3 + 1])]
    df = spark.createDataFrame(rows, columns)
    job = PoolStateJob(spark, str(tmp_path / "job"), df.schema)
    want = {}
    for batch in range(7):
        part = df.where(F.col("block") == batch + 1)
        job.process(part, batch)
        for r in part.collect():
            want[r.pool] = (r.tick, want.get(r.pool, (0, 0, 0))[1] + 1, r.liquidity)
        got = {r.pool: (r.tick, r.tx_count, r.liquidity) for r in job.snapshot(batch).collect()}
        assert got == want
        assert spark.read.parquet(str(tmp_path / f"job/deltas/batch={batch}")).count() == part.count()
    assert job.rows(7).count() == df.count()
