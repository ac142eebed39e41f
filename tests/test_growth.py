"""What grows with the ledger: folders of a sink, and the logs encoded per landed range."""

import os

import pytest
from pyspark.sql import functions as F

from tallyline.plans import audits, enriched
from tallyline.sources.encoded import encoded_logs
from tallyline.sources.ledger import LEDGER_BLOCK

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def long_ledger(spark, tmp_path_factory):
    """200 events, each 500 blocks after the one before."""
    folder = str(tmp_path_factory.mktemp("long"))
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").where("event_id < 200")
    events.withColumn("event_id", F.col("event_id") * 5000).write.parquet(f"{folder}/events.parquet")
    spark.read.parquet(f"{SF_DIR}/part.parquet").write.parquet(f"{folder}/part.parquet")
    return folder


@pytest.mark.parametrize(
    "module, name",
    [(enriched, "sink_reducer_inputs"), (enriched, "sink_state_probe"), (audits, "sink_nul_audit")],
)
def test_sinks_plan_their_buckets_from_rows(spark, long_ledger, tmp_path, monkeypatch, module, name):
    monkeypatch.setattr(module, "new_path", lambda spark, label: str(tmp_path / label))
    getattr(module, name)(spark, long_ledger)
    (sink,) = os.listdir(tmp_path)
    folders = [f for f in os.listdir(tmp_path / sink) if f.startswith("block_bucket=")]
    assert 0 < len(folders) <= 16


def test_only_the_landed_range_is_encoded(spark):
    part = (F.col("block") >= LEDGER_BLOCK + 20) & (F.col("block") < LEDGER_BLOCK + 50)
    landed = encoded_logs(spark, SF_DIR, part=part)
    whole = encoded_logs(spark, SF_DIR).where(part)
    assert sorted(map(str, landed.collect())) == sorted(map(str, whole.collect()))
    lines = landed._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = [i for i, line in enumerate(lines) if "Generate inline" in line]
    assert len(at) == 1 and not any("Filter" in line for line in lines[: at[0]])
    # The generator gets finished columns.
    assert "unhex" not in lines[at[0]]
