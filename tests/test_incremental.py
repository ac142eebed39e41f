"""The incremental enriched ledger: batches of any cut, faults, late rows, and its state tables."""

import pytest
from pyspark.sql import functions as F

from tallyline.functions.segments import plan_segments
from tallyline.operators.decode import decode, rejected_logs
from tallyline.operators.enrich import enriched_ledger, initialize_tokens
from tallyline.operators.fold import SEGMENT
from tallyline.plans.values import metadata_for
from tallyline.sources.encoded import encoded_logs
from tallyline.sources.ledger import LEDGER_BLOCK
from tallyline.sources.stage import stage
from tallyline.streaming.enriched import EnrichedJob
from tallyline.streaming.state_tables import BUCKETS, StateTable

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def logs(spark):
    return stage(encoded_logs(spark, SF_DIR), "test-logs")


def sorted_rows(df, columns):
    return sorted(map(tuple, df.select(columns).collect()), key=repr)


def test_batches_and_faults_equal_one_run(spark, logs, tmp_path, monkeypatch):
    metadata = lambda events: metadata_for(spark, SF_DIR, events)
    job = EnrichedJob(spark, str(tmp_path), metadata)
    # The first cut is inside a block; the second batch brings old rows again.
    cut = f"block * 100 + ordinal < {(LEDGER_BLOCK + 40) * 100 + 10}"
    job.process(logs.where(cut), 0)
    assert job.committed() == 1
    first = job.rows().count()

    # A fault after the rows and two of the three states were written.
    write = StateTable.write

    def broken(table, batch, changed):
        if table is job.ticks:
            raise RuntimeError("lost")
        write(table, batch, changed)

    second = logs.where(f"NOT ({cut})").unionByName(logs.where(f"block < {LEDGER_BLOCK + 3}"))
    with monkeypatch.context() as patch:
        patch.setattr(StateTable, "write", broken)
        with pytest.raises(RuntimeError, match="lost"):
            job.process(second, 1)
    assert job.committed() == 1 and job.rows().count() == first
    job.process(second, 1)
    job.process(logs.limit(0), 2)
    assert job.committed() == 3 and job.mark(2) == job.mark(1)
    assert job.late().count() == decode(logs.where(f"block < {LEDGER_BLOCK + 3}")).count()

    events = decode(logs)
    events = stage(events.withColumn(SEGMENT, plan_segments(events.select("block")).of()), "test-events")
    whole = enriched_ledger(events, initialize_tokens(events, metadata(events))).drop(SEGMENT)
    assert sorted(job.rows().columns) == sorted(whole.columns)
    assert sorted_rows(job.rows(), whole.columns) == sorted_rows(whole, whole.columns)


def test_state_tables(spark, tmp_path):
    table = StateTable(spark, str(tmp_path), {"a": "BIGINT", "b": "STRING"}, {"v": "BIGINT", "w": "BINARY"}, compact=2)
    state = {}
    assert table.after(-1).count() == 0
    for batch in range(5):
        changed = [(a, "x" if a % 2 else "y", 10 * batch + a if a else None, b"%d" % batch) for a in range(batch, 8, 2)]
        table.write(batch, spark.createDataFrame(changed, table.schema))
        state |= {r[:2]: r[2:] for r in changed}
        got = {tuple(r)[:2]: tuple(r)[2:] for r in table.after(batch).collect()}
        assert {k: (v, bytes(w)) for k, (v, w) in got.items()} == state
    wanted = spark.createDataFrame([(3, "x"), (3, "x"), (4, "x"), (99, "y")], "a BIGINT, b STRING")
    assert [tuple(r)[:2] for r in table.after(4, wanted).collect()] == [(3, "x")]
    # A batch that is run again overwrites its own tables only.
    table.write(4, spark.createDataFrame([(3, "x", 7, None)], table.schema))
    assert table.after(4, wanted).first().v == 7 and table.after(3, wanted).first().v != 7
    # Of a full table only the buckets of the wanted keys are read.
    files = lambda rows: rows.select(F.input_file_name()).distinct().count()
    one = table._full(3, wanted.where("a = 3"))
    assert files(one) == 1 < files(table._full(3, None)) <= BUCKETS
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().toString()


def test_dirty_logs_give_the_same_events_whatever_is_asked_for(spark, logs):
    """A narrow integer outside its type, in a field that the caller leaves out."""
    bad = logs.withColumn("data", F.expr("IF(size(topics) = 4 AND octet_length(data) = 160, "
        "concat(substring(data, 1, 32), repeat(X'7F', 32), substring(data, 65)), data)"))  # fmt: skip
    inits = decode(logs).where("kind = 'Initialize'").count()
    assert inits > 0
    for fields in (["fee", "tick"], ["pool"], ["tick_spacing"]):
        assert decode(bad, fields).where("kind = 'Initialize'").count() == 0
        assert decode(bad, fields).columns[-len(fields) :] == fields
    assert decode(bad).where("kind = 'Initialize'").count() == 0
    assert rejected_logs(bad).where("reason = 'integer out of range'").count() == inits
