"""What the point-in-time index stores and reads when keys are quiet, hot, NULL or out of range."""

import duckdb
import pyarrow.dataset as ds

from tallyline.operators.fold import Narrow
from tallyline.operators.state_index import StateIndex
from tallyline.plans import state
from tallyline.plans.registry import ORACLES

STATES = "k STRING, block BIGINT, ordinal BIGINT, v_after BIGINT"
ASKED = "k STRING, block BIGINT"


def stored(path):
    """Rows in all files under a folder."""
    return ds.dataset(str(path), format="parquet").count_rows()


def index_of(spark, path, rows, width, span):
    index = StateIndex(str(path), {"k": "STRING"}, {"v": Narrow}, width, span)
    index.write(spark.createDataFrame(rows, STATES))
    return index


def test_quiet_keys_cost_no_row_per_era(spark, tmp_path):
    """Sixty keys change once; one changes in every one of 300 eras."""
    rows = [(f"quiet{i}", i, 1, i) for i in range(60)] + [("busy", 10 * e, 2, e) for e in range(300)]
    index = index_of(spark, tmp_path / "i", rows, 5, 2)
    assert stored(tmp_path / "i") <= 2 * len(rows) + 1
    asked = [(f"quiet{i}", b) for i in (0, 9, 10, 59) for b in (i - 1, i, 60, 1777, 2990, 10**6)]
    found = index.at(spark.createDataFrame(asked + [("busy", 1777)], ASKED)).collect()
    want = {(k, b): None if b < int(k[5:]) else int(k[5:]) for k, b in asked} | {("busy", 1777): 177}
    assert {(r.k, r.block): r.v for r in found} == want and len(found) == len(asked) + 1


def test_state_at_stores_rows_by_changes(spark, tmp_path, monkeypatch):
    """160 pools with two events each, all in eras of their own."""
    events = [
        (i * 5000, None, i % 160, ("signup", "purchase")[i % 2], i + 0.25, '{"k": %d}' % i) for i in range(320)
    ]
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    spark.createDataFrame(events, schema).write.parquet(f"{tmp_path}/t/events.parquet")
    monkeypatch.setattr(state, "new_path", lambda spark, label: str(tmp_path / label))
    got = state.state_at(spark, f"{tmp_path}/t")
    assert stored(tmp_path / "state-index") <= 2 * len(events) + 1
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/t/events.parquet/*.parquet'")
    result = con.execute(ORACLES["state_at"])
    columns = [c[0] for c in result.description]
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(result.fetchall(), key=repr)


def test_a_hot_key_is_not_paired_with_its_probes(spark, tmp_path):
    """A thousand changes and probes of one key in one era: no join, which would make half a million pairs."""
    index = index_of(spark, tmp_path / "i", [("hot", b, 1, 3 * b) for b in range(1000)], 1000, 8)
    found = index.at(spark.createDataFrame([("hot", b) for b in range(1000)] * 2, ASKED))
    assert sorted((r.block, r.v) for r in found.collect()) == sorted([(b, 3 * b) for b in range(1000)] * 2)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_odd_keys_and_blocks(spark, tmp_path):
    """A NULL key equals no key; NULL states and blocks write nothing; before the first block there is nothing."""
    rows = [(None, 5, 1, 50), ("a", None, 1, 60), ("a", 5, 1, None), ("a", 31, 1, 70), ("a", 31, 3, 71), ("a", 95, 1, None)]
    index = index_of(spark, tmp_path / "i", rows, 5, 2)
    asked = [(None, 50), ("a", -50), ("a", -1), ("a", 4), ("a", 30), ("a", 31), ("a", 39), ("a", 94), ("a", 99), ("b", 99)]
    found = index.at(spark.createDataFrame(asked, ASKED)).collect()
    late = {("a", b): 71 for b in (31, 39, 94, 99)}
    assert {(r.k, r.block): r.v for r in found} == dict.fromkeys(asked) | late
