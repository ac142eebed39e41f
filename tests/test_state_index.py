"""The point-in-time index against a plain scan, its edges, and what a lookup reads."""

import random

import pytest

from tallyline.operators.fold import Narrow, Wide
from tallyline.operators.state_index import StateIndex

SCHEMA = "k STRING, part BIGINT, block BIGINT, ordinal BIGINT, v_after BIGINT, w_after BINARY, other INT"


def word(n):
    return None if n is None else n.to_bytes(32, "big", signed=True)


@pytest.mark.parametrize(("width", "span"), [(1, 1), (7, 3), (10, 4), (1000, 8)])
def test_index_matches_a_scan(spark, tmp_path, width, span):
    rng = random.Random(width)
    rows, state = [], {}
    for block in sorted(rng.choices(range(400), k=150)):
        key = ("hot", 1) if rng.random() < 0.5 else (rng.choice("abc"), rng.randint(0, 1))
        v, w = state.get(key, (None, None))
        state[key] = (rng.randint(-9, 9) if rng.random() < 0.6 else v, rng.randint(-(2**90), 2**90) if rng.random() < 0.5 else w)
        rows.append((*key, block, len(rows), *state[key]))
    index = StateIndex(str(tmp_path / "i"), {"k": "STRING", "part": "BIGINT"}, {"v": Narrow, "w": Wide}, width, span)
    index.write(spark.createDataFrame([(*r[:5], word(r[5]), 0) for r in rows], SCHEMA))
    asked = [(k, p, b, "x") for k in ("hot", "a", "b", "c", "none") for p in (0, 1) for b in (-5, 0, 3, 57, 199, 200, 398, 399, 400, 10**9)]
    found = index.at(spark.createDataFrame(asked + asked[:3], "k STRING, part BIGINT, block BIGINT, v STRING"))
    assert found.columns == ["k", "part", "block", "v", "w"] and found.count() == len(asked) + 3
    for r in found.collect():
        past = [x for x in rows if x[:2] == (r.k, r.part) and x[2] <= r.block]
        want = past[-1][4:] if past else (None, None)
        assert (r.v, r.w) == (want[0], word(want[1])), (r, past[-1:] )


def test_empty_index_and_no_probes(spark, tmp_path):
    index = StateIndex(str(tmp_path / "i"), {"k": "STRING", "part": "BIGINT"}, {"v": Narrow, "w": Wide})
    index.write(spark.createDataFrame([], SCHEMA))
    probes = spark.createDataFrame([("a", 1, 5)], "k STRING, part BIGINT, block BIGINT")
    assert index.at(probes).first().v is None
    assert index.at(probes.limit(0)).count() == 0


def test_a_lookup_reads_few_rows(spark, tmp_path):
    """Partitions of other keys and buckets of other times are pruned by the scan."""
    rows = spark.range(40_000).selectExpr(
        "CAST(id % 50 AS STRING) AS k", "0L AS part", "id div 10 AS block", "id % 10 AS ordinal", "id AS v_after",
        "CAST(NULL AS BINARY) AS w_after", "0 AS other",
    )
    index = StateIndex(str(tmp_path / "i"), {"k": "STRING", "part": "BIGINT"}, {"v": Narrow, "w": Wide}, width=50, span=4)
    index.write(rows)
    found = index.at(spark.createDataFrame([("7", 0, 2111)], "k STRING, part BIGINT, block BIGINT"))
    assert found.first().v == 21107
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(lane" in plan and "GreaterThanOrEqual(bucket,40)" in plan
    everything = index.read(spark).count()
    read = index.read(spark).where("lane = (SELECT lane FROM parquet.`%s/rows` WHERE k = '7' LIMIT 1)" % index.path)
    assert read.where("bucket BETWEEN 40 AND 42").count() < everything / 100
