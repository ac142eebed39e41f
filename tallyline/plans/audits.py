"""Queries of the audit and sink families."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.functions import words as W
from tallyline.functions.segments import block_span
from tallyline.operators import audit as A
from tallyline.operators.decode import decode, match_kind, route, to_events
from tallyline.operators.enrich import EVENT, initialize_tokens
from tallyline.operators.fold import SEGMENT, with_sql
from tallyline.plans.decode import SOURCE_SQL, key_sql, keys
from tallyline.plans.registry import ORACLES, query
from tallyline.plans.state import POOL_ID, shard_of
from tallyline.plans.values import META_SQL, metadata_for, segmented_events
from tallyline.sources.blocks import explode_logs
from tallyline.sources.catalog import KINDS
from tallyline.sources.encoded import encoded_logs
from tallyline.sources.ledger import (
    LEDGER_BLOCK,
    LEDGER_SQL,
    ledger,
    ledger_blocks,
    ledger_segments,
    segmented_ledger,
)
from tallyline.sources.sinks import fixture_blocks, write_and_read, write_events, write_fixture
from tallyline.sources.stage import new_path, stage

RANGES = (
    A.BlockRange("opening", LEDGER_BLOCK, LEDGER_BLOCK + 40),
    A.BlockRange("single", LEDGER_BLOCK + 77, LEDGER_BLOCK + 77),
    A.BlockRange("tail", LEDGER_BLOCK + 60, LEDGER_BLOCK + 10_000_000),
    A.BlockRange("before", LEDGER_BLOCK - 50, LEDGER_BLOCK - 1),
)
RANGES_SQL = (
    "(VALUES "
    + ", ".join(f"('{r.name}', {r.first}, {r.last})" for r in RANGES)
    + ') x("range", first, last)'
)


def _occurrences(spark, sf_dir):
    events = stage(segmented_events(spark, sf_dir).where("kind = 'Initialize'"), "inits")
    tokens = initialize_tokens(events, metadata_for(spark, sf_dir, events))
    return A.nul_occurrences(events.join(tokens, EVENT))


NUL_SQL = META_SQL + """, NU AS (
  SELECT block, ordinal, side, token, 'name' AS field, name AS text FROM M
  UNION ALL SELECT block, ordinal, side, token, 'symbol', symbol FROM M),
NN AS (SELECT * FROM NU WHERE instr(text, chr(0)) > 0)
"""
CORRECTED_SQL = "left(text, instr(text, chr(0)) - 1)"


@query(
    "nul_audit",
    NUL_SQL
    + f"""SELECT block, {key_sql('block', 64)} AS block_hash,
  {key_sql('block * 10 + (ordinal // 2) // 4', 64)} AS tx_hash, ordinal,
  {key_sql('token')} AS token, field, lower(hex(text)) AS raw_utf8,
  {CORRECTED_SQL} AS corrected_value
FROM NN""",
)
def nul_audit(spark, sf_dir):
    """Token texts of each Initialize that contain U+0000."""
    return _occurrences(spark, sf_dir).selectExpr(
        "block", *keys("block_hash", "tx_hash"), "ordinal", *keys("token"), "field",
        "lower(hex(raw_utf8)) AS raw_utf8", "corrected_value",
    )


@query("sink_nul_audit", ORACLES["nul_audit"])
def sink_nul_audit(spark, sf_dir):
    """NUL occurrences written in block buckets and read back, raw bytes as they are."""
    segments = ledger_segments(spark, sf_dir)
    rows = _occurrences(spark, sf_dir).withColumn("block_bucket", segments.of())
    back = write_and_read(rows, new_path(spark, "nul-audit"), "block_bucket")
    return back.selectExpr(
        "block", *keys("block_hash", "tx_hash"), "ordinal", *keys("token"), "field",
        "lower(hex(raw_utf8)) AS raw_utf8", "corrected_value",
    )


@query(
    "nul_corrections",
    NUL_SQL
    + f"""SELECT DISTINCT {key_sql('token')} AS token, field, lower(hex(text)) AS raw_utf8,
  {CORRECTED_SQL} AS corrected_value FROM NN""",
)
def nul_corrections(spark, sf_dir):
    """Distinct corrections."""
    return A.nul_corrections(_occurrences(spark, sf_dir)).selectExpr(
        *keys("token"), "field", "lower(hex(raw_utf8)) AS raw_utf8", "corrected_value"
    )


SPAN_SQL = "SELECT unnest(range(min(block), max(block) + 1)) AS block FROM L"


@query(
    "sink_dense_frames",
    NUL_SQL
    + f"""SELECT block, count(text) AS n FROM ({SPAN_SQL}) LEFT JOIN NN USING (block)
GROUP BY block""",
)
def sink_dense_frames(spark, sf_dir):
    """A frame for every block of the range, empty ones included."""
    low, high, _ = block_span(ledger_blocks(spark, sf_dir))
    return A.dense_counts(spark, _occurrences(spark, sf_dir), low, high + 1)


@query(
    "coverage_gaps",
    LEDGER_SQL
    + f"""SELECT block, CASE WHEN n = 0 THEN 'gap' ELSE 'duplicate' END AS problem, n
FROM (SELECT block, count(event_id) AS n FROM ({SPAN_SQL})
      LEFT JOIN (SELECT block, event_id FROM L WHERE kind = 'Swap') USING (block)
      GROUP BY block)
WHERE n <> 1""",
)
def coverage_gaps(spark, sf_dir):
    """Blocks without a swap, and with more than one, over the whole range."""
    low, high, _ = block_span(ledger_blocks(spark, sf_dir))
    swaps = ledger(spark, sf_dir).where("kind = 'Swap'")
    return A.coverage_exceptions(A.dense_counts(spark, swaps, low, high + 1))


@query(
    "coverage_islands",
    LEDGER_SQL
    + """, B AS (SELECT DISTINCT block FROM L WHERE kind = 'Swap'),
N AS (SELECT block, block - row_number() OVER (ORDER BY block) AS g FROM B)
SELECT min(block) AS first_block, max(block) AS last_block, count(*) AS blocks FROM N GROUP BY g""",
)
def coverage_islands(spark, sf_dir):
    """Runs of consecutive blocks with a swap."""
    blocks = segmented_ledger(spark, sf_dir).where("kind = 'Swap'").select("block", SEGMENT)
    return A.islands(blocks.distinct()).select("first_block", "last_block", "blocks")


KIND_COUNTS_SQL = ", ".join(
    f"count(event_id) FILTER (kind = '{k}') AS {k}" for k in KINDS
)


@query(
    "range_kind_pivot",
    LEDGER_SQL
    + f"""SELECT "range", {KIND_COUNTS_SQL}, true AS as_expected
FROM {RANGES_SQL} LEFT JOIN L ON block BETWEEN first AND last GROUP BY "range" """,
)
def range_kind_pivot(spark, sf_dir):
    """Decoded counts per range and kind, compared with the expected ones."""
    observed = A.range_kind_counts(decode(encoded_logs(spark, sf_dir), ["fee"]), RANGES)
    expected = A.range_kind_counts(ledger(spark, sf_dir), RANGES).withColumnsRenamed(
        {k: f"expected_{k}" for k in KINDS}
    )
    same = " AND ".join(f"{k} = expected_{k}" for k in KINDS)
    return observed.join(expected, "range").selectExpr(
        "range", *KINDS, f"{same} AS as_expected"
    )


@query(
    "range_boundaries",
    LEDGER_SQL
    + f"""SELECT "range", min(block) AS first_block, {key_sql('min(block)', 64)} AS first_hash,
  max(block) AS last_block, {key_sql('max(block)', 64)} AS last_hash
FROM {RANGES_SQL} JOIN L ON block BETWEEN first AND last GROUP BY "range" """,
)
def range_boundaries(spark, sf_dir):
    """Hashes at both ends of each range."""
    rows = A.range_boundaries(encoded_logs(spark, sf_dir), RANGES)
    return rows.selectExpr(
        "range", "first_block", *keys("first_hash"), "last_block", *keys("last_hash")
    )


@query(
    "range_block_counts",
    LEDGER_SQL
    + f"""SELECT "range", count(DISTINCT block) AS blocks
FROM {RANGES_SQL} JOIN L ON block BETWEEN first AND last
WHERE kind = 'Transfer' GROUP BY "range" """,
)
def range_block_counts(spark, sf_dir):
    """Blocks with a transfer per range."""
    rows = ledger(spark, sf_dir).where("kind = 'Transfer'")
    return A.range_block_counts(rows, RANGES)


@query(
    "anchor_anti",
    LEDGER_SQL
    + f"""SELECT {key_sql('block * 10 + slot // 4', 64)} AS tx_hash, slot // 4 AS tx_index,
  slot + 10 AS log_index
FROM L WHERE kind = 'LogCreatePrivateHook' AND k % 5 = 0""",
)
def anchor_anti(spark, sf_dir):
    """Anchors that no event matches; every fifth one is wrong on purpose."""
    anchors = encoded_logs(spark, sf_dir)
    hooks = match_kind(route(anchors)).where("kind = 'LogCreatePrivateHook'")
    wrong = f"IF({W.bytes_to_bigint('topics[2]', 26, 7)} % 5 = 1, 10, 0)"
    expected = hooks.selectExpr("tx_hash", "tx_index", f"log_index + {wrong} AS log_index")
    missing = A.missing_anchors(expected, decode(anchors, ["fee"]))
    return missing.selectExpr(*keys("tx_hash"), "tx_index", "log_index")


@query(
    "order_violations",
    LEDGER_SQL
    + """, V AS (SELECT block, slot, CASE WHEN k % 50 = 0 THEN slot - 3 ELSE slot END AS t FROM L),
P AS (SELECT *, lag(t) OVER (PARTITION BY block ORDER BY slot) AS previous FROM V)
SELECT block, slot AS position, t AS trigger_order, previous FROM P
WHERE previous >= t OR t <> slot""",
)
def order_violations(spark, sf_dir):
    """Trigger order must rise inside a block and equal the log index."""
    rows = ledger(spark, sf_dir).selectExpr(
        "block", "slot AS position", "slot AS log_index",
        "IF(k % 50 = 0, slot - 3, slot) AS trigger_order",
    )
    return A.order_violations(rows).select("block", "position", "trigger_order", "previous")


@query(
    "row_contracts",
    LEDGER_SQL
    + """SELECT kind, count(*) AS n, CAST(0 AS BIGINT) AS bad_payload,
  CAST(0 AS BIGINT) AS bad_address, count(*) FILTER (block % 17 = 0) AS bad_origin
FROM L GROUP BY kind""",
)
def row_contracts(spark, sf_dir):
    """One payload, the source's address and a 20-byte origin; some origins are cut."""
    logs = with_sql(
        encoded_logs(spark, sf_dir),
        {"origin": "IF(block % 17 = 0, substring(origin, 2, 19), origin)"},
    )
    return A.row_contracts(to_events(decode(logs)))


@query(
    "run_differential",
    LEDGER_SQL
    + f"""SELECT block, ordinal, {SOURCE_SQL} AS first_source,
  CASE WHEN k % 25 <> 9 THEN {SOURCE_SQL} END AS second_source,
  tick AS first_tick, CASE WHEN k % 25 <> 9 THEN tick + 1 END AS second_tick
FROM L WHERE k % 25 = 9 OR (k % 25 = 4 AND tick IS NOT NULL)""",
)
def run_differential(spark, sf_dir):
    """Two decoder runs compared record by record; the second one drops and shifts some."""
    logs = encoded_logs(spark, sf_dir)
    first = decode(logs, ["tick"])
    marks = ledger(spark, sf_dir).select("block", "ordinal", "k")
    second = first.join(marks, ["block", "ordinal"]).where("k % 25 <> 9")
    second = with_sql(second, {"tick": "IF(k % 25 = 4, tick + 1, tick)"})
    rows = A.differences(first, second, ["block", "ordinal"], ["source", "kind", "tick"])
    return rows.selectExpr(
        "block", "ordinal", "first_run.source AS first_source",
        "second_run.source AS second_source", "first_run.tick AS first_tick",
        "second_run.tick AS second_tick",
    )


@query(
    "shard_histogram",
    LEDGER_SQL
    + """, H AS (SELECT CAST(('0x' || substr(md5(CAST(pool AS VARCHAR)), 1, 2)) AS BIGINT) AS b
FROM L)
SELECT b % 64 AS shard, count(*) AS n, count(DISTINCT b) AS byte_values FROM H GROUP BY b % 64""",
)
def shard_histogram(spark, sf_dir):
    """Rows and first-byte values per shard."""
    rows = with_sql(
        ledger(spark, sf_dir),
        {"shard": shard_of(POOL_ID), "first_byte": W.bytes_to_bigint(POOL_ID, 1, 1)},
    )
    return A.shard_histogram(rows)


@query(
    "kinds_represented",
    LEDGER_SQL
    + f"""SELECT x.kind, count(event_id) AS n
FROM (VALUES {", ".join(f"('{k}')" for k in KINDS)}) x(kind) LEFT JOIN L ON L.kind = x.kind
GROUP BY x.kind""",
)
def kinds_represented(spark, sf_dir):
    """Events per expected kind."""
    return A.kinds_represented(decode(encoded_logs(spark, sf_dir), ["fee"]))


@query(
    "sink_nested_blocks",
    LEDGER_SQL
    + """, F AS (SELECT kind, min(event_id) AS event_id FROM L GROUP BY kind),
T AS (SELECT DISTINCT block, slot // 4 AS tx FROM L JOIN F USING (event_id))
SELECT L.block, tx AS tx_index, slot AS log_index, kind
FROM L JOIN T ON T.block = L.block AND T.tx = L.slot // 4""",
)
def sink_nested_blocks(spark, sf_dir):
    """Transactions of each kind's first log, nested, written as JSON, read back."""
    logs = with_sql(encoded_logs(spark, sf_dir), {"status": "1L"})
    blocks = fixture_blocks(logs, decode(logs, ["fee"]))
    back = write_fixture(blocks, new_path(spark, "fixture"))
    return decode(explode_logs(back), ["fee"]).select("block", "tx_index", "log_index", "kind")


@query(
    "sink_roundtrip",
    LEDGER_SQL
    + f"""SELECT block, ordinal, kind, {SOURCE_SQL} AS source, CAST(tick AS VARCHAR) AS tick,
  CAST(delta AS VARCHAR) AS delta FROM L""",
)
def sink_roundtrip(spark, sf_dir):
    """Nested events written in block buckets and read back."""
    segments = ledger_segments(spark, sf_dir)
    events = to_events(decode(encoded_logs(spark, sf_dir)))
    flat = events.withColumns(
        {"block": F.col("block_ref.number"), "ordinal": F.col("log_ref.ordinal")}
    ).withColumn("block_bucket", segments.of())
    path = new_path(spark, "events")
    write_events(flat, path, "block_bucket")
    back = spark.read.schema(flat.schema).parquet(path)
    return back.selectExpr(
        "block", "ordinal", "kind", "source",
        "coalesce(initialize.tick, swap.tick) AS tick",
        "modify_liquidity.liquidity_delta AS delta",
    )


TARGET = (LEDGER_BLOCK, LEDGER_BLOCK + 90)


@query(
    "coverage_target",
    LEDGER_SQL
    + f""", S AS (SELECT block FROM L WHERE kind = 'Swap'),
N AS (SELECT b AS block, count(S.block) AS n FROM range({TARGET[0]}, {TARGET[1]}) t(b)
      LEFT JOIN S ON S.block = b GROUP BY b),
O AS (SELECT count(*) AS outside, max(block) AS last_outside FROM S
      WHERE block < {TARGET[0]} OR block >= {TARGET[1]})
SELECT count(*) AS target_blocks, count(*) FILTER (n > 0) AS present, count(*) FILTER (n = 0) AS gaps,
  count(*) FILTER (n > 1) AS duplicates, min(CASE WHEN n <> 1 THEN block END) AS first_exception,
  max(outside) AS outside, max(last_outside) AS last_outside,
  max(outside) = 0 AND min(CASE WHEN n <> 1 THEN block END) IS NULL AS as_expected
FROM N, O""",
)
def coverage_target(spark, sf_dir):
    """Swaps against a fixed target of 90 blocks, with what lies outside it."""
    swaps = ledger(spark, sf_dir).where("kind = 'Swap'")
    return A.coverage_report(spark, swaps, *TARGET, None)


def block_hash(block: int) -> str:
    """The test ledger's hash of a block."""
    return f"{block:064x}"


# The second range expects a wrong hash at its end, the last one a block that is absent.
CHECKED_RANGES = (
    A.BlockRange("right", LEDGER_BLOCK + 1, LEDGER_BLOCK + 40, block_hash(LEDGER_BLOCK + 1), block_hash(LEDGER_BLOCK + 40)),
    A.BlockRange("wrong", LEDGER_BLOCK + 41, LEDGER_BLOCK + 50, block_hash(LEDGER_BLOCK + 41), block_hash(1)),
    A.BlockRange("absent", LEDGER_BLOCK - 9, LEDGER_BLOCK + 50, None, None),
)
ENDS_SQL = "(VALUES " + ", ".join(
    f"('{r.name}', '{side}', {block}, {f"'0x{h}'" if h else 'NULL'})"
    for r in CHECKED_RANGES
    for side, block, h in (("first", r.first, r.first_hash), ("last", r.last, r.last_hash))
) + ') e("range", side, block, expected)'


@query(
    "range_boundary_check",
    LEDGER_SQL
    + f""", H AS (SELECT DISTINCT block, {key_sql('block', 64)} AS block_hash FROM L)
SELECT "range", side, e.block, block_hash, expected,
  block_hash IS NOT NULL AND (expected IS NULL OR expected = block_hash) AS as_expected
FROM {ENDS_SQL} LEFT JOIN H USING (block)""",
)
def range_boundary_check(spark, sf_dir):
    """Hashes at the ends of each range against the expected ones."""
    rows = A.boundary_check(encoded_logs(spark, sf_dir), CHECKED_RANGES)
    return rows.selectExpr("range", "side", "block", *keys("block_hash", "expected"), "as_expected")


@query(
    "range_differential",
    LEDGER_SQL
    + f""", R AS (SELECT "range", L.* FROM {RANGES_SQL} JOIN L ON block BETWEEN first AND last)
SELECT x."range", count(DISTINCT block) AS blocks, count(event_id) AS first_records,
  count(event_id) FILTER (k % 25 <> 9) + count(event_id) FILTER (k % 25 = 3) AS second_records,
  count(event_id) FILTER (k % 25 = 3) AS duplicates,
  count(event_id) FILTER (k % 25 IN (3, 9) OR (k % 25 = 4 AND tick IS NOT NULL)) AS different,
  count(event_id) FILTER (k % 25 IN (3, 9) OR (k % 25 = 4 AND tick IS NOT NULL)) = 0 AS agrees
FROM {RANGES_SQL} LEFT JOIN R ON R."range" = x."range" GROUP BY x."range" """,
)
def range_differential(spark, sf_dir):
    """Two runs per range; the second one drops, shifts and repeats some records."""
    first = ledger(spark, sf_dir).select("block", "ordinal", "kind", "tick", "k")
    second = with_sql(
        first.where("k % 25 <> 9"), {"tick": "IF(k % 25 = 4, tick + 1, tick)"}
    )
    second = second.unionByName(first.where("k % 25 = 3"))
    return A.range_differential(first, second, ["block", "ordinal"], ["kind", "tick"], RANGES)
