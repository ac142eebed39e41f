"""Decode of hand-encoded logs: golden values, bounds, order, rejects, metadata."""

import pytest

from tallyline.functions import words as W
from tallyline.operators import decode as D
from tallyline.operators import metadata as M
from tallyline.sources.blocks import BLOCK_SCHEMA, block_range, explode_logs
from tallyline.sources.catalog import KINDS, REGISTRY, SIGNATURES

ADDRESS = {s.name: bytes.fromhex(s.address) for s in REGISTRY}
SIGNATURE = {s.kind: s for s in SIGNATURES}
ZERO = bytes(20)


def word(v):
    return v if isinstance(v, bytes) else (v % 2**256).to_bytes(32, "big")


def log(kind, topics, data, index, address=None):
    s = SIGNATURE[kind]
    return (
        ADDRESS[s.source] if address is None else address,
        [bytes.fromhex(s.topic0), *map(word, topics)],
        b"".join(map(word, data)) if isinstance(data, list) else data,
        index, index, 2 * index + 1,
    )


def block(number, logs, status=1, header=True):
    tx = (14, word(1), ZERO, ZERO, None, status, logs)
    return (number, word(number), (word(number - 1), 1000, 0) if header else None, [tx])


POOL = bytes(range(32))
GOLDEN = [
    block(26990279, [log("Swap", [POOL, 7], [
        25427416856319646, -84025861277846253634964839, 4535189285798471097032398482702336,
        921080160283192902881622, 219111, 10000], 23)]),
    block(26990280, [log("ModifyLiquidity", [POOL, 7], [32800, 42600, 0, 10862], 177)]),
    block(26990373, [
        log("ModifyLiquidity", [POOL, 7], [150720, 155160, 2882277711237270539, 12611], 146),
        log("Transfer", [0, 9, 0x3143], [], 145),
    ]),
    block(26990520, [log("Initialize", [POOL, 0, 5], [
        10000, 200, 0, 53659041625150630948687640983076363, 268530], 265)]),
    block(28626556, [log("LogCreatePrivateHook", [3, 4], [11], 194)]),
    block(31211085, [log("Unsubscription", [0x1090E, 8], [], 121)]),
    block(31259107, [log("Subscription", [0x10BAF, 8], [], 101)], header=False),
]


@pytest.fixture(scope="module")
def events(spark):
    return D.decode(explode_logs(spark.createDataFrame(GOLDEN, BLOCK_SCHEMA))).cache()


def test_all_kinds_in_order(events):
    rows = D.canonical_order(D.canonical_sequence(events)).collect()
    assert {r.kind for r in rows} == set(KINDS)
    assert [(r.block, r.log_index) for r in rows] == sorted((r.block, r.log_index) for r in rows)
    assert [r.event_seq for r in rows if r.block == 26990373] == [1, 2]


def test_golden_swap_and_initialize(events):
    rows = {r.kind: r for r in D.to_events(events).collect()}
    swap, init = rows["Swap"].swap, rows["Initialize"].initialize
    assert (swap.amount0, swap.amount1) == ("25427416856319646", "-84025861277846253634964839")
    assert swap.sqrt_price_x96 == "4535189285798471097032398482702336"
    assert (swap.liquidity, swap.tick, swap.fee) == ("921080160283192902881622", "219111", "10000")
    assert init.sqrt_price_x96 == "53659041625150630948687640983076363"
    assert (init.fee, init.tick_spacing, init.tick) == ("10000", "200", "268530")
    assert bytes(init.currency0) == ZERO and bytes(init.hooks) == ZERO
    assert rows["Subscription"].subscription.token_id == str(0x10BAF)
    assert rows["Transfer"].swap is None


def test_missing_header_and_gas_price(events):
    row = D.to_events(events).where("kind = 'Subscription'").first()
    assert row.block_ref.timestamp_seconds == 0
    assert bytes(row.block_ref.parent_hash) == b""
    assert row.transaction_ref.gas_price == "0"


def test_bounds_and_rejects(spark):
    low, high = -(2**127), 2**127 - 1
    swap = [low, high, 1, 1, 8388607, 0]
    good = [log("Swap", [POOL, 7], swap, 9),
            log("Initialize", [POOL, 1, 2], [1, -8388608, 0, 1, 8388607], 4)]
    cut = log("Swap", [POOL, 7], bytes(31), 5)
    foreign = log("Swap", [POOL, 7], swap, 6, address=ZERO)
    bare = (ADDRESS["POOL_MANAGER"], [], b"", 7, 7, 15)
    arity = log("Transfer", [1, 2], [], 8)
    logs = explode_logs(
        spark.createDataFrame([block(30_000_000, [*good, cut, foreign, bare, arity])], BLOCK_SCHEMA)
    )
    rows = D.canonical_order(D.decode(logs)).selectExpr(
        "log_index", "tick", "tick_spacing", f"{W.word_text('amount0')} AS a0",
        f"{W.word_text('amount1')} AS a1",
    ).collect()
    assert [r.log_index for r in rows] == [4, 9]
    assert (rows[0].tick_spacing, rows[0].tick) == (-8388608, 8388607)
    assert (rows[1].a0, rows[1].a1) == (str(low), str(high))
    assert {r.log_index for r in D.rejected_logs(logs).collect()} == {5, 6, 7, 8}


def test_failed_transactions_ranges_and_start_blocks(spark):
    swap = log("Swap", [POOL, 7], [1, 1, 1, 1, 1, 1], 1)
    blocks = spark.createDataFrame(
        [block(25_350_987, [swap]), block(25_350_988, [swap]), block(25_350_989, [swap], status=0)],
        BLOCK_SCHEMA,
    )
    assert [r.block for r in D.decode(explode_logs(blocks)).collect()] == [25_350_988]
    assert block_range(blocks, 25_350_980, 25_350_989, 25_350_988).count() == 1


def dynamic(text):
    raw = text.encode()
    return word(32) + word(len(raw)) + raw.ljust(-(-len(raw) // 32) * 32, b"\0")


@pytest.mark.parametrize(
    ("raw", "failed", "expected"),
    [
        (dynamic("USDC"), False, "USDC"),
        (dynamic("a\0b"), False, "a\0b"),
        (dynamic(""), False, ""),
        (b"WETH".ljust(32, b"\0"), False, "WETH"),
        (b"\xff\xfeA".ljust(32, b"\0"), False, "��A"),
        (word(1), False, None),
        (b"", False, None),
        (b"short", False, None),
        (dynamic("USDC"), True, None),
    ],
)
def test_text_fallbacks(spark, raw, failed, expected):
    df = spark.createDataFrame([(raw, failed)], "raw binary, failed boolean")
    assert df.selectExpr(f"{M.decode_text('raw', 'failed')} AS t").first().t == expected


def test_decimals_limit_and_defaults(spark):
    calls = []
    for token, decimals in ((b"\1" * 20, 254), (b"\2" * 20, 255)):
        calls += [
            (5, token, "symbol", False, dynamic("S")), (5, token, "name", True, b""),
            (5, token, "totalSupply", False, word(2**255 + 1)),
            (5, token, "decimals", False, word(decimals)),
        ]
    metadata = M.decode_metadata(
        spark.createDataFrame(
            calls, "block bigint, token binary, field string, failed boolean, raw binary"
        )
    )
    inits = spark.createDataFrame(
        [(5, 1, b"\1" * 20, b"\2" * 20), (5, 3, ZERO, b"\3" * 20)],
        "block bigint, ordinal bigint, currency0 binary, currency1 binary",
    )
    rows = {bytes(r.token): r for r in M.token_rows(inits, metadata).collect()}
    known, limit = rows[b"\1" * 20], rows[b"\2" * 20]
    assert (known.symbol, known.name, known.decimals) == ("S", "unknown", 254)
    assert known.total_supply == str(2**255 + 1)
    assert limit.decimals is None
    assert (rows[ZERO].symbol, rows[ZERO].name, rows[ZERO].decimals) == ("ETH", "Ethereum", 18)
    assert (rows[b"\3" * 20].symbol, rows[b"\3" * 20].decimals) == ("unknown", None)


def test_shards_and_partitions(spark):
    from tallyline.plans.enriched import partition_of
    from tallyline.plans.state import shard_of

    df = spark.createDataFrame([(bytes([b, 9]),) for b in range(256)] + [(b"",)], "id binary")
    rows = df.selectExpr("id", f"{shard_of('id')} AS s", f"{partition_of('id')} AS p").collect()
    counts = {}
    for r in rows[:256]:
        counts[r.s] = counts.get(r.s, 0) + 1
        assert r.p == bytes(r.id)[0] % 64 // 16
    assert len(counts) == 64 and set(counts.values()) == {4}
    assert (rows[256].s, rows[256].p) == (0, 0)
