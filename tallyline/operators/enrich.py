"""The enriched ledger: every event with its state and derived values.

Exchanges, in terms of the ledger:

* pool rows, narrow, on (pool, segment) for all pool states;
* change rows, twice each, on (pool, tick, segment) for tick states;
* Initialize rows on token for decimals;
* everything on (block, ordinal) to meet the payload, which moves once.

No exchange is keyed on a pool, token or tick alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyline.functions import words as W
from tallyline.operators.decode import to_events
from tallyline.operators.fold import SEGMENT, Put, Wide, with_sql
from tallyline.operators.lookup import TICK_VALUES, nest_ticks, tick_deltas
from tallyline.operators.metadata import by_side, token_decimals, token_rows
from tallyline.operators.pool_state import pool_events, pool_states, with_count
from tallyline.operators.snapshot import drop_seed, with_seed
from tallyline.operators.valuation import (
    pool_prices,
    position_amounts,
    tick_dimension,
    token_amounts,
    with_bound_ratios,
)

EVENT = ["block", "ordinal"]
STATE_VERSION = 3
TICK_ONLY_VERSION = 0
_POOL_COLUMNS = [
    *EVENT, SEGMENT, "pool", "kind", "tick", "price", "liquidity", "delta", "lower", "upper",
    "amount0", "amount1",
]


TOKEN_VALUES = ["symbol", "name", "total_supply", "decimals", "pool_decimals"]


def initialize_token_rows(
    events: DataFrame, metadata: DataFrame, seeds: DataFrame | None = None
) -> DataFrame:
    """Metadata and effective decimals, one row per Initialize and side.

    Every wanted token needs a response to each call in ``metadata``.
    """
    inits = events.where("kind = 'Initialize'").select(
        *EVENT, SEGMENT, "currency0", "currency1"
    )
    return token_decimals(token_rows(inits, metadata, complete=True), seeds)


def initialize_tokens(events: DataFrame, metadata: DataFrame) -> DataFrame:
    """Both tokens' metadata and effective decimals, one row per Initialize."""
    return by_side(initialize_token_rows(events, metadata), EVENT, TOKEN_VALUES)


def pool_values(
    events: DataFrame, tokens: DataFrame, seeds: DataFrame | None = None
) -> DataFrame:
    """Pool states and derived values per pool event.

    Only the few Initialize rows carry decimals, so only they meet the token
    join; the rest of the ledger passes by.  ``seeds`` are ledger rows with the
    states of pools (tick, price, tx_count, liquidity, d0, d1) before all others.
    """
    narrow = pool_events(events).select(*_POOL_COLUMNS)
    inits = narrow.where("kind = 'Initialize'").join(
        tokens.select(*EVENT, "pool_decimals0", "pool_decimals1"), EVENT, "left"
    )
    rows = narrow.where("kind <> 'Initialize'").unionByName(inits, allowMissingColumns=True)
    rows = with_count(rows)
    if seeds is not None:
        names = {"tx_count": "touch", "d0": "pool_decimals0", "d1": "pool_decimals1"}
        rows = with_seed(rows, seeds.withColumnsRenamed(names))
    puts = [
        Put("tick", "tick"), Put("price", "price", Wide),
        Put("d0", "pool_decimals0"), Put("d1", "pool_decimals1"),
    ]
    states = pool_states(rows, puts=puts, lane=Wide, staged=True, counted=True)
    if seeds is not None:
        states = drop_seed(states)
    states = states.withColumnsRenamed({"d0_after": "decimals0", "d1_after": "decimals1"})
    changes = events.where("kind = 'ModifyLiquidity'")
    valued = with_bound_ratios(states, tick_dimension(changes))
    return pool_prices(token_amounts(position_amounts(valued)))


def tick_values(events: DataFrame) -> DataFrame:
    """Gross and net liquidity around each change, one row per change."""
    changes = events.where("kind = 'ModifyLiquidity'")
    return nest_ticks(tick_deltas(changes, Wide))


_NARROW = ("tick", "tx_count")
_WIDE = ("price", "liquidity")
_TICK_COLUMNS = [f"{side}_{name}" for side in ("lower", "upper") for name in TICK_VALUES]


def encode_states(rows: DataFrame) -> DataFrame:
    """State columns and raw amounts as shortest signed bytes; absent is empty."""
    out = {}
    for when in ("before", "after"):
        for s in _NARROW:
            out[f"{s}_{when}"] = W.minimal_signed_bytes(W.bigint_to_word(f"{s}_{when}"))
        for s in _WIDE:
            out[f"{s}_{when}"] = W.minimal_signed_bytes(f"{s}_{when}")
    out |= {f"raw{i}": W.minimal_signed_bytes(f"raw{i}") for i in (0, 1)}
    return with_sql(rows, out)


def encode_ticks(rows: DataFrame) -> DataFrame:
    return with_sql(rows, {c: W.minimal_signed_bytes(c) for c in _TICK_COLUMNS})


def enriched_ledger(events: DataFrame, tokens: DataFrame) -> DataFrame:
    """One row per event; events without a pool keep empty state.

    Pass ``events`` and ``tokens`` (:func:`initialize_tokens`) as stored tables.
    """
    return assembled(events, tokens, pool_values(events, tokens), tick_values(events))


def assembled(
    events: DataFrame, tokens: DataFrame, values: DataFrame, ticks: DataFrame
) -> DataFrame:
    """Events with their pool values, tick values and token metadata."""
    values = encode_states(values).select(
        *EVENT,
        *[f"{s}_{w}" for s in (*_NARROW, *_WIDE) for w in ("before", "after")],
        "token0_price_after", "token1_price_after", "raw0", "raw1",
        "token_amount0", "token_amount1",
    )
    ticks = encode_ticks(ticks).select(*EVENT, *_TICK_COLUMNS)
    meta = tokens.drop("pool_decimals0", "pool_decimals1")
    return with_sql(
        events.join(values, EVENT, "left").join(ticks, EVENT, "left").join(meta, EVENT, "left"),
        {"state_version": str(STATE_VERSION)},
    )


def _record(fields: dict[str, str], when: str) -> str:
    inner = ", ".join(f"'{name}', {sql}" for name, sql in fields.items())
    return f"IF({when}, named_struct({inner}), NULL)"


def enriched_records(rows: DataFrame) -> DataFrame:
    """:func:`enriched_ledger` rows as nested records: the event and its state.

    ``pool`` is absent for events without a pool; ``ticks`` holds the lower, then
    the upper bound of a liquidity change; amounts are absent where the event
    has none.
    """
    pool = {"pool_id": "pool"} | {
        f"{s}_{when}": f"{s}_{when}" for s in (*_NARROW, *_WIDE) for when in ("before", "after")
    }
    change = "kind = 'ModifyLiquidity'"
    sides = [
        _record({"tick": f"CAST({side} AS STRING)"} | {n: f"{side}_{n}" for n in TICK_VALUES}, "true")
        for side in ("lower", "upper")
    ]
    amounts = {f"token_amount{i}": f"token_amount{i}" for i in (0, 1)}
    prices = {f"token{i}_price_after": f"token{i}_price_after" for i in (0, 1)}
    return to_events(
        rows,
        {
            "pool": _record(pool | prices, "pool IS NOT NULL"),
            "ticks": f"IF({change}, array({', '.join(sides)}), NULL)",
            "position_amounts": _record({"raw0": "raw0", "raw1": "raw1"}, change),
            "token_amounts": _record(amounts, "token_amount0 IS NOT NULL OR token_amount1 IS NOT NULL"),
            "state_version": "state_version",
            "block": "block",
            "ordinal": "ordinal",
        },
    )


def tick_only_ledger(events: DataFrame) -> DataFrame:
    """Events with tick liquidity only."""
    ticks = encode_ticks(tick_values(events)).select(*EVENT, *_TICK_COLUMNS)
    return with_sql(
        events.join(ticks, EVENT, "left"), {"state_version": str(TICK_ONLY_VERSION)}
    )
