"""Raw logs to typed events: routing, signature match, word decode, envelope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import words as W
from tallyline.operators.fold import with_sql
from tallyline.sources.catalog import REGISTRY, SIGNATURES, Signature, Source


def _routing(registry: Sequence[Source]) -> str:
    """Source name by address lookup, once its start block is reached."""
    entries = ", ".join(
        f"X'{s.address}', named_struct('name', '{s.name}', 'start', {s.start_block}L)"
        for s in registry
    )
    found = f"element_at(map({entries}), address)"
    return f"IF(block >= {found}.start, {found}.name, NULL)"


def route(logs: DataFrame, registry: Sequence[Source] = REGISTRY) -> DataFrame:
    """Keep logs of known sources that have started, and name the source.

    The address list and the lowest start block reach the scan as pushed
    filters; decoding happens after.
    """
    known = ", ".join(f"X'{s.address}'" for s in registry)
    first = min(s.start_block for s in registry)
    return (
        logs.where(f"address IN ({known}) AND block >= {first}")
        .withColumn("source", F.expr(_routing(registry)))
        .where("source IS NOT NULL")
    )


def _reject_reason(registry: Sequence[Source]) -> str:
    """Why a log gives no event, from its address, block and kind; NULL if it gives one."""
    entries = ", ".join(f"X'{s.address}', {s.start_block}L" for s in registry)
    start = f"element_at(map({entries}), address)"
    return (
        f"CASE WHEN {start} IS NULL THEN 'unknown source' WHEN block < {start} THEN 'not started' "
        f"WHEN kind IS NULL THEN 'no signature' WHEN NOT ({CLEAN}) THEN 'integer out of range' END"
    )


def _match(signatures: Sequence[Signature]) -> str:
    """Kind by topic lookup; source, arity and data length must agree."""
    entries = ", ".join(
        f"X'{s.topic0}', named_struct('kind', '{s.kind}', 'source', '{s.source}', "
        f"'topics', {s.topics}, 'data_bytes', {s.data_bytes})"
        for s in signatures
    )
    found = f"element_at(map({entries}), get(topics, 0))"
    return (
        f"IF({found}.source = source AND {found}.topics = size(topics) "
        f"AND {found}.data_bytes = octet_length(data), {found}.kind, NULL)"
    )


def match_kind(routed: DataFrame, signatures: Sequence[Signature] = SIGNATURES) -> DataFrame:
    """Name each log's kind by topic, arity and data length; NULL when none fits."""
    return routed.withColumn("kind", F.expr(_match(signatures)))


def _case(values: dict[str, str]) -> str:
    """CASE over the kind; kinds read the same way share an arm."""
    kinds: dict[str, list[str]] = {}
    for kind, sql in values.items():
        kinds.setdefault(sql, []).append(f"'{kind}'")
    arms = " ".join(f"WHEN kind IN ({', '.join(k)}) THEN {sql}" for sql, k in kinds.items())
    return f"CASE {arms} END"


def _word(i: int) -> str:
    return W.word_at("data", i)


def _address(word: str) -> str:
    return W.low_bytes(word, 20)


# Column of the typed event -> kind -> how to read it.
_FIELDS: dict[str, dict[str, str]] = {
    "pool": dict.fromkeys(("Initialize", "ModifyLiquidity", "Swap"), "topics[1]"),
    "currency0": {"Initialize": _address("topics[2]")},
    "currency1": {"Initialize": _address("topics[3]")},
    "fee": {
        "Initialize": W.unsigned_word(_word(0), 24),
        "Swap": W.unsigned_word(_word(5), 24),
    },
    "tick_spacing": {"Initialize": W.signed_word(_word(1), 24)},
    "hooks": {"Initialize": _address(_word(2))},
    "price": {"Initialize": _word(3), "Swap": _word(2)},
    "tick": {
        "Initialize": W.signed_word(_word(4), 24),
        "Swap": W.signed_word(_word(4), 24),
    },
    "sender": dict.fromkeys(("ModifyLiquidity", "Swap"), _address("topics[2]")),
    "lower": {"ModifyLiquidity": W.signed_word(_word(0), 24)},
    "upper": {"ModifyLiquidity": W.signed_word(_word(1), 24)},
    "delta": {"ModifyLiquidity": _word(2)},
    "salt": {"ModifyLiquidity": _word(3), "LogCreatePrivateHook": _word(0)},
    "amount0": {"Swap": _word(0)},
    "amount1": {"Swap": _word(1)},
    "liquidity": {"Initialize": W.zero_word(), "Swap": _word(3)},
    "token_id": {
        "Subscription": "topics[1]", "Unsubscription": "topics[1]", "Transfer": "topics[3]",
    },
    "subscriber": dict.fromkeys(("Subscription", "Unsubscription"), _address("topics[2]")),
    "from_address": {"Transfer": _address("topics[1]")},
    "to_address": {"Transfer": _address("topics[2]")},
    "hook": {"LogCreatePrivateHook": _address("topics[1]")},
    "module": {"LogCreatePrivateHook": _address("topics[2]")},
}
_REQUIRED = {
    "Initialize": ("fee", "tick_spacing", "tick"),
    "ModifyLiquidity": ("lower", "upper"),
    "Swap": ("fee", "tick"),
}
FIELDS = tuple(_FIELDS)
NEEDED = sorted({name for names in _REQUIRED.values() for name in names})
# Every narrow integer of the kind has a value of its type.
CLEAN = "NOT (" + " OR ".join(
    f"(kind = '{kind}' AND {name} IS NULL)" for kind, names in _REQUIRED.items() for name in names
) + ")"
ENVELOPE = (
    "block", "block_hash", "parent_hash", "seconds", "nanos", "tx_index", "tx_hash",
    "origin", "recipient", "gas_price", "address", "tx_log_index", "log_index", "ordinal",
)


def decode(logs: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Typed events in one narrow pass over routed, matched logs.

    Wide integers stay 32-byte words; a narrow integer outside its type makes
    the log malformed, whether that field is asked for or not.  Malformed logs
    give no row here and one row with the reason in :func:`rejected_logs`.
    """
    matched = match_kind(route(logs)).where("kind IS NOT NULL")
    kept = [*[c for c in ENVELOPE if c in logs.columns], "source", "kind"]
    checked = [name for name in NEEDED if name not in fields]
    typed = matched.selectExpr(
        *kept, *[f"{_case(_FIELDS[name])} AS {name}" for name in (*fields, *checked)]
    )
    return typed.where(CLEAN).select(*kept, *fields)


def rejected_logs(logs: DataFrame, registry: Sequence[Source] = REGISTRY) -> DataFrame:
    """Logs that give no event, with the reason; one narrow pass, no exchange."""
    judged = match_kind(logs.withColumn("source", F.expr(_routing(registry))))
    typed = with_sql(judged, {name: _case(_FIELDS[name]) for name in NEEDED})
    return with_sql(typed, {"reason": _reject_reason(registry)}).where("reason IS NOT NULL").select(
        *logs.columns, "reason"
    )


def canonical_sequence(events: DataFrame) -> DataFrame:
    """Number events inside each block by log index, then transaction position."""
    order = Window.partitionBy("block").orderBy("log_index", "tx_index", "tx_log_index")
    return events.withColumn("event_seq", F.row_number().over(order))


def canonical_order(events: DataFrame) -> DataFrame:
    """Total order for a sink: a range exchange, no single-task sort."""
    return events.orderBy("block", "log_index", "tx_index", "tx_log_index")


def envelope(events: DataFrame) -> DataFrame:
    """Nested block, transaction and log references; absent parts get zeros."""
    zero = "0L"
    return with_sql(
        events,
        {
            "block_ref": "named_struct('number', block, 'hash', block_hash, 'parent_hash', "
            f"coalesce(parent_hash, X''), 'timestamp_seconds', coalesce(seconds, {zero}), "
            f"'timestamp_nanos', coalesce(nanos, {zero}))",
            "transaction_ref": "named_struct('index', tx_index, 'hash', tx_hash, "
            "'origin', origin, 'to', recipient, 'gas_price', "
            f"coalesce({W.unsigned_word_text('gas_price')}, '0'))",
            "log_ref": "named_struct('transaction_log_index', tx_log_index, "
            "'block_log_index', log_index, 'ordinal', ordinal, 'address', address, "
            "'trigger_order', log_index)",
        },
    )


def _struct(kind: str, fields: dict[str, str]) -> str:
    inner = ", ".join(f"'{n}', {v}" for n, v in fields.items())
    return f"CASE WHEN kind = '{kind}' THEN named_struct({inner}) END"


def _text(name: str) -> str:
    return f"CAST({name} AS STRING)"


def _metadata(side: int) -> str:
    return (
        f"named_struct('symbol', symbol{side}, 'name', name{side}, "
        f"'total_supply', total_supply{side}, 'decimals', {_text(f'decimals{side}')})"
    )


def to_events(decoded: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """The nested event record: references, source, kind, one payload per row.

    Token metadata is included when the metadata join has added its columns.
    ``extra`` names further columns and the fragments that make them.
    """
    initialize = {
        "pool_id": "pool", "currency0": "currency0", "currency1": "currency1",
        "fee": _text("fee"), "tick_spacing": _text("tick_spacing"), "hooks": "hooks",
        "sqrt_price_x96": W.word_text("price"), "tick": _text("tick"),
    }
    if "symbol0" in decoded.columns:
        initialize |= {"token0_metadata": _metadata(0), "token1_metadata": _metadata(1)}
    token = {"token_id": W.unsigned_word_text("token_id"), "subscriber": "subscriber"}
    payloads = {
        "initialize": ("Initialize", initialize),
        "modify_liquidity": (
            "ModifyLiquidity",
            {
                "pool_id": "pool", "sender": "sender", "tick_lower": _text("lower"),
                "tick_upper": _text("upper"), "liquidity_delta": W.word_text("delta"),
                "salt": "salt",
            },
        ),
        "swap": (
            "Swap",
            {
                "pool_id": "pool", "sender": "sender", "amount0": W.word_text("amount0"),
                "amount1": W.word_text("amount1"), "sqrt_price_x96": W.word_text("price"),
                "liquidity": W.word_text("liquidity"), "tick": _text("tick"),
                "fee": _text("fee"),
            },
        ),
        "subscription": ("Subscription", token),
        "unsubscription": ("Unsubscription", token),
        "transfer": (
            "Transfer",
            {
                "from": "from_address", "to": "to_address",
                "token_id": W.unsigned_word_text("token_id"),
            },
        ),
        "log_create_private_hook": (
            "LogCreatePrivateHook", {"hook": "hook", "module": "module", "salt": "salt"},
        ),
    }
    return envelope(decoded).selectExpr(
        "block_ref", "transaction_ref", "log_ref", "source", "kind",
        *[f"{_struct(kind, fields)} AS {name}" for name, (kind, fields) in payloads.items()],
        *[f"{sql} AS {name}" for name, sql in (extra or {}).items()],
    )
