"""Repair of conversation structure by lightest derivations.

A conversation is legal if its roles' initials match ``(s?(ua)+)?``.  Edits
keep a row, change its role to user or assistant, delete it, or insert an empty
user or assistant turn; of the cheapest repairs the one with the least audit
(the edits' initials in order) is taken.

The search is a weighted deduction.  An item (row, state) says that the rows
from ``row`` on lead from ``state`` to a given end state; its weight is
(cost, audit).  Putting an edit before an item is a superior function: it adds
to the cost, and it keeps the order of audits, because items over the same rows
with the same cost never have audits of which one begins the other (an audit
tells its cost).  ``lightest`` keeps an agenda of deduced items and pops them by
cost, then by rows covered, then by audit, so an item's first pop is final; it
ends when the goals are final (Knuth's generalisation of shortest paths).

Derivations over neighbouring rows combine the same way, so a conversation of
any length is cut into segments of at most ``SEGMENT`` rows, whose items for all
pairs of states are derived apart from each other and then combined from the
last segment to the first:

1. rows are partitioned by range of (conversation, turn, role, digest), sorted,
   and written with their place; a long conversation spreads over partitions;
2. an earlier row with the same role and text is found by the least place per
   digest, pre-aggregated and joined back;
3. each segment becomes one string of row symbols and its items; segments of a
   conversation are combined (one short row per ``SEGMENT`` rows);
4. rows and the edits of their segment meet by segment; a conversation of one
   segment is hashed there, longer ones by streaming their segments in order.

Defined results: null roles and texts are one space; rows of one turn stand in
the order of role and digest, so copies are neighbours; rows that are not
``present`` count for nothing but their conversation is returned; a
conversation without rows gets zeros, an empty audit and the digest of the empty
text; null conv_ids are one conversation; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.sources.stage import stage

# The automaton of (s?(ua)+)? and the costs of edits.
STATES = ("0", "s", "u", "a")
BEFORE = {"0": (), "s": ("0s",), "u": ("0u", "su", "au"), "a": ("ua",)}
NEXT = {"0": "u", "s": "u", "u": "a", "a": "u"}  # the role that may be put in at a state
ACCEPT = ("0", "a")
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT = 2, 3, 2
LEGAL = ("su", "ua", "au")

SEGMENT = 1 << 10
KNOWN = 100_000
SPACE = " \t\n\x0b\x0c\r"

Items = tuple[tuple[str, str, int, str], ...]


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present) with the damage that a row's id asks for."""
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fate = F.crc32(name) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fate != 0).alias("present"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def lightest(symbols: str, end: str) -> Iterator[tuple[str, int, str]]:
    """(state, cost, audit) of the lightest way through all rows from each state to ``end``.

    A row's symbol is its role's initial (``o``: none of s, u, a), in upper case
    if its text is cut short, or ``-`` if it has to go.
    """
    rows = len(symbols)
    final: dict[tuple[int, str], tuple[str, tuple[int, str] | None]] = {}
    costs: dict[str, int] = {}
    agenda: list[tuple] = [(0, 0, "", rows, end, None)]
    while agenda and len(costs) < len(STATES):
        cost, covered, edit, row, state, after = heapq.heappop(agenda)
        item = (row, state)
        if item in final:
            continue
        final[item] = (edit, after)
        if row == 0:
            costs[state] = cost
        for entry, role in BEFORE[state]:
            if role in ROLES:
                heapq.heappush(agenda, (cost + INSERT, covered, "I", row, entry, item))
        if row == 0:
            continue
        symbol = symbols[row - 1]
        heapq.heappush(agenda, (cost + DELETE, covered + 1, "D", row - 1, state, item))
        if symbol == "-":
            continue
        short = int(symbol.isupper())
        for entry, role in BEFORE[state]:
            if role == symbol.lower():
                heapq.heappush(agenda, (cost + short, covered + 1, "K", row - 1, entry, item))
            if role in ROLES:
                heapq.heappush(agenda, (cost + REROLE + short, covered + 1, "R", row - 1, entry, item))
    for state, cost in costs.items():
        audit, item = [], (0, state)
        while item != (rows, end):
            edit, item = final[item]
            audit.append(edit)
        yield state, cost, "".join(audit)


@lru_cache(KNOWN)
def items(symbols: str) -> Items:
    """The lightest (entry, end, cost, audit) for all pairs of states that rows can join."""
    return tuple((entry, end, cost, audit) for end in STATES for entry, cost, audit in lightest(symbols, end))


class Audit:
    """An audit as a chain of pieces, compared piece by piece."""

    __slots__ = ("piece", "rest", "end")

    def __init__(self, piece: str, rest: Audit | None, end: str):
        self.piece, self.rest, self.end = piece, rest, end

    def __iter__(self) -> Iterator[Audit]:
        node: Audit | None = self
        while node is not None:
            yield node
            node = node.rest

    def letters(self) -> Iterator[str]:
        for node in self:
            yield from node.piece

    def __lt__(self, other: Audit) -> bool:
        ours, theirs = self.letters(), other.letters()
        while True:
            x, y = next(ours, ""), next(theirs, "")
            if x != y or not x:
                return x < y


def combined(best: dict[str, tuple[int, Audit | None]], segment: Items) -> dict[str, tuple[int, Audit]]:
    """The lightest derivations through ``segment`` and all that follows, per entry state."""
    made: dict[str, tuple[int, Audit]] = {}
    for entry, end, cost, piece in segment:
        if end not in best:
            continue
        after, rest = best[end]
        found = (cost + after, Audit(piece, rest, end))
        if entry not in made or found[0] < made[entry][0] or (found[0] == made[entry][0] and found[1] < made[entry][1]):
            made[entry] = found
    return made


SYMBOLS = """conv_id {kind}, seg BIGINT, illegal BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT,
  turns BIGINT, low BIGINT, high BIGINT, first STRING, last STRING"""
ITEMS = "items ARRAY<STRUCT<entry: STRING, end: STRING, cost: BIGINT, audit: STRING>>"
STATISTICS = ("blank", "duplicate", "truncated", "turns", "low", "high")


def with_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with the items of their symbols, and their illegal neighbours counted."""
    kind = pa.list_(pa.struct([("entry", pa.string()), ("end", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))
    for batch in batches:
        initials = batch["initials"].to_pylist()
        illegal = [sum(x + y not in LEGAL for x, y in zip(s, s[1:])) for s in initials]
        made = [[dict(zip(("entry", "end", "cost", "audit"), i, strict=True)) for i in items(s)] for s in batch["symbols"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch["conv_id"], batch["seg"], pa.array(illegal, pa.int64()), *(batch[c] for c in STATISTICS),
                pa.array([s[:1] for s in initials], pa.string()), pa.array([s[-1:] for s in initials], pa.string()),
                pa.array(made, kind),
            ],
            names=["conv_id", "seg", "illegal", *STATISTICS, "first", "last", "items"],
        )


CHAINED = """conv_id {kind}, seg BIGINT, illegal BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT,
  turns BIGINT, low BIGINT, high BIGINT, cost BIGINT, entry STRING, audit STRING, whole BOOLEAN"""


def chain_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from a conversation's last to its first, to segments with their part of the repair."""
    schema: list[pa.Field] = []
    held: list[dict] = []
    best: dict = {}

    def finished() -> pa.RecordBatch:
        entry, rows = STATES[0], []
        cost, audit = best[entry]
        for row, node in zip(reversed(held), audit, strict=True):
            rows.append(row | {"cost": 0, "entry": entry, "audit": node.piece, "whole": len(held) == 1})
            entry = node.end
        rows[0]["cost"] = cost
        return pa.RecordBatch.from_pylist(rows, pa.schema(schema))

    for batch in batches:
        schema = [
            batch.schema.field("conv_id"), *(pa.field(c, pa.int64()) for c in ("seg", "illegal", *STATISTICS, "cost")),
            pa.field("entry", pa.string()), pa.field("audit", pa.string()), pa.field("whole", pa.bool_()),
        ]
        for row in batch.to_pylist():
            made = tuple(tuple(i[k] for k in ("entry", "end", "cost", "audit")) for i in row.pop("items"))
            if held and held[-1]["conv_id"] != row["conv_id"]:
                yield finished()
                held = []
            if not held:
                best = {s: (0, None) for s in ACCEPT}
                later = {"first": "", "low": None}
            # Neighbours and turns that this segment shares with the next one.
            if row["last"] and later["first"] and row["last"] + later["first"] not in LEGAL:
                row["illegal"] += 1
            if row["high"] is not None and row["high"] == later["low"]:
                row["turns"] -= 1
            later = {
                "first": row.pop("first") or later["first"],
                "low": later["low"] if row["low"] is None else row["low"],
            }
            del row["last"]
            best = combined(best, made)
            held.append(row)
    if held:
        yield finished()


def edited(entry: str, audit: str, rows: list[tuple[str, str]]) -> list[str]:
    """The lines that a segment's edits make of its rows."""
    state, at, lines = entry, 0, []
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            lines.append(f"{ROLES[state]}:")
            continue
        role, text = rows[at]
        at += 1
        if edit == "R":
            state = NEXT[state]
            role = ROLES[state]
        elif edit == "K":
            state = role[0]
        if edit != "D":
            lines.append(f"{role}:{text}")
    return lines


def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of a segment, then its rows in order, to its digest (a whole conversation) or its lines."""
    held: dict | None = None
    rows: list[tuple[str, str]] = []
    kind: pa.DataType | None = None

    def finished() -> pa.RecordBatch:
        text = "\n".join(edited(held["entry"], held["audit"], rows))
        digest = hashlib.sha256(text.encode()).hexdigest() if held["whole"] else None
        lines = None if held["whole"] else text
        row = {"conv_id": held["conv_id"], "seg": held["seg"], "digest": digest, "lines": lines, "any": bool(text)}
        return pa.RecordBatch.from_pylist([row], pa.schema([kind, ("seg", pa.int64()), ("digest", pa.string()), ("lines", pa.string()), ("any", pa.bool_())]))

    for batch in batches:
        kind = batch.schema.field("conv_id")
        for row in batch.to_pylist():
            if row["entry"] is not None:
                if held is not None:
                    yield finished()
                held, rows = row, []
            else:
                rows.append((row["role"], row["text"]))
    if held is not None:
        yield finished()


def digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of the segments of conversations in order, to one digest per conversation."""
    state, begun, conv, any_row, kind = hashlib.sha256(), False, None, False, None

    def finished() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"conv_id": conv, "digest": state.hexdigest()}], pa.schema([kind, ("digest", pa.string())]))

    for batch in batches:
        kind = batch.schema.field("conv_id")
        for row in batch.to_pylist():
            if any_row and row["conv_id"] != conv:
                yield finished()
                state, begun = hashlib.sha256(), False
            conv, any_row = row["conv_id"], True
            if row["any"]:
                state.update(("\n" if begun else "").encode() + row["lines"].encode())
                begun = True
    if any_row:
        yield finished()


def placed(rows: DataFrame) -> DataFrame:
    """All rows in order, with their place and what is wrong with each alone; written once."""
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")})
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    known = rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        "role",
        "text",
        "present",
        digest.alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("short"),
        F.monotonically_increasing_id().alias("number"),
    )
    keys = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "digest", "number")]
    ordered = known.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(ordered.drop("number").withColumn("place", F.monotonically_increasing_id()), "repair-rows")


def segment(place: Column) -> Column:
    return F.shiftright(place, SEGMENT.bit_length() - 1)


def chained(rows: DataFrame) -> DataFrame:
    """Every segment with its counts, entry state and edits; written once."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    narrow = rows.drop("role", "text").alias("r")
    full = F.col("present") & ~F.col("blank")
    firsts = narrow.where(full).groupBy("conv_id", "digest").agg(F.min("place").alias("least")).alias("f")
    same = F.col("r.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("r.digest") == F.col("f.digest"))
    again = full & (F.col("least") < F.col("place"))
    joined = narrow.join(firsts, same, "left").select("r.*", F.coalesce(again, F.lit(False)).alias("again"))
    symbol = (
        F.when(F.col("blank") | F.col("again"), "-")
        .when(F.col("short"), F.upper("initial"))
        .otherwise(F.col("initial"))
    )
    present = F.col("present")
    cut = joined.groupBy("conv_id", segment(F.col("place")).alias("seg")).agg(
        F.array_sort(F.collect_list(F.when(present, F.struct("place", "initial", symbol.alias("symbol"))))).alias("rows"),
        F.count_if(present & F.col("blank")).alias("blank"),
        F.count_if(F.col("again")).alias("duplicate"),
        F.count_if(present & ~F.col("blank") & ~F.col("again") & F.col("short")).alias("truncated"),
        F.size(F.collect_set(F.when(present, F.col("turn")))).cast("bigint").alias("turns"),
        F.min(F.when(present, F.col("turn"))).alias("low"),
        F.max(F.when(present, F.col("turn"))).alias("high"),
    )
    strings = cut.withColumns({f"{c}s": F.array_join(F.col(f"rows.{c}"), "") for c in ("initial", "symbol")})
    derived = strings.drop("rows").mapInArrow(with_items, f"{SYMBOLS.format(kind=kind)}, {ITEMS}")
    order = [F.asc_nulls_first("conv_id"), F.desc("seg")]
    chain = derived.repartition("conv_id").sortWithinPartitions(*order)
    return stage(chain.mapInArrow(chain_rows, CHAINED.format(kind=kind)), "repair-segments")


def digests(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """(conv_id, digest) of every repaired conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    none = lambda k: F.lit(None).cast(k)
    edits = segments.select(
        "conv_id", "seg", F.lit(-1).cast("bigint").alias("place"), none("string").alias("role"), none("string").alias("text"),
        "entry", "audit", "whole",
    )
    lines = rows.where("present").select(
        "conv_id", segment(F.col("place")).alias("seg"), "place", "role", "text",
        none("string").alias("entry"), none("string").alias("audit"), none("boolean").alias("whole"),
    )
    keys = [F.asc_nulls_first("conv_id"), "seg", "place"]
    met = edits.unionByName(lines).repartition("conv_id", "seg").sortWithinPartitions(*keys)
    made = stage(
        met.mapInArrow(hash_rows, f"conv_id {kind}, seg BIGINT, digest STRING, lines STRING, any BOOLEAN"),
        "repair-lines",
    )
    parts = made.where("digest IS NULL").select("conv_id", "seg", "lines", "any")
    long = parts.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "seg")
    return made.where("digest IS NOT NULL").select("conv_id", "digest").unionByName(
        long.mapInArrow(digest_rows, f"conv_id {kind}, digest STRING")
    )


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, present) with its faults and its repair."""
    ordered = placed(rows)
    segments = chained(ordered)
    found = segments.select("*", F.lit(None).cast("string").alias("digest"))
    both = found.unionByName(digests(ordered, segments), allowMissingColumns=True)
    total = lambda c: F.sum(c).cast("bigint").alias(c)
    audit = F.array_sort(F.collect_list(F.when(F.col("seg").isNotNull(), F.struct("seg", "audit"))))
    made = both.groupBy("conv_id").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).cast("bigint").alias("gaps"),
        *(total(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        audit.alias("_audit"),
        F.max("digest").alias("repaired_sha256"),
    )
    return made.withColumn("audit", F.array_join("_audit.audit", "")).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )
