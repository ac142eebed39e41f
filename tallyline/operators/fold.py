"""Running keyed state: SET (last value), ADD (sum) and SET_SUM (resettable sum).

Each fold adds ``<name>_before`` and ``<name>_after`` to every ledger row.  NULL
means the state does not exist yet.  The plan is a two-level scan:

1. one exchange on (keys, segment) and windows inside each segment;
2. one total per (keys, segment), taken by a map-side aggregate, turned into
   the value carried into each segment by a small window over the totals;
3. a join on (keys, segment) that adds the carried value.

A key that holds a third of all rows is thus spread over all its segments.
Expressions are SQL fragments, see :mod:`tallyline.functions.words`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions import words as W

SEGMENT = "segment"
ORDER = ("block", "ordinal")


def rows_upto(partition: Sequence[str], order: Sequence[str]) -> str:
    """Window over the partition's rows up to and including the current one."""
    return _window(partition, order) + " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def rows_before(partition: Sequence[str], order: Sequence[str]) -> str:
    """Window over the partition's strictly earlier rows."""
    return _window(partition, order) + " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _window(partition: Sequence[str], order: Sequence[str]) -> str:
    by = f"PARTITION BY {', '.join(partition)} " if partition else ""
    return f"{by}ORDER BY {', '.join(order)}"


def last_over(value: str, window: str) -> str:
    return f"last({value}, true) OVER ({window})"


def rank(order: Sequence[str]) -> str:
    """One number that sorts like ``order``: block, ordinal, then one tie digit.

    Numbers keep max_by in a hash aggregate; a struct would force a sort of the
    ledger before the map-side aggregate.  A position outside the number's range
    is an error, also without ANSI mode: NULL would silently lose a row.
    """
    if len(order) == 1:
        return order[0]
    scale = f"CAST({10**20} AS DECIMAL(21,0))"
    tie = f" + {order[2]}" if len(order) == 3 else ""
    outside = (
        f"{order[0]} NOT BETWEEN -1 AND {10**17 - 1}L OR {order[1]} NOT BETWEEN -1 AND {2**62}L"
    )
    if tie:
        outside += f" OR {order[2]} NOT BETWEEN 0 AND 9"
    number = (
        f"(CAST({order[0]} AS DECIMAL(17,0)) * {scale} "
        f"+ CAST({order[1]} AS DECIMAL(19,0)) * 10{tie})"
    )
    return f"IF({outside}, {raised('position out of range', 'DECIMAL(38,0)')}, {number})"


def raised(message: str, kind: str) -> str:
    """A fragment of the given type that fails when it is evaluated."""
    return f"CAST(raise_error('{message}') AS {kind})"


class Narrow:
    """BIGINT amounts."""

    @staticmethod
    def last(value: str, at: str) -> str:
        """Aggregate: ``value`` where ``at`` is greatest, ignoring NULL values."""
        return f"max_by({value}, IF({value} IS NULL, NULL, {at}))"

    @staticmethod
    def parts(value: str) -> list[str]:
        return [value]

    @staticmethod
    def join(parts: list[str]) -> str:
        return parts[0]

    @staticmethod
    def joined(df: DataFrame, values: dict[str, list[str]]) -> DataFrame:
        """Add columns given as parts; NULL where the first part is."""
        return with_sql(df, {name: parts[0] for name, parts in values.items()})

    @staticmethod
    def add(a: str, b: str) -> str:
        return f"({a} + {b})"

    @staticmethod
    def negate(a: str) -> str:
        return f"(-{a})"


class Wide:
    """32-byte word amounts: limb columns are summed, then joined modulo 2^256.

    A joined total has limbs below 2^32 again, so carried sums cannot overflow.
    """

    @staticmethod
    def last(value: str, at: str) -> str:
        """As for BIGINTs, byte group by byte group, to stay in a hash aggregate."""
        groups = [(1, 4), (5, 7), (12, 7), (19, 7), (26, 7)]
        picked = [
            f"lpad(hex({Narrow.last(W.bytes_to_bigint(value, start, size), at)}), {2 * size}, '0')"
            for start, size in groups
        ]
        return f"unhex(concat({', '.join(picked)}))"

    @staticmethod
    def parts(value: str) -> list[str]:
        return W.limbs(value)

    @staticmethod
    def join(parts: list[str]) -> str:
        return W.limbs_to_word(parts)

    @staticmethod
    def joined(df: DataFrame, values: dict[str, list[str]]) -> DataFrame:
        """The same for limbs, which may be negative here.

        Carries run through eight projections of plain arithmetic, which stay in
        generated code; one expression would need interpreted lambdas.
        """
        limb = lambda name, i: f"_{name}_limb{i}"
        df = with_sql(df, {limb(n, i): p for n, parts in values.items() for i, p in enumerate(parts)})
        for i in range(1, W.LIMBS):
            df = with_sql(
                df, {limb(n, i): f"{limb(n, i)} + shiftright({limb(n, i - 1)}, 32)" for n in values}
            )
        words = {
            n: f"IF({limb(n, 0)} IS NULL, NULL, {W.flat_word([limb(n, i) for i in range(W.LIMBS)])})"
            for n in values
        }
        return with_sql(df, words).drop(*(limb(n, i) for n in values for i in range(W.LIMBS)))

    @staticmethod
    def add(a: str, b: str) -> str:
        return W.word_add(a, b)

    @staticmethod
    def negate(a: str) -> str:
        return W.word_negate(a)


def total(lane: type, value: str) -> str:
    """Aggregate: the sum of ``value``."""
    return lane.join([f"sum({x})" for x in lane.parts(value)])


@dataclass(frozen=True)
class Put:
    """SET: rows with a non-NULL ``value`` overwrite the state."""

    name: str
    value: str
    lane: type = Narrow


@dataclass(frozen=True)
class Tally:
    """ADD: rows with a non-NULL ``amount`` add to the state."""

    name: str
    amount: str
    lane: type = Narrow


def plus(lane: type, a: str, b: str) -> str:
    """Sum of two nullable amounts; NULL only if both are."""
    return f"CASE WHEN {a} IS NULL THEN {b} WHEN {b} IS NULL THEN {a} ELSE {lane.add(a, b)} END"


def with_sql(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add columns given as SQL fragments."""
    return df.withColumns({name: F.expr(sql) for name, sql in columns.items()})


def fold(
    ledger: DataFrame,
    keys: Sequence[str],
    states: Sequence[Put | Tally],
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Add before/after columns of SET and ADD states to a segmented ledger."""
    group = [*keys, SEGMENT]
    now, past = rows_upto(group, order), rows_before(group, order)
    incoming = rows_before(keys, [SEGMENT])
    position = rank(order)

    totals, carries, local, out = [], [], {}, {}
    apart: dict[type, dict[str, list[str]]] = {}
    for s in states:
        own, carry = f"_{s.name}_total", f"_{s.name}_carry"
        before, after = f"{s.name}_before", f"{s.name}_after"
        if isinstance(s, Put):
            v = s.value
            totals.append(f"{s.lane.last(v, position)} AS {own}")
            carries.append(f"{last_over(own, incoming)} AS {carry}")
            local[f"_{before}"] = last_over(v, past)
            local[f"_{after}"] = last_over(v, now)
            out[before] = f"coalesce(_{before}, {carry})"
            out[after] = f"coalesce(_{after}, {carry})"
        else:
            v, seen = s.amount, f"_{s.name}_n"
            parts = s.lane.parts(v)
            totals.append(f"{total(s.lane, v)} AS {own}")
            for i, x in enumerate(s.lane.parts(own)):
                carries.append(f"sum({x}) OVER ({incoming}) AS {carry}_{i}")
            for i, x in enumerate(parts):
                local[f"_{after}_{i}"] = f"sum({x}) OVER ({now})"
            local[seen] = f"count({v}) OVER ({past})"
            # Parts stay apart until here; each value is joined once.  A second
            # frame would sum everything twice: the earlier value is this one
            # less the row's own amount.
            now_parts = [
                f"(coalesce(_{after}_{i}, 0L) + coalesce({carry}_{i}, 0L))"
                for i in range(len(parts))
            ]
            past_parts = [f"({p} - coalesce({x}, 0L))" for p, x in zip(now_parts, parts)]
            no_carry = f"{carry}_0 IS NULL"
            past_parts[0] = f"IF({no_carry} AND {seen} = 0, NULL, {past_parts[0]})"
            now_parts[0] = f"IF({no_carry} AND _{after}_0 IS NULL, NULL, {now_parts[0]})"
            apart.setdefault(s.lane, {}).update({before: past_parts, after: now_parts})

    carried = (
        ledger.groupBy(*group)
        .agg(*[F.expr(t) for t in totals])
        .selectExpr(*group, *carries)
    )
    rows = with_sql(with_sql(ledger, local).join(carried, group, "left"), out)
    for lane, values in apart.items():
        rows = lane.joined(rows, values)
    names = [f"{s.name}_{when}" for s in states for when in ("before", "after")]
    return rows.select(*ledger.columns, *names)


def _local_set_sum(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    put: str,
    add: str,
    lane: type,
    out: str,
) -> tuple[DataFrame, list[str]]:
    """SET_SUM inside one window partition, in parts, plus ``_reset``: a set happened here.

    The state is ``running sum + (set value - running sum at that set)``, so
    windows over one sort give it, with no second sort by set number.  Parts are
    added and subtracted one by one; whoever needs a value joins them once.
    """
    now = rows_upto(partition, order)
    puts, adds = lane.parts(put), lane.parts(add)
    sums = {f"_sum_{i}": f"sum({x}) OVER ({now})" for i, x in enumerate(adds)}
    offsets = {
        f"_offset_{i}": f"IF({put} IS NULL, NULL, {x} - coalesce(_sum_{i}, 0L))"
        for i, x in enumerate(puts)
    }
    bases = {f"_base_{i}": last_over(f"_offset_{i}", now) for i in range(len(puts))}
    own = {
        f"{out}_{i}": f"IF(_base_{i} IS NULL, _sum_{i}, _base_{i} + coalesce(_sum_{i}, 0L))"
        for i in range(len(puts))
    }
    step = with_sql(with_sql(with_sql(df, sums), offsets), bases)
    step = with_sql(step, own | {"_reset": "_base_0 IS NOT NULL"})
    return step.drop(*sums, *offsets, *bases), list(own)


def fold_set_sum(
    ledger: DataFrame,
    keys: Sequence[str],
    name: str,
    put: str,
    add: str,
    lane: type = Narrow,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Add before/after of a SET_SUM state: ``put`` resets it, ``add`` moves it.

    A row with both NULL leaves the state as it is; ``put`` wins over ``add``.
    """
    group = [*keys, SEGMENT]
    in_segment = _window(group, order)
    step = with_sql(ledger, {"_add": f"IF({put} IS NULL, {add}, NULL)"})
    local, own = _local_set_sum(step, group, order, put, "_add", lane, "_own")

    ends = with_sql(local, {"_next": f"lead(1) OVER ({in_segment})"}).where("_next IS NULL")
    # Joined once per segment, so that carried parts are small again.
    totals = ends.selectExpr(
        *group, "_reset AS _was_reset", f"{lane.join(own)} AS _end_value"
    ).selectExpr(
        *group, "IF(_was_reset, _end_value, NULL) AS _put", "IF(_was_reset, NULL, _end_value) AS _add"
    )
    carried, end = _local_set_sum(totals, keys, [SEGMENT], "_put", "_add", lane, "_end")
    past = _window(keys, [SEGMENT])
    carry = [f"_carry_{i}" for i in range(len(end))]
    carried = lane.joined(
        carried.selectExpr(*group, *[f"lag({e}) OVER ({past}) AS {c}" for e, c in zip(end, carry)]),
        {"_carry": carry},
    )
    after, before = f"{name}_after", f"{name}_before"
    sums = [
        f"IF(_reset OR {c} IS NULL, {o}, {c} + coalesce({o}, 0L))" for c, o in zip(carry, own)
    ]
    rows = lane.joined(local.join(carried, group, "left"), {after: sums})
    rows = with_sql(
        rows,
        {
            before: f"IF(row_number() OVER ({in_segment}) = 1, _carry, "
            f"lag({after}) OVER ({in_segment}))"
        },
    )
    return rows.select(*ledger.columns, before, after)
