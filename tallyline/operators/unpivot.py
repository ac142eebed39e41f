"""Row generators: one ledger event to several keyed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyline.operators.fold import Narrow


def _inline(df: DataFrame, names: list[str], rows: list[tuple[str, ...]]) -> DataFrame:
    structs = [
        "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in zip(names, row)) + ")"
        for row in rows
    ]
    return df.selectExpr("*", f"inline(array({', '.join(structs)}))")


def tick_operations(changes: DataFrame, lane: type = Narrow) -> DataFrame:
    """Liquidity changes to four ADD operations each, in order.

    gross lower, net lower, gross upper (all +delta), then net upper (-delta).
    """
    return _inline(
        changes.where("delta IS NOT NULL"),
        ["op_seq", "side", "bound", "amount"],
        [
            ("0", "'gross'", "lower", "delta"),
            ("1", "'net'", "lower", "delta"),
            ("2", "'gross'", "upper", "delta"),
            ("3", "'net'", "upper", lane.negate("delta")),
        ],
    )


def tick_bounds(changes: DataFrame, lane: type = Narrow) -> DataFrame:
    """Liquidity changes to two rows each (lower, upper) with both amounts.

    Half the rows of :func:`tick_operations`: gross and net of one tick share
    a key, so one fold keeps both.
    """
    return _inline(
        changes.where("delta IS NOT NULL"),
        ["position", "bound", "gross_amount", "net_amount"],
        [
            ("0", "lower", "delta", "delta"),
            ("1", "upper", "delta", lane.negate("delta")),
        ],
    )


def tick_ids(changes: DataFrame) -> DataFrame:
    """Lower and upper tick ids in save order."""
    return changes.selectExpr("*", "posexplode(array(lower, upper)) AS (position, bound)")


def currencies(inits: DataFrame) -> DataFrame:
    """Initialize rows to (side, token) rows."""
    return _inline(inits, ["side", "token"], [("0", "currency0"), ("1", "currency1")])


def text_fields(inits: DataFrame) -> DataFrame:
    """Initialize rows to the four checked texts: symbol, name of each token."""
    return _inline(
        inits,
        ["field_seq", "token", "field", "text"],
        [
            (str(2 * side + i), f"currency{side}", f"'{field}'", f"{field}{side}")
            for side in (0, 1)
            for i, field in enumerate(("symbol", "name"))
        ],
    )
