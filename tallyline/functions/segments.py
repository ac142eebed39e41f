"""Segments: contiguous block ranges that let one hot key use many tasks.

A running window over a key needs all its rows in one task.  Folds in this
package therefore run per (key, segment) and carry small per-segment totals
from one segment to the next.  Results do not depend on the segment width; it
only decides how work is spread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.conf import RuntimeConfig

WIDTH_CONF = "tallyline.segment.width"
ROWS_CONF = "tallyline.segment.rows"
DEFAULT_ROWS = 1_000_000
MIN_SEGMENTS = 8
PIECES = 128
ACCURACY = 20_000


@dataclass(frozen=True)
class Piece:
    """Blocks from ``start`` on, in segments of ``width`` blocks from number ``base`` on."""

    start: int
    width: int
    base: int = 0


@dataclass(frozen=True)
class Segments:
    """How block numbers map to segments: pieces in the order of their starts."""

    pieces: tuple[Piece, ...]

    @classmethod
    def even(cls, start: int, width: int) -> Segments:
        """Segments of one width everywhere."""
        return cls((Piece(start, width),))

    def of(self, block: str = "block") -> Column:
        return F.expr(self._sql(block, 0, len(self.pieces)))

    def _sql(self, block: str, begin: int, end: int) -> str:
        """A balanced decision tree over the pieces' starts."""
        if end - begin == 1:
            p = self.pieces[begin]
            return f"(({block} - {p.start}L) div {p.width}L + {p.base}L)"
        middle = (begin + end) // 2
        low, high = self._sql(block, begin, middle), self._sql(block, middle, end)
        return f"IF({block} < {self.pieces[middle].start}L, {low}, {high})"


def block_span(source: DataFrame, block: str = "block") -> tuple[int, int, int]:
    """First block, last block and row count; (0, -1, 0) when empty."""
    row = source.agg(
        F.min(block).alias("lo"), F.max(block).alias("hi"), F.count(F.lit(1)).alias("n")
    ).first()
    return (0, -1, 0) if row["lo"] is None else (row["lo"], row["hi"], row["n"])


def plan_segments(source: DataFrame, block: str = "block") -> Segments:
    """Pick segments from where the rows of ``source`` are.

    Row quantiles cut the blocks into up to ``PIECES`` pieces with about the
    same number of rows, so a far block or a dense stretch does not fill one
    segment; when more segments are wanted, each piece is cut evenly by blocks.
    There is no maximum: a hot key carries one total per segment, a million for
    10^12 rows.  One aggregate over one column; pass the table as close to the
    scan as possible so that only that column is read.  The session may fix the
    width or the wanted rows per segment instead.
    """
    conf = source.sparkSession.conf
    width = conf.get(WIDTH_CONF, None)
    if width is not None:
        return Segments.even(0, int(width))
    return _cut(source.agg(*_survey(block)).first(), conf)


def plan_batch(
    source: DataFrame, block: str = "block", ordinal: str = "ordinal"
) -> tuple[Segments, int | None, tuple[int, int] | None]:
    """Segments of a batch, its first block and its last position, in one aggregate."""
    last = F.max(F.struct(F.col(block), F.col(ordinal))).alias("last")
    row = source.agg(*_survey(block), last).first()
    conf = source.sparkSession.conf
    width = conf.get(WIDTH_CONF, None)
    segments = _cut(row, conf) if width is None else Segments.even(0, int(width))
    return segments, row["lo"], tuple(row["last"]) if row["last"] is not None else None


def _survey(block: str) -> list[Column]:
    shares = ", ".join(f"{i / PIECES}D" for i in range(PIECES))
    return [
        F.min(block).alias("lo"),
        F.max(block).alias("hi"),
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_percentile({block}, array({shares}), {ACCURACY})").alias("at"),
    ]


def _cut(row: Row, conf: RuntimeConfig) -> Segments:
    if row["lo"] is None:
        return Segments.even(0, 1)
    wanted = int(conf.get(ROWS_CONF, None) or DEFAULT_ROWS)
    count = max(-(-row["n"] // wanted), MIN_SEGMENTS)
    step = max(PIECES // count, 1)
    starts = sorted({row["lo"], *row["at"][::step]})
    inside = -(-count // len(starts))
    pieces, base = [], 0
    for start, stop in zip(starts, [*starts[1:], row["hi"] + 1]):
        width = max(-(-(stop - start) // inside), 1)
        pieces.append(Piece(start, width, base))
        base += -(-(stop - start) // width)
    return Segments(tuple(pieces))
