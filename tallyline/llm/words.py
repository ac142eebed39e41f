"""Words of many texts at once, as flat arrays.

A batch of texts is cut into words without a loop over texts: separators are
found bytewise, words become one Arrow array, and Arrow's dictionary encoding
gives equal words equal ids.  Ids are exact within a batch; nothing is hashed
unless a caller asks for hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BATCH_BYTES = 1 << 20
BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((BYTES >= 0x41) & (BYTES <= 0x5A), BYTES + 0x20, BYTES).astype(np.uint8)
WHITE = (BYTES == 0x20) | ((BYTES >= 0x09) & (BYTES <= 0x0D))
NOT_WORD = (BYTES < 0x30) | ((BYTES >= 0x3A) & (BYTES < 0x61)) | ((BYTES >= 0x7B) & (BYTES < 0x80))
CONTINUES = (BYTES & 0xC0) == 0x80


@dataclass
class Texts:
    """Bytes of a batch and where each text starts."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def count(self, marked: np.ndarray) -> np.ndarray:
        """Marked bytes per text."""
        return between(marked, self.bounds)


@dataclass
class Words:
    ids: np.ndarray
    names: pa.Array
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def between(marked: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``marked`` between neighbouring bounds."""
    total = np.zeros(len(marked) + 1, np.int64)
    np.cumsum(marked, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def parts(column: pa.Array, limit: int = BATCH_BYTES) -> Iterator[slice]:
    """Row ranges of about ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > limit:
            yield slice(begin, i)
            begin, total = i, 0
        total += int(size)
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def texts(column: pa.Array, lower: bool = False) -> Texts:
    """A string column's bytes; null is the empty text."""
    column = pc.fill_null(column.cast(pa.large_string()).cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data if data is not None else b"", np.uint8)[ends[0] : ends[-1]]
    return Texts(LOWER[flat] if lower else flat, ends - ends[0])


def split(source: Texts, separator: np.ndarray, cut: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes that are no separators; no run crosses texts.

    ``cut`` marks bytes that start a new run in any case.
    """
    inside = ~separator[source.data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    if cut is not None:
        first |= inside & cut
    begins = source.bounds[:-1]
    begins = begins[begins < len(inside)]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    kept = source.data[inside]
    offsets = np.append((np.cumsum(inside) - 1)[starts], len(kept)).astype(np.int64)
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
    )
    coded = flat.dictionary_encode()
    return Words(
        coded.indices.to_numpy().astype(np.int64),
        coded.dictionary,
        np.searchsorted(starts, source.bounds),
    )


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ids of pairs: equal ids for equal pairs."""
    joined = (left.astype(np.int64) << 32) | right.astype(np.int64)
    return pa.array(joined).dictionary_encode().indices.to_numpy().astype(np.int64)


def five_word_windows(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Starts and exact ids of all runs of five words of one text."""
    ids = words.ids
    if len(ids) < 5:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    two = paired(ids[:-1], ids[1:])
    four = paired(two[:-2], two[2:])
    five = paired(four[:-1], ids[4:])
    rows = words.rows
    starts = np.flatnonzero(rows[:-4] == rows[4:])
    return starts, five[starts]


def name_hashes(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each distinct word."""
    digests = b"".join(xxhash.xxh3_128_digest(x) for x in names.to_pylist())
    both = np.frombuffer(digests, "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit (splitmix64's finish)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive word hashes from each position on."""
    count = max(len(hashes) - size + 1, 0)
    total = np.full(count, size, np.uint64)
    for j in range(size):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + count])
    return total
