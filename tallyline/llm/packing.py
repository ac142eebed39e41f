"""Best-fit packing of tokenized documents by exact-complement hashing.

``pieces`` tokenizes whole texts and cuts only documents longer than a
sequence.  ``pack`` places pieces into sequences:

1. Lengths are counted; with sequences of 2048 tokens the counts have at most
   2048 rows, whatever the corpus.  Only they reach the driver.
2. ``plan`` indexes lengths by what they sum up to.  From long to short, the
   gap a length leaves is filled exactly by one, two or three shorter pieces
   as long as the counts last; each combination is consumed as often as its
   scarcest length allows.  What has no exact complement goes best-fit,
   together with a small reserve of the shortest pieces: into the open
   sequences with the smallest gap it fits, else into new ones.  The plan is a
   list of patterns with multiplicities.
3. Pieces of a length are numbered, and a piece's number tells its pattern,
   the pattern's instance and the offset there.  Numbers are made of a running
   count per partition, written with the piece, and of the counts of the
   partitions before it, so no length is ever gathered in one task.

Defined results: a null or empty text is one piece holding the end token only;
repeated rows and repeated or null doc_ids are documents of their own; no
documents give no pieces; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm import words as W
from tallyline.llm.tables import few, small_batches
from tallyline.sources.stage import stage

SEQUENCE = 2048
RESERVES = (0.01, 0.05)  # shares of all tokens
UNDONE = (0, 0.25, 0.5)  # shares of the exact fills
END = 0
KNOWN_WORDS = 150_000
LEARNT = 10_000  # words that go to the tokenizer at a time: an encoding takes about a kilobyte
PIECE = "piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"


def alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary (fixed rule)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    made = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}
    return [made[b] for b in range(256)]


def cuts(data: np.ndarray) -> np.ndarray:
    """Bytes where the tokenizer starts anew whatever stands around them.

    These are places between two ASCII characters of which one is a letter and
    the other is not, or both are not the same kind, and between digits.
    Apostrophes, control characters and everything beyond ASCII are left to the
    tokenizer.
    """
    kinds = KIND[data]
    cut = np.zeros(len(data), bool)
    left, right = kinds[:-1], kinds[1:]
    cut[1:] = (left > 0) & (right > 0) & ((left != right) | (left == DIGIT))
    return cut


LETTER, DIGIT, MARK = 1, 2, 3
KIND = np.zeros(256, np.uint8)
KIND[0x21:0x7F] = MARK
KIND[0x27] = 0
KIND[0x30:0x3A] = DIGIT
KIND[0x41:0x5B] = KIND[0x61:0x7B] = LETTER
MARKS = re.compile(rb"[!-&(-/:-@\[-`{-~]+")


class WordEncoder:
    """Token ids of texts, word by word.

    The tokenizer drops white space and never joins ids across it or across the
    places that ``cuts`` finds, so a text's ids are those of its words one
    after another.  A batch's distinct words are encoded once, and known words
    are looked up (at most ``KNOWN_WORDS`` are kept).  Words that are one run of
    letters, marks or a digit go to the tokenizer's model directly; all others,
    and texts with special tokens, go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bytes = dict(enumerate(alphabet()))
        self.known: dict[bytes, bytes] = {}

    def plain(self, word: bytes) -> str | None:
        """The word as the model sees it, if it is one piece for certain."""
        if word.isalpha() or word.isdigit():  # ASCII letters; digits stand alone
            return word.decode()
        if word.isascii():
            return word.decode() if MARKS.fullmatch(word) else None
        text = word.decode()
        # Latin letters only: single characters in every normal form.
        if text.isalpha() and max(text) < "\u0250" and "\u0130" not in text and "\u0149" not in text:
            return text.lower().encode().decode("latin-1").translate(self.bytes)
        return None

    def learn(self, words: list[bytes]) -> None:
        rest = []
        for word in words:
            seen = self.plain(word)
            if seen is None:
                rest.append(word)
            else:
                self.known[word] = array("I", [t.id for t in self.model.tokenize(seen)]).tobytes()
        for begin in range(0, len(rest), LEARNT):
            some = rest[begin : begin + LEARNT]
            coded = self.tokenizer.encode_batch([w.decode() for w in some], add_special_tokens=False)
            self.known.update((w, array("I", c.ids).tobytes()) for w, c in zip(some, coded, strict=True))

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        source = W.texts(texts, lower=True)
        words = W.split(source, W.WHITE, cuts(source.data))
        names = words.names.to_pylist()
        new = [w for w in names if w not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = names
        self.learn(new)
        coded = [self.known[w] for w in names]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        flat = np.frombuffer(b"".join(coded), np.uint32)
        starts = np.cumsum(sizes) - sizes
        # Ids of all words in order: a ragged gather.
        per = sizes[words.ids]
        ends = np.cumsum(per)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - per, per)
        ids = flat[np.repeat(starts[words.ids], per) + at]
        bounds = np.append(0, ends)[words.bounds]
        end = np.array([END], "<u4")
        made = [np.append(ids[a:b], end) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        special = pc.fill_null(pc.match_substring(texts, "<|"), False).to_numpy(zero_copy_only=False)
        for row in np.flatnonzero(special):
            own = self.tokenizer.encode(texts[row].as_py(), add_special_tokens=False).ids
            made[row] = np.array([*own, END], "<u4")
        return made


def piece_rows(path: str, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (doc_id, text) to batches of pieces with a running count per length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordEncoder(path)
        seen = np.zeros(SEQUENCE + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for rows in W.parts(batch["text"]):
                owner, piece, start, length, crc, local, kept = [], [], [], [], [], [], []
                for row, ids in enumerate(encode(batch["text"][rows]), rows.start):
                    for number, begin in enumerate(range(0, len(ids), SEQUENCE)):
                        own = ids[begin : begin + SEQUENCE]
                        owner.append(row)
                        piece.append(number)
                        start.append(begin)
                        length.append(len(own))
                        crc.append(zlib.crc32(own.tobytes()))
                        local.append(seen[len(own)])
                        seen[len(own)] += 1
                        if with_ids:
                            kept.append(own)
                columns = [
                    batch["doc_id"].take(pa.array(owner, pa.int64())),
                    pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array([part] * len(owner), pa.int32()), pa.array(local, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def pieces(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents, written once; with their ids if asked for."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {PIECE}, part INT, local BIGINT"
    if with_ids:
        schema += ", ids ARRAY<INT>"
    return stage(rows.mapInArrow(piece_rows(tokenizer, with_ids), schema), "pack-pieces")


@dataclass(frozen=True)
class Plan:
    """Patterns (lengths in order) and how many sequences follow each."""

    patterns: list[tuple[int, ...]]
    times: list[int]

    @classmethod
    def of(cls, made: list[tuple[tuple[int, ...], int]]) -> Plan:
        return cls([p for p, _ in made], [t for _, t in made])

    @property
    def sequences(self) -> int:
        return sum(self.times)


def complements(counts: np.ndarray, most: int, gap: int) -> Iterator[tuple[int, ...]]:
    """Combinations of one, two or three available lengths up to ``most`` that sum to ``gap``."""
    if gap <= most and counts[gap]:
        yield (gap,)
    have = np.flatnonzero(counts[: min(most, gap) + 1])[::-1]
    have = have[have > 0]
    rest = gap - have
    pairs = have[(rest > 0) & (rest <= have)]
    for a in pairs[counts[gap - pairs] > 0]:
        yield (int(a), int(gap - a))
    for a in have:
        b = have[(have <= a) & (have < gap - a)]
        c = gap - a - b
        good = (c > 0) & (c <= b)
        for x in b[good][counts[c[good]] > 0]:
            yield (int(a), int(x), int(gap - a - x))


def plan(lengths: dict[int, int], size: int = SEQUENCE) -> Plan:
    """Pack counted lengths: exact complements first, then best fit of the rest.

    A share of the tokens, the shortest pieces, takes no part in exact fills:
    without them nothing would be left that fills the gaps of the residuals.
    Fills of the shorter lengths that cost more sequences than they save are
    undone and their pieces join the residuals.
    """
    found = None
    for share in RESERVES:
        kept, rest = reserve(lengths, share)
        made, left = exact_fills(rest, size)
        for undone in UNDONE:
            first = math.ceil(len(made) * (1 - undone))
            residual = Counter(dict(left)) + Counter(kept)
            for pattern, times in made[first:]:
                for length in pattern:
                    residual[length] += times
            tried = Plan.of(made[:first] + best_fit(sorted(residual.items(), reverse=True), size))
            if found is None or tried.sequences < found.sequences:
                found = tried
    return found


def reserve(lengths: dict[int, int], share: float) -> tuple[dict[int, int], dict[int, int]]:
    """The shortest pieces that hold a share of the tokens, and the others."""
    wanted = share * sum(length * n for length, n in lengths.items())
    kept: dict[int, int] = {}
    for length in sorted(lengths):
        if wanted <= 0:
            break
        kept[length] = min(lengths[length], math.ceil(wanted / length))
        wanted -= kept[length] * length
    return kept, {k: n - kept.get(k, 0) for k, n in lengths.items() if n > kept.get(k, 0)}


def exact_fills(
    lengths: dict[int, int], size: int
) -> tuple[list[tuple[tuple[int, ...], int]], list[tuple[int, int]]]:
    """Patterns that fill a sequence exactly with their times, and the lengths left over."""
    counts = np.zeros(size + 1, np.int64)
    for length, n in lengths.items():
        counts[length] = n
    made: list[tuple[tuple[int, ...], int]] = []
    left: list[tuple[int, int]] = []
    for length in range(size, 0, -1):
        if length == size and counts[length]:
            made.append(((length,), int(counts[length])))
            counts[length] = 0
        while counts[length]:
            found = False
            for rest in complements(counts, length, size - length):
                whole = (length, *rest)
                uses = {x: whole.count(x) for x in whole}
                times = int(min(counts[x] // n for x, n in uses.items()))
                if times == 0:
                    continue
                for x, n in uses.items():
                    counts[x] -= n * times
                made.append((whole, times))
                found = True
                if not counts[length]:
                    break
            if not found:
                left.append((length, int(counts[length])))
                counts[length] = 0
    return made, left


def best_fit(left: list[tuple[int, int]], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Counted lengths, from long to short, each into the open sequences with the smallest gap."""
    # Open sequences by gap; each class is a pattern with a number of sequences.
    open_: dict[int, list[list]] = {}
    for length, n in left:
        while n:
            gap = next((g for g in range(length, size + 1) if open_.get(g)), None)
            if gap is None:
                fits = size // length
                whole, rest = divmod(n, fits)
                fresh = [(fits, whole)] * (whole > 0) + [(rest, 1)] * (rest > 0)
                for k, times in fresh:
                    open_.setdefault(size - k * length, []).append([(length,) * k, times])
                break
            pattern, times = open_[gap][-1]
            # As many of this length as the gap holds.
            k = min(gap // length, n)
            used = min(times, n // k)
            open_[gap][-1][1] -= used
            if not open_[gap][-1][1]:
                open_[gap].pop()
            open_.setdefault(gap - k * length, []).append([pattern + (length,) * k, used])
            n -= used * k
    return [(tuple(p), t) for classes in open_.values() for p, t in classes]


@dataclass(frozen=True)
class Places:
    """Where the numbered pieces of each length go, as intervals of numbers."""

    first: dict[int, np.ndarray]
    sequence: dict[int, np.ndarray]
    per: dict[int, np.ndarray]
    offset: dict[int, np.ndarray]

    @classmethod
    def of(cls, made: Plan) -> Places:
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        base = 0
        for pattern, times in zip(made.patterns, made.times, strict=True):
            begin = 0
            for length in dict.fromkeys(pattern):
                n = pattern.count(length)
                at = taken.get(length, 0)
                rows.setdefault(length, []).append((at, base, n, begin))
                taken[length] = at + n * times
                begin += n * length
            base += times
        columns = {k: np.array(v, np.int64).T for k, v in rows.items()}
        return cls(*({k: v[i] for k, v in columns.items()} for i in range(4)))

    def find(self, length: int, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces of a length by their numbers."""
        i = np.searchsorted(self.first[length], number, side="right") - 1
        place = number - self.first[length][i]
        per = self.per[length][i]
        return self.sequence[length][i] + place // per, self.offset[length][i] + place % per * length


def place_rows(places: Places) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch["length"].to_numpy()
            number = batch["number"].to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            kinds, begins = np.unique(length[order], return_index=True)
            for kind, rows in zip(kinds, np.split(order, begins[1:]), strict=True):
                sequence[rows], offset[rows] = places.find(int(kind), number[rows])
            kept = [n for n in batch.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in kept), pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"],
            )

    return run


def pack(cut: DataFrame) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    per_part = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    lengths = per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()
    places = Places.of(plan({r["length"]: r["n"] for r in lengths}))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task and length; pieces stay where they are while that is few.
    offsets = stage(
        per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")),
        "pack-offsets",
    )
    names = [c for c in cut.columns if c not in ("part", "local")]
    numbered = cut.join(few(offsets), ["part", "length"]).select(
        *names, (F.col("local") + F.col("earlier")).alias("number")
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name != "number")
    return numbered.mapInArrow(place_rows(places), f"{kinds}, sequence_id BIGINT, offset BIGINT")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: ids, and where each document starts and ends in them."""
    return (
        packed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids"))).alias("p"))
        .select(
            "sequence_id",
            F.flatten("p.ids").alias("ids"),
            F.col("p.doc_id").alias("doc_ids"),
            F.col("p.offset").alias("offsets"),
        )
    )
