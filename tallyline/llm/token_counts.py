"""Token counts of all prefixes of a text by dynamic programming.

A byte-pair encoding is the one sequence of tokens whose neighbours all stay as
they are when the two of them are encoded together.  So the encoding of a
word's prefix ends in the one token before which such an encoding of the rest
stands, and the counts of all prefixes follow from left to right: the count at
``i`` is the count where its last token begins plus one.

Texts are cut into chunks where the tokenizer's own split starts anew whatever
stands around, so the counts of a text are those of its chunks one after
another.  Chunks that are one word are counted together, place by place over
all of them.  Other chunks the tokenizer splits, and where the end of a prefix
changes that split the counts are those of the prefix: in a run of white space,
in a contraction, and in the string of a special token, which is ordinary text
until it is complete.

``prefixes`` stores, per document, the total and the step from each prefix (in
code points) to the next.  ``counts``, ``within`` and ``at`` answer what a
prefix costs, and how much of a text a budget holds, from the stored steps.

Defined results: a null or empty text has no tokens and no prefixes; repeated
rows are counted one by one; an empty table gives no rows; other columns are
not read.  A step beyond 16 bits fails the job.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm import words as W
from tallyline.llm.packing import KIND, LETTER, alphabet
from tallyline.llm.tables import small_batches
from tallyline.sources.stage import stage

LIMIT = 1024
KNOWN = 400_000
LONG = 64
STEP = np.dtype("<i2")

# White space of the tokenizer's pattern and the contractions of three letters.
SPACES = re.compile("[\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}")
CONTRACTED = ("'re", "'ve", "'ll")
# Bytes that may belong to white space: themselves, or as the first byte of a character.
WHITE_BYTE = W.BYTES <= 0x20
WHITE_LEAD = np.isin(W.BYTES, [0xC2, 0xE1, 0xE2, 0xE3])
NOTHING = np.zeros(256, bool)
# First bytes of characters that are all letters: Latin and Cyrillic of two bytes, Han of three.
LETTER_LEADS = {0xC3: 2, 0xC4: 2, 0xC5: 2, 0xD0: 2, 0xD1: 2, 0xE5: 3, 0xE6: 3, 0xE7: 3, 0xE8: 3}
SIGNS = (0x97, 0xB7)  # after 0xC3: the two that are no letters


def kinds(data: np.ndarray) -> np.ndarray:
    """Letter, digit or mark per byte; 0 where only the tokenizer can tell."""
    kind = KIND[data]
    for lead, size in LETTER_LEADS.items():
        at = np.flatnonzero(data == lead)
        at = at[at + size <= len(data)]
        if lead == 0xC3:
            at = at[~np.isin(data[at + 1], SIGNS)]
        for i in range(size):
            kind[at + i] = LETTER
    return kind


def cuts(data: np.ndarray, kind: np.ndarray, specials: list[bytes]) -> np.ndarray:
    """Places where the tokenizer's split starts anew, whatever stands around and follows.

    These are single spaces between characters that are surely no white space,
    and changes between letters, digits and marks; none inside a special token.
    """
    white = WHITE_BYTE[data]
    lead = WHITE_LEAD[data]
    white = white | lead
    white[1:] |= lead[:-1]
    white[2:] |= lead[:-2]
    cut = np.zeros(len(data), bool)
    cut[1:-1] = (data[1:-1] == 0x20) & ~white[:-2] & ~white[2:]
    cut[1:] |= (kind[1:] > 0) & (kind[:-1] > 0) & (kind[1:] != kind[:-1])
    flat = data.tobytes()
    for special in specials:
        at = flat.find(special)
        while at >= 0:
            cut[at + 1 : at + len(special)] = False
            at = flat.find(special, at + 1)
    return cut


class Trie:
    """The vocabulary's tokens by their bytes, walked from many places at once."""

    def __init__(self, tokens: dict[bytes, int]):
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for name, number in tokens.items():
            node = 0
            for byte in name:
                node = nodes.setdefault((node, byte), len(nodes) + 1)
            ends[node] = number
        keys = np.array([n << 8 | b for n, b in nodes], np.int64)
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array(list(nodes.values()), np.int64)[order]
        self.token = np.full(len(nodes) + 1, -1, np.int64)
        self.token[list(ends)] = list(ends.values())

    def matches(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, last byte and number of every token in ``data``; ``ends``: where each byte's word ends."""
        start = np.arange(len(data))
        node = np.zeros(len(data), np.int64)
        found = []
        for depth in range(LONG):
            if not len(start):
                break
            inside = start + depth < ends[start]
            start, node = start[inside], node[inside]
            key = node << 8 | data[start + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            start, node = start[known], self.next[at[known]]
            whole = self.token[node] >= 0
            found.append((start[whole], start[whole] + depth, self.token[node[whole]]))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


class PrefixCounter:
    """Token counts of all prefixes; words and chunks that were counted are kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        longest = sorted(self.specials, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest))) if longest else None
        self.letters = alphabet()
        self.numbers = self.tokenizer.get_vocab(with_added_tokens=False)
        for special in self.specials:
            self.numbers.pop(special, None)
        self.names = {number: token for token, number in self.numbers.items()}
        self.width = max(self.names) + 2
        byte_of = {letter: byte for byte, letter in enumerate(self.letters)}
        self.trie = Trie({bytes(byte_of[x] for x in t): n for t, n in self.numbers.items()})
        tails: dict[str, set[int]] = defaultdict(set)
        for token in self.numbers:
            tails[token[-2:]].add(len(token))
        # Lengths of the tokens that end in the same two letters, long ones first.
        self.lengths = {tail: tuple(sorted(n, reverse=True)) for tail, n in tails.items()}
        # Pairs of tokens (the first may be none) and whether they stay as they are.
        self.pairs, self.stays = np.zeros(0, np.int64), np.zeros(0, bool)
        self.single: dict[int, bool] = {}
        self.words: dict[str, list[int]] = {}
        self.chunks: dict[bytes, tuple[int, bytes]] = {}

    def test(self, pair: int) -> bool:
        left, right = self.names.get(pair // self.width - 1, ""), self.names[pair % self.width]
        return [t.value for t in self.model.tokenize(left + right)] == ([left, right] if left else [right])

    def stable(self, pairs: np.ndarray) -> np.ndarray:
        """Do the tokens of each pair stay as they are side by side?"""
        at = np.searchsorted(self.pairs, pairs)
        known = self.pairs[np.minimum(at, len(self.pairs) - 1)] == pairs if len(self.pairs) else np.zeros(len(pairs), bool)
        if not known.all():
            new = np.unique(pairs[~known])
            place = np.searchsorted(self.pairs, new)
            self.stays = np.insert(self.stays, place, [self.test(p) for p in new.tolist()])
            self.pairs = np.insert(self.pairs, place, new)
            at = np.searchsorted(self.pairs, pairs)
        return self.stays[at]

    def keeps(self, pair: int) -> bool:
        found = self.single.get(pair)
        if found is None:
            found = self.single[pair] = self.test(pair)
        return found

    def many(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Counts of the prefixes of many words of at most ``LONG`` bytes, one per byte."""
        if not len(data):
            return np.zeros(0, np.int64)
        sizes = np.diff(bounds)
        begins, ends = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
        start, end, token = self.trie.matches(data, ends)
        depth = end - begins[end]
        order = np.argsort(depth, kind="stable")
        start, end, token = start[order], end[order], token[order]
        opens = start == begins[start]
        count, last = np.zeros(len(data), np.int64), np.full(len(data), -1, np.int64)
        rounds = np.searchsorted(depth[order], np.arange(sizes.max(initial=0) + 1))
        for a, b in zip(rounds[:-1], rounds[1:], strict=True):
            before = np.where(opens[a:b], -1, last[start[a:b] - 1])
            good = self.stable((before + 1) * self.width + token[a:b])
            at = end[a:b][good]
            last[at] = token[a:b][good]
            count[at] = np.where(opens[a:b], 0, count[start[a:b] - 1])[good] + 1
        return count

    def word(self, letters: str) -> list[int]:
        """Counts of the prefixes of one word, in the vocabulary's letters (bytes)."""
        counts = self.words.get(letters)
        if counts is not None:
            return counts
        counts, last = [0], [-1]
        for i in range(1, len(letters) + 1):
            for n in (*self.lengths.get(letters[max(i - 2, 0) : i], ()), 1):
                token = letters[i - n : i]
                number = self.numbers.get(token) if n <= i else None
                if number is not None and self.keeps((last[i - n] + 1) * self.width + number):
                    counts.append(counts[i - n] + 1)
                    last.append(number)
                    break
            else:
                raise ValueError(f"no token ends {letters[:i]!r}")
        self.words[letters] = counts
        return counts

    def spelled(self, text: str) -> str:
        return "".join(self.letters[b] for b in text.encode())

    def plain(self, text: str) -> list[int]:
        """Counts of the prefixes of a text without special tokens, per code point."""
        made: list[int] = []
        base = 0
        for letters, (begin, _) in self.split(text):
            counts = self.word(letters)
            own = text[begin : begin + self.size(text, begin, len(letters))]
            made += self.placed(own, counts, base)
            if own in CONTRACTED:
                made[-2] = base + 2
            base += counts[-1]
        for run in SPACES.finditer(text):
            before = made[run.start() - 1] if run.start() else 0
            made[run.start() : run.end()] = self.placed(run[0], self.word(self.spelled(run[0])), before)
        return made

    @staticmethod
    def size(text: str, begin: int, bytes_: int) -> int:
        """Code points from ``begin`` on that take so many bytes."""
        if text.isascii():
            return bytes_
        end = begin
        while bytes_ > 0:
            bytes_ -= len(text[end].encode())
            end += 1
        return end - begin

    @staticmethod
    def placed(text: str, counts: list[int], base: int) -> list[int]:
        """Counts after each code point of ``text``."""
        if len(counts) == len(text) + 1:
            return [base + c for c in counts[1:]]
        made, at = [], 0
        for letter in text:
            at += len(letter.encode())
            made.append(base + counts[at])
        return made

    def chunk(self, text: str) -> list[int]:
        """Counts of the prefixes of a chunk, special tokens included."""
        made: list[int] = []
        base = begin = 0
        for found in self.special.finditer(text) if self.special else ():
            section = text[begin : found.start()]
            counts = self.plain(section)
            total = base + (counts[-1] if counts else 0)
            open_ = self.plain(section + found[0][:-1])[len(section) :]
            made += [base + c for c in counts] + [base + c for c in open_] + [total + 1]
            base, begin = total + 1, found.end()
        return made + [base + c for c in self.plain(text[begin:])]

    def learn(self, names: pa.Array) -> None:
        """Count the prefixes of chunks that are not known yet."""
        listed = names.to_pylist()
        fresh = np.array([n not in self.chunks for n in listed], bool)
        if len(self.chunks) + fresh.sum() > KNOWN:
            self.chunks.clear()
            fresh[:] = True
        for memory in (self.single, self.words):
            if len(memory) > KNOWN:
                memory.clear()
        if len(self.pairs) > 4 * KNOWN:
            self.pairs, self.stays = self.pairs[:0], self.stays[:0]
        if not fresh.any():
            return
        new = names.filter(pa.array(fresh))
        listed = [n for n, f in zip(listed, fresh.tolist(), strict=True) if f]
        source = W.texts(new)
        data, bounds = source.data, source.bounds
        sizes = np.diff(bounds)
        # One word to the tokenizer: letters, digits or marks only, but for a space before them.
        kind = kinds(data)
        changes = np.append(False, (kind[1:] > 0) & (kind[:-1] > 0) & (kind[1:] != kind[:-1]))
        changes[bounds[:-1]] = False
        other = source.count((kind == 0) | changes) - (data[bounds[:-1]] == 0x20)
        simple = (other == 0) & (sizes <= LONG) & ((sizes > 1) | (data[bounds[:-1]] != 0x20))
        ours = np.repeat(simple, sizes)
        flat, own = data[ours], np.append(0, np.cumsum(sizes[simple]))
        count = self.many(flat, own)
        # Counts after whole characters only, and the steps between them.
        whole = np.append(~W.CONTINUES[flat[1:]], True) if len(flat) else np.zeros(0, bool)
        at = np.append(0, np.cumsum(whole))[own]
        kept = count[whole]
        steps = np.diff(kept, prepend=0)
        steps[at[:-1]] = kept[at[:-1]]
        stored = checked(steps).tobytes()
        width = STEP.itemsize
        totals, at = count[own[1:] - 1].tolist(), (at * width).tolist()
        places = np.flatnonzero(simple).tolist()
        for i, place in enumerate(places):
            self.chunks[listed[place]] = (totals[i], stored[at[i] : at[i + 1]])
        for place in np.flatnonzero(~simple).tolist():
            counts = np.array(self.chunk(listed[place].decode()), np.int64)
            total = int(counts[-1]) if len(counts) else 0
            self.chunks[listed[place]] = (total, checked(np.diff(counts, prepend=0)).tobytes())

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Bytes and tokens per text, and the steps between its prefixes."""
        source = W.texts(texts)
        specials = [s.encode() for s in self.specials]
        chunks = W.split(source, NOTHING, cuts(source.data, kinds(source.data), specials))
        self.learn(chunks.names)
        known = [self.chunks[n] for n in chunks.names.to_pylist()]
        totals = np.fromiter((t for t, _ in known), np.int64, len(known))
        # Each chunk's first step leads on from the end of the chunk before it.
        per = [s for _, s in known]
        steps = [
            b"".join([per[i] for i in chunks.ids[a:b].tolist()])
            for a, b in zip(chunks.bounds[:-1], chunks.bounds[1:], strict=True)
        ]
        return np.diff(source.bounds), W.between(totals[chunks.ids], chunks.bounds), steps


def checked(steps: np.ndarray) -> np.ndarray:
    if len(steps) and (steps.max() > 0x7FFF or steps.min() < -0x8000):
        raise OverflowError("a step of token counts beyond 16 bits")
    return steps.astype(STEP)


def counting_rows(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(path)
        for batch in batches:
            for part in W.parts(batch["text"]):
                size, tokens, steps = counter(batch["text"][part])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][part], pa.array(size), pa.array(tokens), pa.array(steps, pa.binary())],
                    names=["doc_id", "n_bytes", "n_tokens", "steps"],
                )

    return run


def prefixes(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, steps) of every row of ``docs``, written once."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes BIGINT, n_tokens BIGINT, steps BINARY"
    return stage(rows.mapInArrow(counting_rows(tokenizer), schema), "token-prefixes")


def counts(steps: bytes) -> np.ndarray:
    """The token count of every prefix, one code point after another."""
    return np.cumsum(np.frombuffer(steps, STEP), dtype=np.int64)


@F.arrow_udf(T.IntegerType())
def _within(steps: pa.Array, budget: pa.Array) -> pa.Array:
    made = []
    for row, most in zip(steps, budget.to_pylist(), strict=True):
        fits = np.flatnonzero(counts(row.as_buffer()) <= most) if row.is_valid and most is not None else []
        made.append(int(fits[-1]) + 1 if len(fits) else 0)
    return pa.array(made, pa.int32())


@F.arrow_udf(T.LongType())
def _at(steps: pa.Array, place: pa.Array) -> pa.Array:
    made = []
    for row, end in zip(steps, place.to_pylist(), strict=True):
        known = counts(row.as_buffer()[: max(end, 0) * STEP.itemsize]) if row.is_valid and end is not None else []
        made.append(int(known[-1]) if len(known) else 0)
    return pa.array(made, pa.int64())


def within(steps: Column | str, budget: Column | int) -> Column:
    """Code points of the longest prefix that takes no more tokens than ``budget``."""
    return _within(steps, (F.lit(budget) if isinstance(budget, int) else budget).cast("bigint"))


def at(steps: Column | str, place: Column | int) -> Column:
    """Tokens of the prefix of so many code points; of the whole text if it has fewer."""
    return _at(steps, (F.lit(place) if isinstance(place, int) else place).cast("bigint"))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fitting_chars) of every row of ``docs``."""
    return prefixes(docs, tokenizer).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
        within("steps", limit).alias("fitting_chars"),
    )
