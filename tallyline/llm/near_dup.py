"""Near-duplicate documents: banded MinHash, odd sketches, exact confirmation.

1. Every text becomes the set of its distinct five-word shingles, a MinHash
   signature of ``BANDS`` x ``ROWS`` values and an odd sketch of ``SAMPLES``
   one-permutation MinHash samples.  Texts with
   equal sets are one class: its smallest doc_id stands for it from then on.
2. Classes that agree in all samples of a band meet in a bucket.  The
   candidate pairs of a bucket are its first member with every other one, so
   a bucket of n members makes n - 1 pairs, not n^2.
3. An odd sketch folds the samples into a bitmap by parity; the XOR of two
   sketches has about as many bits as samples differ, most exactly where few
   differ.  Pairs with more differing bits than links have (with a margin of
   ``MARGIN`` standard deviations) are dropped, as are pairs whose set sizes
   rule a link out.
4. What is left is confirmed on the full sets, built anew from the texts of
   the documents in candidate pairs only.
5. Confirmed links make components.  Members of a bucket that are not in its
   first member's component yet are then compared with all members of the
   bucket that are in other components, which finds the links that the
   first members could not show; components are made again.  Large groups of
   near copies are one component by then and make no pairs.

A pair at the threshold misses every band with a chance of about 6e-6 (one
minus 0.75^4, to the power of 32); more similar pairs less often.  Nothing is
capped or sampled.  No set, link or component reaches the driver.

Defined results: a null or empty text has no shingles, is linked with nothing
and stays; fewer than five words make one shingle; rows that share a doc_id
are one document, linked by the one of its sets with the smallest digest, and
get one component; a null doc_id is linked with nothing and stays; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm import words as W
from tallyline.llm.graph import components
from tallyline.llm.tables import few, small_batches
from tallyline.sources.stage import stage

BANDS, ROWS = 32, 4
SAMPLE_BITS = 12
SAMPLES = 1 << SAMPLE_BITS
LONGS = 32
BITS = 64 * LONGS
SIMILARITY = 75  # percent
MARGIN = 5.0
CHUNK = 1 << 15


def factors() -> np.ndarray:
    """One odd multiplier per sample, from a fixed sequence."""
    return W.mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def most_sketch_bits(a: str, b: str) -> str:
    """Differing sketch bits that two linked sets of sizes ``a`` and ``b`` hardly exceed.

    At the threshold a quarter of the union's samples differ (with the finite
    population's spread: small sets are sampled whole), a differing sample
    toggles one bit, or two where both sets have one, and parity folds toggles
    into bits.  The bound is the mean plus ``MARGIN`` standard deviations.
    """
    miss = 1 - SIMILARITY / 100
    union = f"(({a} + {b}) / {1 + SIMILARITY / 100}D)"
    used = f"({SAMPLES} * (1 - exp(-{union} / {SAMPLES})))"
    both = f"(2 - exp(-least({a}, {b}) / {SAMPLES}D))"
    fade = f"exp(-2 * {miss}D * {used} * {both} / {BITS})"
    spread = f"({fade} * {fade} * {both} * {both} * {miss * (1 - miss)}D * {used} * greatest(1 - {used} / {union}, 0D))"
    folded = f"({BITS / 4}D * (1 - {fade} * {fade}) - {miss}D * {used} * {both} * {fade} * {fade})"
    return f"({BITS / 2}D * (1 - {fade}) + {MARGIN}D * sqrt({spread} + greatest({folded}, 1D)))"


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, text by text, and the texts' bounds."""
    words = W.split(W.texts(column, lower=True), W.WHITE)
    hashes = W.name_hashes(words.names)[0][words.ids]
    rows = words.rows
    five = W.rolling(hashes, 5)
    whole = rows[: len(five)] == rows[4:] if len(five) else np.zeros(0, bool)
    owner, value = rows[: len(five)][whole], five[whole]
    few = np.flatnonzero((words.counts > 0) & (words.counts < 5))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for i, row in enumerate(few):
            own = hashes[words.bounds[row] : words.bounds[row + 1]]
            short[i] = W.rolling(own, len(own))[0]
        owner, value = np.append(owner, few), np.append(value, short)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[fresh], value[fresh]
    return value, np.searchsorted(owner, np.arange(len(column) + 1))


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash samples of the non-empty sets, one row per set."""
    sizes = np.diff(bounds)
    full = np.flatnonzero(sizes)
    starts = bounds[:-1][full]
    made = np.full((len(full), BANDS * ROWS), np.iinfo(np.uint64).max, np.uint64)
    # In chunks that stay in the cache; a set may span chunks.
    for begin in range(0, len(values), CHUNK):
        chunk = values[begin : begin + CHUNK]
        first = np.searchsorted(starts, begin, side="right") - 1
        last = np.searchsorted(starts, begin + len(chunk), side="left")
        cuts = np.maximum(starts[first:last] - begin, 0)
        for i, factor in enumerate(factors()):
            least = np.minimum.reduceat(chunk * factor, cuts)
            np.minimum(made[first:last, i], least, out=made[first:last, i])
    return made


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    grouped = samples.reshape(-1, BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), grouped.shape[:2]).copy()
    for j in range(ROWS):
        keys = W.mixed(keys * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, j])
    return keys.view(np.int64)


def odd_sketches(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the non-empty sets: every sample toggles one bit.

    Samples are the least hash in each of ``SAMPLES`` ranges of hash values (one
    permutation MinHash); ``values`` are sorted within their set, so those are
    the first ones of each range.
    """
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    kind = values >> np.uint64(64 - SAMPLE_BITS)
    first = np.ones(len(values), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (kind[1:] != kind[:-1])
    full = np.flatnonzero(np.diff(bounds))
    place = np.searchsorted(full, rows[first])
    bit = (W.mixed(values[first]) % np.uint64(BITS)).astype(np.int64)
    odd = np.bincount(place * BITS + bit, minlength=len(full) * BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(full), BITS), axis=1).view(np.int64)


def digests(values: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    """128 bits per set: two sums of mixed hashes, equal for equal sets."""
    full = np.flatnonzero(np.diff(bounds))
    made = []
    for salt in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        total = np.zeros(len(bounds) - 1, np.uint64)
        if len(full):
            total[full] = np.add.reduceat(W.mixed(values ^ np.uint64(salt)), bounds[:-1][full])
        made.append(pa.array(total.view(np.int64)))
    return made


def lists(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to set size, set digest, band keys and odd sketch."""
    for batch in batches:
        for part in W.parts(batch["text"]):
            values, bounds = shingles(batch["text"][part])
            sizes = np.diff(bounds)
            samples = signatures(values, bounds)
            at = np.append(0, np.cumsum(sizes > 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"][part], pa.array(sizes.astype(np.int64)),
                    *digests(values, bounds),
                    lists(band_keys(samples).ravel(), at * BANDS),
                    lists(odd_sketches(values, bounds).ravel(), at * LONGS),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "bands", "sketch"],
            )


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.parts(batch["text"]):
            values, bounds = shingles(batch["text"][part])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"][part], *digests(values, bounds),
                    lists(values.view(np.int64), bounds),
                ],
                names=["doc_id", "d1", "d2", "set"],
            )


def close(a: str, b: str) -> Column:
    """Whether set sizes and odd sketches leave a link possible."""
    bits = " + ".join(f"bit_count({a}.sketch[{i}] ^ {b}.sketch[{i}])" for i in range(LONGS))
    return F.expr(
        f"100 * least({a}.n_shingles, {b}.n_shingles) >= {SIMILARITY} * greatest({a}.n_shingles, {b}.n_shingles)"
        f" AND {bits} <= {most_sketch_bits(f'{a}.n_shingles', f'{b}.n_shingles')}"
    )


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    wanted = stage(
        pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "near-wanted"
    )
    rows = docs.select("doc_id", "text").join(few(wanted), "doc_id", "left_semi")
    kind = rows.schema["doc_id"].dataType.simpleString()
    sets = stage(
        rows.mapInArrow(full_sets, f"doc_id {kind}, d1 BIGINT, d2 BIGINT, set ARRAY<BIGINT>")
        .where("size(set) > 0")
        .groupBy("doc_id")
        .agg(F.min(F.struct("d1", "d2", "set"))["set"].alias("set")),
        "near-sets",
    )
    both = (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("x")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("y")), "b")
        .withColumn("common", F.size(F.array_intersect("x", "y")))
    )
    return both.where(f"100 * common >= {SIMILARITY} * (size(x) + size(y) - common)").select("a", "b")


def sketched(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs that sizes and odd sketches leave possible."""
    of = lambda side: reps.select(
        F.col("rep").alias(side), F.struct("n_shingles", "sketch").alias(f"s{side}")
    )
    return (
        pairs.join(of("a"), "a").join(of("b"), "b").where(close("sa", "sb")).select("a", "b")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    signed = stage(
        rows.mapInArrow(
            sign,
            f"doc_id {kind}, n_shingles BIGINT, d1 BIGINT, d2 BIGINT, bands ARRAY<BIGINT>, sketch ARRAY<BIGINT>",
        ),
        "near-signed",
    )
    digest = ["d1", "d2", "n_shingles"]

    def nodes(*more: str) -> DataFrame:
        """One row per doc_id that has a set."""
        best = F.min(F.struct(*digest, *more)).alias("s")
        full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        return full.groupBy("doc_id").agg(best).select("doc_id", "s.*")

    reps = stage(
        nodes("bands", "sketch")
        .groupBy(*digest)
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
        "near-reps",
    )
    buckets = reps.select("rep", F.explode("bands").alias("band"))
    shared = (
        buckets.groupBy("band")
        .agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("hub"))
        .where("n > 1")
        .select("band", "hub")
    )
    # Members of buckets with company, with their bucket's first member.
    met = stage(buckets.join(shared, "band"), "near-buckets")
    first = stage(
        sketched(met.where("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), reps),
        "near-first",
    )
    links = stage(confirmed(first, docs), "near-links")
    parts = components(links)

    # Members outside their first member's component, with all of other components.
    labelled = (
        met.join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .join(
            parts.select(F.col("node").alias("hub"), F.col("component").alias("home")), "hub", "left"
        )
        .select(
            "band",
            "rep",
            F.coalesce("component", "rep").alias("component"),
            F.coalesce("home", "hub").alias("home"),
        )
    )
    labelled = stage(labelled, "near-labelled")
    mixed = labelled.where("component != home").select("band").distinct()
    members = stage(
        labelled.join(mixed, "band", "left_semi").join(
            reps.select("rep", "n_shingles", "sketch"), "rep"
        ),
        "near-mixed",
    )
    second = (
        members.where("component != home").alias("p")
        .join(
            members.alias("q"),
            F.expr(
                "p.band = q.band AND p.component != q.component"
                " AND (q.component = q.home OR p.rep < q.rep)"
            )
            & close("p", "q"),
        )
        .select(F.least("p.rep", "q.rep").alias("a"), F.greatest("p.rep", "q.rep").alias("b"))
        .distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    more = stage(confirmed(stage(second, "near-second"), docs), "near-more")
    # The new links join components, so only those are linked anew.
    label = lambda side: parts.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
    joined = components(
        more.join(label("a"), "a", "left")
        .join(label("b"), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    ).toDF("component", "joined")
    parts = parts.unionByName(
        joined.select(F.col("component").alias("node"), "component")
    ).distinct().join(joined, "component", "left").select("node", F.coalesce("joined", "component").alias("component"))

    labels = (
        nodes()
        .join(reps.select(*digest, "rep"), digest)
        .join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("doc_id", F.coalesce("component", "rep").alias("component"))
    )
    component = F.coalesce("component", "doc_id")
    return (
        signed.select("doc_id", "n_shingles")
        .join(labels, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` without those that a smaller doc_id of their component stands for."""
    gone = stage(near_duplicates(docs).where("NOT kept").select("doc_id").distinct(), "near-gone")
    return docs.join(few(gone), "doc_id", "left_anti").select(
        [F.col(f"`{c}`") for c in docs.columns]
    )
