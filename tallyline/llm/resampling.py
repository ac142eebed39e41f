"""Importance resampling towards a target distribution of hashed word runs.

A feature is a run of 1 to ``most`` consecutive words; its bucket is the CRC of
its bytes modulo ``size``.  Both corpora are counted over all texts, every
bucket gets a gain (the smoothed log ratio of the target's share to the
corpus's share, in thousandths), and a document's weight is the floored mean of
its features' gains.  Weight plus noise from the document's id is its score; the
documents with the highest scores are drawn, which is sampling without
replacement by weight (Gumbel noise).

1. ``hashed`` writes the buckets of every text once.  ``gains`` counts them: a
   task sends one count per bucket, and ``size`` sums reach the driver.
2. ``scored`` looks the gains of a document's buckets up in one array and
   persists weight and score.
3. ``cutoff`` finds the last drawn row by bisection over numeric keys (score,
   then the id among equal scores, then a row number among repeated rows): each
   job counts the rows up to the thresholds that the next ``HALVINGS`` halvings
   can ask for, exactly and over all persisted rows.  No rows are sorted or
   gathered for it.
4. Only the drawn rows are partitioned by range and sorted; a row's rank is its
   place in its partition plus the rows of the partitions before.

Defined results: a null or empty text has no features and weight 0; a null
doc_id takes noise of the empty id and comes last among equal scores; repeated
rows are documents of their own; rows equal in score and id are drawn by fewer
features first, then in any order; an empty corpus gives no rows, an empty
target counts as no features; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm import words as W
from tallyline.llm.tables import small_batches
from tallyline.sources.stage import stage

BUCKETS = 10_000
RUN = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
HALVINGS = 3
ROW_BITS = 33  # of monotonically_increasing_id, for the row inside its partition


def features(column: pa.Array, most: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, features per text, and the buckets of all features, text by text."""
    words = W.split(W.texts(column, lower=True), W.NOT_WORD)
    names = words.names.to_pylist()
    rows, ids = words.rows, words.ids
    owners, buckets = [], []
    starts = np.arange(len(ids))
    for length in range(1, most + 1):
        if length > 1:
            ids = W.paired(ids[:-1], words.ids[length - 1 :])
            starts = np.flatnonzero(rows[: len(ids)] == rows[length - 1 :]) if len(ids) else starts[:0]
        first = np.unique(ids, return_index=True)[1]
        runs = (words.ids[i : i + length] for i in first)
        sums = np.fromiter(
            (zlib.crc32(b" ".join([names[w] for w in run])) % size for run in runs), np.int32, len(first)
        )
        buckets.append(sums[ids[starts]])
        owners.append(rows[starts])
    owner, bucket = np.concatenate(owners), np.concatenate(buckets)
    if most > 1:
        bucket = bucket[np.argsort(owner, kind="stable")]
    return words.counts, np.bincount(owner, minlength=len(column)), bucket


def hashed_rows(most: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.parts(batch["text"]):
                n_words, n, flat = features(batch["text"][part], most, size)
                bounds = np.append(0, np.cumsum(n)).astype(np.int32)
                made = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][part], pa.array(n_words.astype(np.int64)), made],
                    names=["doc_id", "n_words", "buckets"],
                )

    return run


def hashed(docs: DataFrame, most: int = RUN, size: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, buckets) of every row of ``docs``, written once."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words BIGINT, buckets ARRAY<INT>"
    return stage(rows.mapInArrow(hashed_rows(most, size), schema), "resample-hashed")


def flattened(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All items of a list column without nulls, and where each list starts."""
    ends = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), ends - ends[0]


def counted(hashes: DataFrame, size: int) -> np.ndarray:
    """Features per bucket over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(flattened(batch["buckets"])[0], minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    parts = hashes.select("buckets").mapInArrow(run, "bucket BIGINT, n BIGINT")
    made = np.zeros(size, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        made[row["bucket"]] = row["n"]
    return made


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, per bucket."""
    size = len(corpus)
    above = (target + 1).astype(float) * float(corpus.sum() + size)
    below = (corpus + 1).astype(float) * float(target.sum() + size)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, a function of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scored(hashes: DataFrame, gain: np.ndarray, seed: str = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row with its own number ``at``, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = flattened(batch["buckets"])
            n, total = np.diff(bounds), W.between(gain[flat], bounds)
            columns = [batch["doc_id"], batch["n_words"], pa.array(n.astype(np.int64)), pa.array(total // np.maximum(n, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    kind = hashes.schema["doc_id"].dataType.simpleString()
    weighed = hashes.mapInArrow(run, f"doc_id {kind}, n_words BIGINT, n_features BIGINT, weight BIGINT")
    score = (F.col("weight") + noise(F.col("doc_id"), seed)).cast("bigint")
    return stage(
        weighed.withColumns({"score": score, "at": F.monotonically_increasing_id()}), "resample-scored"
    )


def order_keys() -> list[Column]:
    """Numbers that put the best row first; together they differ between any two rows."""
    return [
        -F.col("score"), F.col("doc_id").isNull().cast("bigint"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), F.col("n_features"), F.col("at"),
    ]


def thresholds(low: int, high: int, halvings: int = HALVINGS) -> list[int]:
    """The middles that so many halvings of [low, high] may ask for, in order."""
    if low >= high or halvings == 0:
        return []
    middle = (low + high) // 2
    return [*thresholds(low, middle, halvings - 1), middle, *thresholds(middle + 1, high, halvings - 1)]


def bisect(rows: DataFrame, key: Column, wanted: int) -> tuple[int, int, int]:
    """The smallest value that ``wanted`` rows do not exceed, the rows below it, and those at it."""
    ends = rows.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    low, high = ends["low"], ends["high"]
    while low < high:
        middles = thresholds(low, high)
        counts = rows.agg(*(F.count_if(key <= m) for m in middles)).first()
        for middle, count in zip(middles, counts, strict=True):
            if count >= wanted:
                high = min(high, middle)
            else:
                low = max(low, middle + 1)
    row = rows.agg(F.count_if(key < low).alias("below"), F.count_if(key == low).alias("at")).first()
    return low, row["below"], row["at"]


def cutoff(rows: DataFrame, wanted: int) -> Column:
    """True for the first ``wanted`` rows in the order of ``order_keys``."""
    if wanted == 0:
        return F.lit(False)
    levels: list[tuple[Column, int]] = []
    for key in order_keys():
        value, below, tied = bisect(rows, key, wanted)
        levels.append((key, value))
        if below + tied == wanted:
            break
        wanted -= below
        rows = rows.where(key == value)
    key, value = levels.pop()
    taken = key <= value
    for key, value in reversed(levels):
        taken = (key < value) | ((key == value) & taken)
    return taken


def ranked(drawn: DataFrame, rank: str = "rank") -> DataFrame:
    """``drawn`` with its places 1, 2, 3... in the order of ``order_keys``."""
    keys = order_keys()
    placed = stage(
        drawn.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id()),
        "resample-drawn",
    )
    part = F.shiftright("_place", ROW_BITS)
    earlier, offsets = 0, []
    # One count per partition.
    for number, n in sorted(placed.groupBy(part.alias("_part")).count().collect()):
        offsets.append((number, earlier))
        earlier += n
    starts = drawn.sparkSession.createDataFrame(offsets, "_part BIGINT, _earlier BIGINT")
    place = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
        .withColumn(rank, place + F.col("_earlier") + 1).drop("_part", "_earlier", "_place")
    )


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    most: int = RUN, size: int = BUCKETS, seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; rank only where it is drawn.

    ``docs`` and ``target`` have (doc_id, text).  Of the rows with at least
    ``least_words`` words, ``percent`` in a hundred are drawn.
    """
    hashes = hashed(docs, most, size)
    gain = gains(counted(hashes, size), counted(hashed(target, most, size), size))
    rows = scored(hashes, gain, seed)
    eligible = F.col("n_words") >= least_words
    pool = rows.where(eligible)
    taken = eligible & cutoff(pool, percent * pool.count() // 100)
    names = ["doc_id", "n_features", "weight", "score"]
    rest = rows.where(~taken).select(*names, F.lit(None).cast("bigint").alias("rank"))
    return ranked(rows.where(taken)).select(*names, "rank").unionByName(rest)
