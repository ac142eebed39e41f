"""Exact top-k search with block-at-a-time pruning.

Vectors are quantized to integers.  A term is a component with a sign: a
query's positive components meet a block's largest values, its negative ones
the smallest, so a block's bound is the sum of its term maxima weighed by the
query, and no vector in the block scores higher.

``blocks`` cuts the vectors, in the order of their ids, into blocks with a
forward index (ids and matrix) and term maxima.  Neighbouring blocks form a
region; queries form chunks.  Each pair of a chunk and a region is one row
that a task works on: every query takes the region's blocks in the order of
their bounds and scores them through the forward index until the next bound
falls below its k-th score; a bound equal to it is still scored, as ties go to
the smaller id.  The best k of each region are then merged per query.

Rows have bounded size (a region holds ``REGION`` vectors, a chunk ``CHUNK``
queries) and nothing is broadcast.

Defined results: vectors that are null or hold a null, NaN or infinite
component take no part, nor do rows without an id; a shorter vector counts as
padded with zeros; of rows that repeat an id the one with the largest
components counts; a query meets every other id; no vectors or no queries give
no rows; other columns are not read.  Scores must fit a BIGINT.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.sources.stage import stage

BLOCK = 512
REGION = 16 * BLOCK
CHUNK = 2048
PACKED = "ids BINARY, width INT, matrix BINARY"
FIELDS = ("ids", "width", "matrix")


def quantized(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(256 x) of the vectors that take part, one row per id."""
    x = "cast(x AS DOUBLE)"
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("raw")).where(
        f"vec_id IS NOT NULL AND raw IS NOT NULL AND forall(raw, x -> x IS NOT NULL AND NOT isnan({x})"
        f" AND abs({x}) < double('inf'))"
    )
    made = rows.select("vec_id", F.expr(f"transform(raw, x -> floor(256 * {x}))").alias("v"))
    return made.groupBy("vec_id").agg(F.max("v").alias("v"))


def matrix_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and zero-padded integer matrix of a batch of (vec_id, v)."""
    lists = batch["v"]
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    matrix = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = flat
    return batch["vec_id"].to_numpy(), matrix


def packed_rows(size: int):
    """Batches of (vec_id, v) in order to rows of up to ``size`` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def made() -> pa.RecordBatch:
            ids = np.concatenate([i for i, _ in held])
            matrix = np.zeros((len(ids), max(m.shape[1] for _, m in held)), np.int64)
            at = 0
            for i, m in held:
                matrix[at : at + len(i), : m.shape[1]] = m
                at += len(i)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                    pa.array([matrix.shape[1]], pa.int32()),
                    pa.array([compact(matrix).tobytes()], pa.binary()),
                ],
                names=list(FIELDS),
            )

        count = 0
        for batch in batches:
            for begin in range(0, batch.num_rows, size):
                ids, matrix = matrix_of(batch.slice(begin, size))
                while len(ids):
                    take = min(size - count, len(ids))
                    held.append((ids[:take], matrix[:take]))
                    ids, matrix, count = ids[take:], matrix[take:], count + take
                    if count == size:
                        yield made()
                        count = 0
        if held:
            yield made()

    return run


def packed(vectors: DataFrame, size: int) -> DataFrame:
    """Rows of up to ``size`` vectors each, in ranges of ids."""
    ordered = vectors.repartitionByRange("vec_id").sortWithinPartitions("vec_id")
    return ordered.mapInArrow(packed_rows(size), PACKED)


def compact(matrix: np.ndarray) -> np.ndarray:
    """The matrix in the smallest integers that hold it."""
    low, high = int(matrix.min(initial=0)), int(matrix.max(initial=0))
    kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return matrix.astype(kind)


def unpacked(row: dict, side: str) -> tuple[np.ndarray, np.ndarray]:
    ids, width, data = row[f"{side}_ids"], row[f"{side}_width"], row[f"{side}_matrix"]
    ids = np.frombuffer(ids, "<i8")
    item = len(data) // (len(ids) * width) if width else 8
    return ids, np.frombuffer(data, f"<i{item}").reshape(len(ids), width).astype(np.int64)


def exact_floats(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether all inner products are whole numbers that floating point holds exactly."""
    most = lambda m: float(np.abs(m.astype(float)).max(initial=0))
    return most(left) * most(right) * max(left.shape[1], 1) < 2**52


def search(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, m: np.ndarray, k: int):
    """Best k of ``m`` per query, block by block: (query row, id, score) arrays."""
    width = max(q.shape[1], m.shape[1])
    q, m = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, m))
    if exact_floats(q, m):
        q, m = q.astype(np.float64), m.astype(np.float64)
    least = np.array(-(2**63 - 1)).astype(m.dtype)
    begins = np.arange(0, len(ids), BLOCK)
    bounds = np.maximum(q, 0) @ np.maximum.reduceat(m, begins).T
    bounds += np.minimum(q, 0) @ np.minimum.reduceat(m, begins).T
    order = np.argsort(-bounds, axis=1, kind="stable")
    best = np.full((len(q), k), least, m.dtype)
    best_id = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
    for step in range(len(begins)):
        block = order[:, step]
        going = np.flatnonzero(bounds[np.arange(len(q)), block] >= best[:, -1])
        if not len(going):
            break
        for b in np.unique(block[going]):
            rows = going[block[going] == b]
            inner = slice(begins[b], min(begins[b] + BLOCK, len(ids)))
            scores = q[rows] @ m[inner].T
            own = ids[inner]
            # Only candidates that can enter; ids rise within a block, so a stable
            # sort by falling score leaves ties in the order of their ids.
            top = np.argsort(-scores, axis=1, kind="stable")[:, : k + 1]
            score = np.take_along_axis(scores, top, axis=1)
            found = own[top]
            self_ = found == q_ids[rows][:, None]
            score = np.concatenate([best[rows], np.where(self_, least, score)], axis=1)
            found = np.concatenate(
                [best_id[rows], np.where(self_, np.iinfo(np.int64).max, found)], axis=1
            )
            # By falling score, then rising id.
            place = np.lexsort((found, -score), axis=1)[:, :k]
            best[rows] = np.take_along_axis(score, place, axis=1)
            best_id[rows] = np.take_along_axis(found, place, axis=1)
    row, column = np.nonzero(best_id < np.iinfo(np.int64).max)
    return row, best_id[row, column], best[row, column].astype(np.int64)


def search_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                q_ids, q = unpacked(row, "q")
                ids, m = unpacked(row, "r")
                at, found, score = search(q_ids, q, ids, m, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[at]), pa.array(found), pa.array(score)],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """Per query the k highest scores over all other vectors; both are ``quantized``."""
    regions = stage(
        packed(vectors, REGION).withColumn("region", F.monotonically_increasing_id()), "topk-regions"
    )
    chunks = stage(
        packed(queries, CHUNK).withColumn("chunk", F.monotonically_increasing_id()), "topk-chunks"
    )
    # Pairs of a chunk and a region, dealt by both: about as many places as regions.
    numbers = [r["chunk"] for r in chunks.select("chunk").collect()] or [-1]
    places = max(regions.count(), 1)
    side = lambda s: [F.col(c).alias(f"{s}_{c}") for c in FIELDS]
    each = regions.select(
        F.pmod(F.xxhash64("region"), F.lit(places)).alias("place"),
        F.explode(F.array(*map(F.lit, numbers))).alias("chunk"),
        *side("r"),
    )
    asked = chunks.select(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(places - 1))).alias("place"), *side("q")
    )
    found = each.join(asked, ["chunk", "place"]).mapInArrow(
        search_rows(k), "query_id BIGINT, vec_id BIGINT, score BIGINT"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
