"""License statements found by diagonal voting.

Every rolling word k-gram of every text is joined with the k-grams of the
templates.  A hit at text position p and template position t votes for the
diagonal p - t; a whole statement puts all its votes on one diagonal, an
edited one on a few neighbouring diagonals.  Neighbouring diagonals of a
template are merged, and a span is verified against the template: exact
phrases need every k-gram of the phrase on one diagonal, statements need
``COVERAGE`` percent of the template's k-grams within ``STRETCH`` percent of
its length.  Hits are joined on one 64-bit hash and checked on a second one.

Only the templates are broadcast: they are constants, a few dozen rows.  Texts
travel to Python once and never through an exchange; long texts are sent back
in pieces of ``PIECE`` words, so no row grows with its text.

Defined results: a null or empty text has no words, no places and score 0;
repeated rows are scanned one by one (rows are told apart by a row number, not
by doc_id); a null doc_id is kept; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm import words as W
from tallyline.llm.tables import small_batches


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    exact: bool = False

    @property
    def gram(self) -> int:
        return 2 if self.exact else 3


# Phrases whose places are counted, and license statements.
PHRASES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)
STATEMENTS = (
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template(
        "gpl-3.0", "this work is licensed under the gnu general public license version 3"
    ),
    Template("mit", "released under the mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
    ),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
)
PIECE = 4096
GRAMS = (2, 3)
BAND = 2
COVERAGE = 60
STRETCH = 130
# A gram every document has once: it carries documents without hits through the join.
ROOT = np.uint64(0x726F6F74)


def grams(column: pa.Array) -> tuple[W.Words, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Words of lower-cased texts and two hashes of the k-grams at each word."""
    words = W.split(W.texts(column, lower=True), W.NOT_WORD)
    first, second = (h[words.ids] for h in W.name_hashes(words.names))
    return words, {k: (W.rolling(first, k), W.rolling(second, k)) for k in GRAMS}


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of at most ``PIECE`` words: the 2-gram hashes, then the 3-gram hashes."""
    for batch in batches:
        for part in W.parts(batch["text"]):
            words, hashes = grams(batch["text"][part])
            total = len(words.ids)
            counts = words.counts
            n_pieces = np.maximum(-(-counts // PIECE), 1)
            rows = np.repeat(np.arange(len(counts)), n_pieces)
            at = (np.arange(len(rows)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)) * PIECE
            size = np.minimum(counts[rows] - at, PIECE)
            padded = []
            for k in GRAMS:
                # No gram where a text ends before k words: hash 0 is no template's.
                whole = np.zeros(total, bool)
                begin = np.arange(max(total - k + 1, 0))
                owner = words.rows
                whole[begin] = owner[begin] == owner[begin + k - 1]
                both = []
                for h in hashes[k]:
                    full = np.zeros(total, np.uint64)
                    full[: len(h)] = h
                    both.append(np.where(whole, full, 0))
                padded.append(both)
            sides = []
            bounds = np.zeros(len(rows) + 1, np.int64)
            np.cumsum(2 * size + 1, out=bounds[1:])
            for side in (0, 1):
                flat = np.zeros(bounds[-1], np.uint64)
                begin = words.bounds[:-1][rows] + at
                inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                source = np.repeat(begin, size) + inner
                target = np.repeat(bounds[:-1], size) + inner
                flat[target] = padded[0][side][source]
                flat[target + np.repeat(size, size)] = padded[1][side][source]
                flat[bounds[1:] - 1] = np.where(at == 0, ROOT, 0)
                sides.append(flat)
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(bounds.astype(np.int32)), pa.array(flat.view(np.int64))
                )
                for flat in sides
            ]
            taken = batch.slice(part.start, part.stop - part.start).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    taken["row"], taken["doc_id"], pa.array(counts[rows].astype(np.int64)),
                    pa.array(at.astype(np.int64)), pa.array(size.astype(np.int64)), *lists,
                ],
                names=["row", "doc_id", "n_words", "at", "size", "gram", "proof"],
            )


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """One row per template position; bounded by the templates' words."""
    rows = [(-1, "", False, 1, 1, 0, int(ROOT), int(ROOT))]
    for number, t in enumerate(templates):
        words, hashes = grams(pa.array([t.text]))
        first, second = (h.view(np.int64).tolist() for h in hashes[t.gram])
        rows += [
            (number, t.label, t.exact, len(words.ids), len(first), i, a, b)
            for i, (a, b) in enumerate(zip(first, second, strict=True))
        ]
    return spark.createDataFrame(
        rows,
        "template INT, label STRING, exact BOOLEAN, length BIGINT, n_grams BIGINT, "
        "place BIGINT, gram BIGINT, proof BIGINT",
    )


def hits(docs: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """Every k-gram of every text that stands in a template; a root row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    cut = rows.mapInArrow(
        pieces,
        f"row BIGINT, doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words BIGINT, "
        "at BIGINT, size BIGINT, gram ARRAY<BIGINT>, proof ARRAY<BIGINT>",
    )
    known = template_grams(spark, templates)
    each = cut.select("*", F.posexplode("gram").alias("i", "hash")).where("hash != 0")
    joined = each.join(
        F.broadcast(known.select(F.struct("*").alias("t"))), F.col("hash") == F.col("t.gram")
    )
    found = joined.where(
        "t.template = -1 OR (proof[i] = t.proof AND t.exact = (i < size))"
    ).select(
        "row", "doc_id", "n_words", "t.template", "t.label", "t.exact", "t.length",
        "t.n_grams", "t.place", F.expr("at + i % greatest(size, 1)").alias("pos"),
    )
    return found.repartition("row")


def spans(found: DataFrame) -> DataFrame:
    """Verified places: votes per diagonal, neighbours merged, then compared with the template."""
    what = ["row", "template"]
    diagonals = found.groupBy(*what, (F.col("pos") - F.col("place")).alias("diagonal")).agg(
        *(F.first(c).alias(c) for c in ("doc_id", "n_words", "label", "exact", "length", "n_grams")),
        F.count(F.lit(1)).alias("votes"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
    )
    order = Window.partitionBy(*what).orderBy("first", "diagonal")
    apart = (
        F.col("exact")
        | F.lag("diagonal").over(order).isNull()
        | (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > BAND)
        | (F.col("first") > F.lag("last").over(order) + 3 + BAND)
    )
    merged = diagonals.withColumn("apart", F.when(apart, 1).otherwise(0)).withColumn(
        "span", F.sum("apart").over(order)
    )
    found = merged.groupBy(*what, "span").agg(
        *(F.first(c).alias(c) for c in ("doc_id", "n_words", "label", "exact", "length", "n_grams")),
        F.sum("votes").alias("votes"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    statement = (100 * F.col("votes") >= COVERAGE * F.col("n_grams")) & (
        100 * (F.col("last") - F.col("first") + 3) <= STRETCH * F.col("length")
    )
    whole = F.col("votes") == F.col("n_grams")
    return found.where((F.col("template") == -1) | F.when(F.col("exact"), whole).otherwise(statement))


def scan(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + STATEMENTS) -> DataFrame:
    """One row per document: places of the phrases, labels and a score.

    The score is the best share of a template's k-grams found in a verified
    span; an exact phrase scores 1.
    """
    listed = lambda test: F.array_join(
        F.array_sort(F.collect_set(F.when(test, F.col("label")))), ","
    )
    exact = F.col("exact") & (F.col("template") >= 0)
    return (
        spans(hits(docs, templates))
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.count_if(exact).alias("n_base"),
            F.min(F.when(exact, F.col("first"))).alias("first_word"),
            F.max(F.when(exact, F.col("first"))).alias("last_word"),
            listed(exact).alias("base_labels"),
            listed(F.col("template") >= 0).alias("labels"),
            F.coalesce(
                F.max(F.when(F.col("template") >= 0, F.least(F.col("votes") / F.col("n_grams"), F.lit(1.0)))),
                F.lit(0.0),
            ).alias("score"),
        )
        .drop("row")
    )
