"""Quality classifier by co-training of two views.

The text view is made of character shares, word statistics and hashed runs of
one and two words of the whole text; the metadata view of language, source and
length, hashed.  Each view has a logistic regression.  In every round each
classifier scores all documents, and labels that it is sure of, of documents
that have none, become training rows of the other one.

Everything is cross-fitted: labelled documents are dealt into ``FOLDS`` folds,
and next to the classifier that learns from all of them, one per fold never sees
its labels, neither directly nor through the labels it gives to others.  Those
classifiers score the labelled documents; on these scores both views are
calibrated (their log odds are added up, counting the prior once), and the
threshold is taken: the score below which at most ``LOST`` of the good documents
lie.  The rank that stands for it is ``LOST`` times their number less one
standard deviation of that count, interpolated between neighbouring scores (the
score before the lowest is 0); one rule at every number of labels.

Fitting uses bounded samples: at most ``LABELLED`` labelled documents per class,
and of the documents that a view is sure of about ``PSEUDO`` per class, chosen
by digests of their ids.  A sampled row weighs as much as the rows of its kind
that it stands for.  All documents are scored in every round and in the end.

A fit is one task over its bounded sample, all fits of a round are one job.
Features are computed once per document and written (a few bytes per distinct
word); a round reads them, never the texts.

Defined results: of several labels of a document the lowest counts, null labels
are none; without two labelled documents of each class every document scores 1
and is kept; null or empty texts and null metadata have features of their own;
repeated rows score alike; an empty table gives no rows; other columns are
carried by ``kept`` and not read by ``score``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm import words as W
from tallyline.llm.quality_rules import MEASURES, measure
from tallyline.llm.tables import small_batches
from tallyline.sources.stage import stage

LABELLED = 3_000
PSEUDO = 1_000
FOLDS = 3
ROUNDS = 2
STEPS = 200
ENOUGH = 1e-5  # a step that gains less than this share of the loss is the last
MEMORY = 10  # of past steps
SURE = float(np.log(0.95 / 0.05))
LOST = 0.005
HASHED = 1 << 16
BLOCK = 1 << 18  # entries of sparse rows that are widened to doubles at a time
DENSE = 138
PENALTY = 1e-4
VIEWS = ("text", "meta")
NEEDED = ("doc_id", "text", "lang", "source", "n_chars")
UPPER = (W.BYTES >= 0x41) & (W.BYTES <= 0x5A)
SHARE = np.dtype("<f2")
PLACE = np.dtype("<u2")


@dataclass
class Features:
    """Both views of a batch: a dense block, hashed word runs and hashed metadata, as flat arrays."""

    dense: np.ndarray
    grams: np.ndarray
    shares: np.ndarray
    gram_counts: np.ndarray
    meta: np.ndarray

    def __len__(self) -> int:
        return len(self.dense)

    def odds(self, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
        """Raw log odds of the text view and of the metadata view."""
        runs = Rows(self.grams, self.shares, self.gram_counts, HASHED).summed(weights.text[DENSE:])
        text = self.dense @ weights.text[:DENSE] + runs + weights.text_base
        return text, weights.meta[self.meta].sum(axis=1) + weights.meta_base

    def stored(self) -> list[pa.Array]:
        """One binary value per document and block."""
        n = len(self)
        flat = (self.dense.astype("<f4"), self.grams.astype(PLACE), self.shares.astype(SHARE), self.meta.astype(PLACE))
        sizes = (np.full(n, 4 * DENSE), self.gram_counts * 2, self.gram_counts * 2, np.full(n, 2 * self.meta.shape[1]))
        made = []
        for values, size in zip(flat, sizes, strict=True):
            ends = np.append(0, np.cumsum(size)).astype(np.int32)
            made.append(pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())]))
        return made

    @classmethod
    def read(cls, batch: pa.RecordBatch) -> Features:
        def flat(name: str, kind: str | np.dtype) -> tuple[np.ndarray, np.ndarray]:
            column = batch[name]
            ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
            return data.view(kind), np.diff(ends)

        # Places and shares stay narrow; they are widened block by block where they are used.
        grams, sizes = flat("grams", PLACE)
        shares = flat("shares", SHARE)[0].astype(np.float32)
        meta = flat("meta", PLACE)[0].reshape(batch.num_rows, -1)
        dense = flat("dense", "<f4")[0].reshape(batch.num_rows, DENSE).astype(float)
        return cls(dense, grams, shares, sizes // 2, meta.astype(np.int64))


BLOCKS = ("dense", "grams", "shares", "meta")


def text_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Dense features, then hashed word runs with their shares, and their number per text."""
    source = W.texts(column)
    n_texts = len(source)
    rows = np.repeat(np.arange(n_texts), np.diff(source.bounds))
    kinds = np.minimum(source.data, 128)
    counts = np.bincount(rows * 129 + kinds, minlength=n_texts * 129).reshape(-1, 129)
    size = np.maximum(counts.sum(axis=1), 1)
    words = W.split(W.texts(column, lower=True), W.WHITE)
    n = np.maximum(words.counts, 1)
    distinct = np.unique(words.rows << 32 | words.ids) >> 32
    owner = words.rows
    neighbours = owner[1:] == owner[:-1]
    again = np.append(False, neighbours & (words.ids[1:] == words.ids[:-1]))[: len(owner)]
    m = dict(zip(MEASURES, measure(column).flatten(), strict=True))
    m = {k: v.to_numpy() for k, v in m.items()}
    more = [
        np.bincount(distinct, minlength=n_texts) / n,
        m["word_chars"] / n / 10,
        m["n_symbols"] / n,
        m["n_dup_lines"] / np.maximum(m["n_lines"], 1),
        m["n_repeat_words"] / n,
        np.log1p(m["n_words"]) / 10,
        source.count(UPPER[source.data]) / size,
        (words.counts == 0).astype(float),
        np.bincount(owner, again, n_texts) / n,
    ]
    dense = np.concatenate([np.sqrt(counts / size[:, None]), np.stack(more, axis=1)], axis=1)
    hashes = W.name_hashes(words.names)[0][words.ids] if len(words.ids) else np.zeros(0, np.uint64)
    pairs = W.mixed(hashes[:-1] * np.uint64(31) + hashes[1:])[neighbours]
    place = np.concatenate([hashes, pairs]) & np.uint64(HASHED - 1)
    of = np.concatenate([owner, owner[:-1][neighbours]])
    keys, times = np.unique(of.astype(np.int64) << 16 | place.astype(np.int64), return_counts=True)
    of = keys >> 16
    total = np.bincount(of, times, n_texts)
    return dense, keys & (HASHED - 1), np.sqrt(times / total[of]), np.bincount(of, minlength=n_texts)


def meta_features(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """Places of language, source and the binary digits of the length."""
    lengths = ["?" if n is None else str(max(int(n), 0).bit_length()) for n in n_chars.to_pylist()]
    columns = [[("?" if v is None else f"={v}") for v in c.to_pylist()] for c in (lang, source)] + [lengths]
    place = lambda i, v: xxhash.xxh3_64_intdigest(f"{i}{v}") % HASHED
    known: dict[tuple[int, str], int] = {}
    made = np.empty((len(lengths), len(columns)), np.int64)
    for i, values in enumerate(columns):
        for row, value in enumerate(values):
            if (i, value) not in known:
                known[i, value] = place(i, value)
            made[row, i] = known[i, value]
    return made


def features(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> Iterator[tuple[slice, Features]]:
    for part in W.parts(text):
        yield part, Features(*text_features(text[part]), meta_features(lang[part], source[part], n_chars[part]))


def prepared(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", "text", F.col("lang").cast("string"), F.col("source").cast("string"),
        F.col("n_chars").cast("bigint"),
    )


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, at, blocks of features) of every row, written once; ``at`` is the row's own number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, made in features(*(batch[c] for c in NEEDED[1:])):
                yield pa.RecordBatch.from_arrays([batch["doc_id"][part], *made.stored()], names=["doc_id", *BLOCKS])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{b} BINARY" for b in BLOCKS)
    return stage(prepared(docs).mapInArrow(run, schema).withColumn("at", F.monotonically_increasing_id()), "train-features")


@dataclass(frozen=True)
class Weights:
    """Coefficients of both views."""

    text: np.ndarray
    text_base: float
    meta: np.ndarray
    meta_base: float


def labels_of(labels: DataFrame) -> DataFrame:
    """(doc_id, label): one row per labelled document."""
    return labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.when(F.col("quality") > 0, 1.0).otherwise(0.0)).alias("label")
    )


@dataclass(frozen=True)
class Examples:
    """Features of all documents, which of them are labelled, and the sample that fits see."""

    table: DataFrame
    known: DataFrame
    sample: DataFrame
    counts: dict[float, int]

    @property
    def enough(self) -> bool:
        per = {r["label"]: r["n"] for r in self.sample.groupBy("label").agg(F.countDistinct("doc_id").alias("n")).collect()}
        return len(per) == 2 and min(per.values()) >= 2


def picked_rows(table: DataFrame, picked: DataFrame, label: str) -> DataFrame:
    """The features of a bounded number of rows, written once."""
    return stage(table.drop("doc_id").join(F.broadcast(picked), "at"), label)


def training_rows(docs: DataFrame, labels: DataFrame) -> Examples:
    """Features of all of ``docs``, and a bounded sample of the labelled ones in folds."""
    table = feature_table(docs)
    known = stage(table.select("at", "doc_id").join(labels_of(labels), "doc_id"), "train-labels")
    digest = F.xxhash64("doc_id")
    parts = [known.where(F.col("label") == c).orderBy(digest, "doc_id", "at").limit(LABELLED) for c in (0.0, 1.0)]
    drawn = stage(parts[0].unionByName(parts[1]), "train-drawn")
    count = lambda df: {r["label"]: r["n"] for r in df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    every, taken = count(known), count(drawn)
    weight = F.lit(1.0)
    for label, n in taken.items():
        weight = F.when(F.col("label") == label, every[label] / n).otherwise(weight)
    # At most 2 * LABELLED rows: one task deals a class's documents into folds.
    order = Window.partitionBy("label").orderBy(digest, "doc_id")
    fold = (F.dense_rank().over(order) % FOLDS).cast("int")
    picked = drawn.select("at", "doc_id", "label", weight.alias("weight"), fold.alias("fold"))
    return Examples(table, known, picked_rows(table, picked, "train-sample"), every)


@dataclass
class Rows:
    """Sparse rows of a view: places and values, and how many each row has.

    A sample holds millions of entries: they stay as narrow as they come, and
    arithmetic in doubles runs over blocks of whole rows of about ``BLOCK``
    entries.  Sums are added up in the same order whatever the block.
    """

    places: np.ndarray
    values: np.ndarray
    counts: np.ndarray
    size: int

    def blocks(self) -> Iterator[tuple[slice, slice]]:
        """Rows and their entries."""
        ends = np.append(0, np.cumsum(self.counts, dtype=np.int64))
        row = 0
        while row < len(self.counts):
            last = max(int(np.searchsorted(ends, ends[row] + BLOCK, "right")) - 1, row + 1)
            yield slice(row, last), slice(int(ends[row]), int(ends[last]))
            row = last

    def weighed(self, entries: slice, weights: np.ndarray) -> np.ndarray:
        return self.values[entries] * weights[self.places[entries]]

    def times(self, weights: np.ndarray) -> np.ndarray:
        made = np.zeros(len(self.counts))
        for rows, entries in self.blocks():
            counts = self.counts[rows]
            full = np.flatnonzero(counts)
            if len(full):
                starts = (np.cumsum(counts) - counts)[full]
                made[rows][full] = np.add.reduceat(self.weighed(entries, weights), starts)
        return made

    def summed(self, weights: np.ndarray) -> np.ndarray:
        """``times``, each row's entries added one after the other."""
        made = np.zeros(len(self.counts))
        for rows, entries in self.blocks():
            counts = self.counts[rows]
            owner = np.repeat(np.arange(len(counts)), counts)
            made[rows] = np.bincount(owner, self.weighed(entries, weights), len(counts))
        return made

    def gathered(self, by_row: np.ndarray) -> np.ndarray:
        made = np.zeros(self.size)
        for rows, entries in self.blocks():
            given = np.repeat(by_row[rows], self.counts[rows]) * self.values[entries]
            np.add.at(made, self.places[entries].astype(np.intp), given)
        return made


def view_rows(made: Features, view: str) -> tuple[np.ndarray, Rows]:
    """Dense block and sparse rows of a view."""
    if view == "text":
        return made.dense, Rows(made.grams, made.shares, made.gram_counts, HASHED)
    places = made.meta.ravel()
    return made.dense[:, :0], Rows(places, np.ones(len(places)), np.full(len(made), made.meta.shape[1]), HASHED)


def regression(dense: np.ndarray, rows: Rows, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float, int]:
    """Weighted logistic regression with a penalty on the coefficients, by limited-memory BFGS.

    Gives the coefficients (dense ones first), the intercept, and the steps taken.
    """
    size = dense.shape[1]
    weight = weight / weight.sum()
    sign = 2 * label - 1

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        margin = sign * (dense @ w[:size] + rows.times(w[size:-1]) + w[-1])
        push = -sign * weight / (1 + np.exp(np.clip(margin, -500, 500)))
        slope = np.concatenate([dense.T @ push, rows.gathered(push), [push.sum()]])
        slope[:-1] += PENALTY * w[:-1]
        return float(weight @ np.logaddexp(0, -margin) + PENALTY / 2 * (w[:-1] @ w[:-1])), slope

    w = np.zeros(size + rows.size + 1)
    value, slope = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    steps = 0
    for steps in range(1, STEPS + 1):
        way, shares = slope.copy(), []
        for moved, turned in reversed(past):
            shares.append(moved @ way / (turned @ moved))
            way -= shares[-1] * turned
        if past:
            moved, turned = past[-1]
            way *= moved @ turned / (turned @ turned)
        for (moved, turned), share in zip(past, reversed(shares), strict=True):
            way += moved * (share - turned @ way / (turned @ moved))
        reach = 1.0
        while True:
            further = w - reach * way
            lower, next_slope = loss(further)
            if lower <= value - 1e-4 * reach * (slope @ way) or reach < 1e-8:
                break
            reach /= 2
        gain, moved, turned = value - lower, further - w, next_slope - slope
        if gain <= 0:
            break
        if moved @ turned > 0:
            past = [*past, (moved, turned)][-MEMORY:]
        w, value, slope = further, lower, next_slope
        if gain < ENOUGH * value:
            break
    return w[:-1], float(w[-1]), steps


def fit_group(table: pa.Table) -> pa.Table:
    """One run's view, from its bounded sample."""
    batch = table.combine_chunks().to_batches()[0]
    task = batch["task"][0].as_py()
    dense, rows = view_rows(Features.read(batch), VIEWS[task % 2])
    w, base, steps = regression(dense, rows, batch["label"].to_numpy(), batch["weight"].to_numpy())
    columns = [pa.array([task], pa.int32()), pa.array([w.tobytes()], pa.binary()), pa.array([base]), pa.array([steps], pa.int32())]
    return pa.Table.from_arrays(columns, names=["task", "coefficients", "base", "steps"])


def fit_all(examples: Examples, extra: DataFrame | None) -> list[Weights]:
    """The classifiers of all runs: one that sees all labels, then one per left-out fold.

    Each run's view is one task over at most 2 * ``LABELLED`` rows and the picks.
    """
    runs = range(FOLDS + 1)
    tasks = [(run, view, chosen(run, view)) for run in runs for view in VIEWS]
    uses = [F.when(F.lit(run == 0) | (F.col("fold") != run - 1), F.lit(task)) for run, _, task in tasks]
    own = examples.sample.select("label", "weight", *BLOCKS, F.explode(F.array_compact(F.array(*uses))).alias("task"))
    data = own
    if extra is not None:
        # A view learns what the other one is sure of.
        given = [F.struct(F.lit(task).alias("task"), F.col("picks")[task ^ 1].alias("pick")) for *_, task in tasks]
        more = extra.select(*BLOCKS, F.explode(F.filter(F.array(*given), lambda g: g["pick"] != 0)).alias("g"))
        data = own.unionByName(
            more.select(
                F.when(F.col("g.pick") > 0, 1.0).otherwise(0.0).alias("label"), F.abs("g.pick").alias("weight"),
                *BLOCKS, F.col("g.task").alias("task"),
            )
        )
    # Only what a view needs travels.
    empty = F.lit(b"")
    text_only = {b: F.when(F.col("task") % 2 == 0, F.col(b)).otherwise(empty) for b in ("grams", "shares")}
    schema = "task INT, coefficients BINARY, base DOUBLE, steps INT"
    made = data.withColumns(text_only).groupBy("task").applyInArrow(fit_group, schema).collect()
    found = {r["task"]: (np.frombuffer(r["coefficients"]), r["base"]) for r in made}
    return [Weights(*found[chosen(run, "text")], *found[chosen(run, "meta")]) for run in runs]


def chosen(run: int, view: str) -> int:
    """Place of a run's view in a row's list of odds or picks."""
    return 2 * run + VIEWS.index(view)


def odds_of_all(table: DataFrame, runs: list[Weights]) -> DataFrame:
    """(at, doc_id, odds) of every row, from its stored features; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = Features.read(batch)
            columns = [column for weights in runs for column in made.odds(weights)]
            flat = pa.array(np.stack(columns, axis=1).ravel())
            lists = pa.FixedSizeListArray.from_arrays(flat, len(columns)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["at"], batch["doc_id"], lists], names=["at", "doc_id", "odds"])

    kind = table.schema["doc_id"].dataType.simpleString()
    return stage(table.mapInArrow(run, f"at BIGINT, doc_id {kind}, odds ARRAY<DOUBLE>"), "train-odds")


def sure_labels(examples: Examples, runs: list[Weights]) -> DataFrame:
    """Rows without a label of which some view is sure, with the weight it gives them per run and view.

    A positive weight labels the row good, a negative one bad.
    """
    scored = odds_of_all(examples.table, runs)
    free = scored.join(examples.known.select("at"), "at", "left_anti")
    places = range(2 * len(runs))
    tests = [(i, sign, F.col("odds")[i] * sign >= SURE) for i in places for sign in (1, -1)]
    counts = free.agg(*(F.count_if(test) for *_, test in tests)).first()
    chance = (F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 30)) + 0.5) / (1 << 30)
    picks = []
    for i in places:
        pick = F.lit(0.0)
        for (place, sign, test), count in zip(tests, counts, strict=True):
            if place == i and count:
                rate = min(PSEUDO / count, 1.0)
                pick = F.when(test & (chance < rate), sign / rate).otherwise(pick)
        picks.append(pick)
    picked = free.select("at", F.array(*picks).alias("picks")).where(F.exists("picks", lambda p: p != 0))
    # About 4 * (FOLDS + 1) * PSEUDO rows at most.
    return picked_rows(examples.table, stage(picked, "train-picks"), "train-extra")


@dataclass(frozen=True)
class Classifier:
    weights: Weights
    slopes: tuple[float, float]
    shifts: tuple[float, float]
    prior: float
    reject: float = 0.0

    def combined(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated scores of both views and of both together, from raw log odds."""
        parts = [odds * slope + shift for odds, slope, shift in zip((text, meta), self.slopes, self.shifts, strict=True)]
        total = self.prior + sum(p - self.prior for p in parts)
        return tuple(1 / (1 + np.exp(-np.clip(x, -500, 500))) for x in (*parts, total))

    def scores(self, made: Features) -> list[pa.Array]:
        values = self.combined(*made.odds(self.weights))
        return [*map(pa.array, values), pa.array(values[2] >= self.reject)]

    def of_table(self, table: DataFrame) -> DataFrame:
        """(doc_id, scores, kept) of stored features."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch["doc_id"], *self.scores(Features.read(batch))], names=["doc_id", *SCORES])

        kind = table.schema["doc_id"].dataType.simpleString()
        return table.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} {k}" for n, k in SCORES.items()))

    def verdict(self) -> Column:
        """Is a document kept?  Over the columns that the features need."""

        def run(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
            made = [self.scores(m)[3] for _, m in features(text, lang, source, n_chars)]
            return pa.concat_arrays(made) if made else pa.array([], pa.bool_())

        kept_ = F.arrow_udf(run, T.BooleanType()).asNondeterministic()  # so that a plan never runs it twice
        return kept_("text", F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("bigint"))


SCORES = {"text_score": "DOUBLE", "meta_score": "DOUBLE", "score": "DOUBLE", "kept": "BOOLEAN"}


def threshold(good: np.ndarray) -> float:
    """The score that about ``LOST`` of good documents stay below, with a margin for their number."""
    n = len(good)
    rank = max(n * LOST - np.sqrt(n * LOST * (1 - LOST)), n * LOST / (n * LOST + 1) * LOST)
    known = np.append(0.0, np.sort(good))
    return float(np.interp(rank, np.arange(n + 1), known))


def train(examples: Examples, rounds: int = ROUNDS) -> Classifier | None:
    """Co-train, calibrate and choose the threshold; None without enough labels of both classes."""
    if not examples.enough:
        return None
    extra = None
    runs = fit_all(examples, extra)
    for _ in range(rounds):
        extra = sure_labels(examples, runs)
        runs = fit_all(examples, extra)
    # Every labelled document of the sample by the run that left it out.
    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, fold = Features.read(batch), batch["fold"].to_numpy()
            odds = np.zeros((2, len(made)))
            for run in range(FOLDS):
                rows = fold == run
                odds[:, rows] = np.stack(made.odds(runs[run + 1]))[:, rows]
            columns = [batch["label"], batch["weight"], pa.array(odds[0]), pa.array(odds[1])]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "weight", *VIEWS])

    # At most 2 * LABELLED rows of four numbers.
    schema = "label DOUBLE, weight DOUBLE, text DOUBLE, meta DOUBLE"
    held = examples.sample.mapInArrow(crossed, schema).toArrow()
    label, weight, *odds = (held[c].to_numpy() for c in held.column_names)
    none = Rows(np.zeros(0, np.int64), np.zeros(0), np.zeros(len(label), np.int64), 0)
    fits = [regression(o[:, None], none, label, weight) for o in odds]
    share = examples.counts[1.0] / (examples.counts[0.0] + examples.counts[1.0])
    made = Classifier(
        runs[0], tuple(max(float(w[0]), 0.0) for w, *_ in fits), tuple(base for _, base, _ in fits),
        float(np.log(share / (1 - share))),
    )
    scores = made.combined(*odds)[2][label > 0]
    return Classifier(made.weights, made.slopes, made.shifts, made.prior, threshold(scores))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) per row of ``docs``."""
    examples = training_rows(docs.select(*NEEDED), labels)
    model = train(examples)
    if model is None:
        return docs.select("doc_id", *(F.lit(1.0).alias(c) for c in list(SCORES)[:3]), F.lit(True).alias("kept"))
    return model.of_table(examples.table)


def kept(docs: DataFrame, labels: DataFrame, examples: DataFrame | None = None) -> DataFrame:
    """The documents that are not rejected, with their own columns.

    The views are trained on ``examples``, or on ``docs`` themselves.
    """
    model = train(training_rows((docs if examples is None else examples).select(*NEEDED), labels))
    if model is None:
        return docs
    small_batches(docs.sparkSession)
    return docs.where(model.verdict())
