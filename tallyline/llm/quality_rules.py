"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and keeps the measurements
and one failure bit per rule.  Policies are versioned bit masks applied to the
ledger afterwards, so a new policy costs no pass over the texts, and
``ablations`` answers what each rule contributes from a histogram of failure
bits (at most 2^rules rows, pre-aggregated before the exchange).

Defined results: a null or empty text has no words, so it fails ``few_words``;
repeated rows are judged one by one; other columns are carried unchanged.
``ledger`` replaces an input column of the name it is given; ``kept`` returns
the input's columns as they are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm import words as W
from tallyline.llm.tables import fresh, small_batches

SYMBOLS = np.isin(W.BYTES, np.frombuffer(b"#*$%&|<>", np.uint8))
NEWLINE = W.BYTES == 0x0A
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
)


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str


# A rule's place in this tuple is its bit; add rules at the end only.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_passages", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 30 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << i for i, rule in enumerate(RULES) if rule.name in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_passages"))
STRICT = Policy("strict-1", tuple(rule.name for rule in RULES))


def measure(column: pa.Array) -> pa.StructArray:
    """The measurements of every text of a column."""
    source = W.texts(column)
    words = W.split(source, W.WHITE)
    starts, windows = W.five_word_windows(words)
    seen = W.paired(words.rows[starts], windows)
    again = starts[np.bincount(seen)[seen] > 1] if len(seen) else starts
    size = len(words.ids)
    change = np.bincount(again, minlength=size + 5)[: size + 5]
    change = change - np.bincount(again + 5, minlength=size + 5)[: size + 5]
    repeated = np.cumsum(change)[:size] > 0

    lines = W.split(source, NEWLINE)
    blank = W.split(blanked(lines), W.WHITE).counts == 0
    kept = ~blank[lines.ids]
    rows = lines.rows[kept]
    coded = W.paired(rows, lines.ids[kept])
    first = np.unique(coded, return_index=True)[1]
    total = np.bincount(rows, minlength=len(source))
    values = (
        words.counts,
        source.count(~W.WHITE[source.data] & ~W.CONTINUES[source.data]),
        source.count(SYMBOLS[source.data]),
        total,
        total - np.bincount(rows[first], minlength=len(source)),
        W.between(repeated, words.bounds),
    )
    return pa.StructArray.from_arrays(
        [pa.array(v.astype(np.int64)) for v in values], names=list(MEASURES)
    )


def blanked(lines: W.Words) -> W.Texts:
    """The distinct lines of a batch as texts of their own."""
    _, offsets, data = lines.names.buffers()
    bounds = np.frombuffer(offsets, np.int64)[: len(lines.names) + 1]
    flat = np.frombuffer(data if data is not None else b"", np.uint8)
    return W.Texts(flat[bounds[0] : bounds[-1]], bounds - bounds[0])


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def measurements(text: pa.Array) -> pa.Array:
    made = [measure(text[part]) for part in W.parts(text)]
    if not made:
        return measure(text)
    return pa.concat_arrays(made)


measurements = measurements.asNondeterministic()  # so that a plan never runs it twice


def fail_bits(measures: str = "ledger") -> Column:
    """The failure bits of all rules over a struct of measurements."""
    bits = F.lit(0).cast("bigint")
    for i, rule in enumerate(RULES):
        test = re.sub("|".join(MEASURES), lambda m: f"{measures}.{m[0]}", rule.fails)
        bits = bits + F.when(F.expr(test), F.lit(1 << i)).otherwise(F.lit(0))
    return bits


def ledger(docs: DataFrame, text: str = "text", into: str = "ledger") -> DataFrame:
    """``docs`` with a struct column: all measurements and ``fail_bits``."""
    small_batches(docs.sparkSession)
    measured = docs.withColumn(into, measurements(F.col(text)))
    return measured.withColumn(into, F.col(into).withField("fail_bits", fail_bits(into)))


def passes(policy: Policy, bits: str = "ledger.fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) == 0


def kept(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The documents that a policy keeps, with their own columns."""
    into = fresh(docs, "ledger")
    return ledger(docs, into=into).where(passes(policy, f"{into}.fail_bits")).drop(into)


def ablations(ledgers: DataFrame, policies: tuple[Policy, ...] = (BASE, STRICT)) -> DataFrame:
    """Per policy and rule: documents rejected, by this rule, by it alone, and without it."""
    histogram = ledgers.groupBy(F.col("ledger.fail_bits").alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    pairs = [
        F.struct(
            F.lit(p.version).alias("policy"),
            F.lit(r.name).alias("rule"),
            F.lit(p.mask).cast("bigint").alias("mask"),
            F.lit(1 << RULES.index(r)).cast("bigint").alias("bit"),
        )
        for p in policies
        for r in RULES
        if r.name in p.rules
    ]
    counted = histogram.select("bits", "n", F.explode(F.array(*pairs)).alias("t")).select(
        "bits", "n", "t.*"
    )
    total = lambda test: F.sum(F.when(F.expr(test), F.col("n")).otherwise(0))
    return counted.groupBy("policy", "rule").agg(
        total("bits & mask != 0").alias("rejected"),
        total("bits & bit != 0").alias("by_rule"),
        total("bits & mask = bit").alias("by_rule_alone"),
        total("bits & (mask & ~bit) != 0").alias("rejected_without"),
    )
