"""Token counts of prefixes against the tokenizer run on every prefix."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyline.llm import token_counts
from tallyline.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = [
    "a", "B", "é", "日本", "'ll", "'re", "'s", "'", "  ", " ", "\n", "\n\n", "\t", " ", "　", "\x1c", "\x85", "×", "÷",
    "<|endoftext|>", "<|end", "|>", "123", "4", "!?", "...", "—", "Hello", "ing", "the", " the", "🎉", "é", "​", "Ωμ", "дом",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    made = ["".join(rng.choices(BITS, k=rng.randint(0, 25))) for _ in range(400)]
    return [*made, None, "", "a" * 300 + " " * 300 + "b", "x" * 70, *made[:5]]


def of_prefixes(tokenizer, text):
    parts = [text[:i] for i in range(1, len(text or "") + 1)]
    return [len(e.ids) for e in tokenizer.encode_batch(parts, add_special_tokens=False)]


def test_counts_of_all_prefixes(tokenizer, texts):
    counter = token_counts.PrefixCounter(PATH)
    size, total, steps = counter(pa.array(texts))
    for text, n, tokens, step in zip(texts, size, total, steps, strict=True):
        want = of_prefixes(tokenizer, text)
        assert token_counts.counts(step).tolist() == want, text
        assert (n, tokens) == (len((text or "").encode()), want[-1] if want else 0)


def test_memory_is_bounded(texts, monkeypatch):
    whole = token_counts.PrefixCounter(PATH)(pa.array(texts))
    monkeypatch.setattr(token_counts, "KNOWN", 50)
    counter = token_counts.PrefixCounter(PATH)
    for text, want in zip(texts, whole[1], strict=True):
        assert counter(pa.array([text], pa.string()))[1].tolist() == [want]
        assert len(counter.single) <= 2_000 and len(counter.pairs) <= 2_000


def test_budgets_from_the_stored_steps(spark, tokenizer, texts):
    rows = spark.createDataFrame([(i, t, "c", "c") for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, steps STRING, n_tokens STRING")
    stored = token_counts.prefixes(rows, PATH)
    assert stored.columns == ["doc_id", "n_bytes", "n_tokens", "steps"]
    asked = stored.select(
        "doc_id", token_counts.within("steps", 9).alias("fits"), token_counts.at("steps", 6).alias("at"),
        token_counts.at("steps", F.lit(10**6)).alias("all"), token_counts.at("steps", 0).alias("none"), "n_tokens",
        token_counts.within("steps", F.lit(None)).alias("no_budget"),
    )
    found = {r.doc_id: r for r in asked.collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        want = of_prefixes(tokenizer, text)
        row = found[i]
        assert row.fits == max((k for k, c in enumerate(want, 1) if c <= 9), default=0)
        assert row["at"] == (want[min(6, len(want)) - 1] if want else 0)
        assert row["all"] == row.n_tokens and row["none"] == row.no_budget == 0


def test_query_counts_as_the_tokenizer_does(spark, tokenizer):
    rows = QUERIES["op11_token_counts"](spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in docs.items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        i: (len(docs[i].encode()), n, n > 1024) for i, n in want.items()
    }
    assert all((r.fitting_chars < len(docs[r.doc_id])) == r.over_limit for r in rows)
    none = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    assert token_counts.token_counts(none, PATH).count() == 0
