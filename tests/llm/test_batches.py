"""Whole texts travel in batches that are bounded by bytes, and so is what the tokenizer returns at a time."""

import pyarrow as pa
from pyspark.sql import functions as F

import public_tokenizers
from tallyline.llm import packing, tables

MB = 1 << 20


def test_batches_of_long_texts_are_bounded(spark):
    tables.small_batches(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]})

    rows = spark.range(0, 100, 1, 1).select(F.repeat(F.lit("x"), 200_000).alias("text"))
    made = rows.mapInArrow(sizes, "n BIGINT, bytes BIGINT").collect()
    assert sum(r["n"] for r in made) == 100
    assert max(r["bytes"] for r in made) <= 5 * MB


def test_batches_of_short_texts_and_scans_are_bounded(spark):
    tables.small_batches(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    made = spark.range(0, 3000, 1, 1).mapInArrow(sizes, "n BIGINT").collect()
    assert sum(r["n"] for r in made) == 3000
    assert max(r["n"] for r in made) <= 500
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 1024


def test_words_go_to_the_tokenizer_in_parts(monkeypatch):
    """Words that need the whole tokenizer, more of them than go at a time."""
    encode = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer, seen = encode.tokenizer, []

    class Counting:
        def encode_batch(self, words, **options):
            seen.append(len(words))
            return tokenizer.encode_batch(words, **options)

    letters = str.maketrans("0123456789", "abcdefghij")
    text = " ".join("it's" + str(i).translate(letters) for i in range(12_000))
    encode.tokenizer = Counting()
    ids = encode(pa.array([text]))[0]
    assert sum(seen) >= 12_000 and max(seen) <= 10_000
    assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
