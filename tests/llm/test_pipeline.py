"""The corpus pipeline stage by stage on a small corpus with planted cases."""

import random
import zlib
from array import array
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallyline.llm import quality_rules

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """sf0.001 with copies, near copies, junk, nulls and an extra column."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rng = random.Random(4)
    words = [f"word{i}" for i in range(300)]
    base = rng.choices(words, k=200)
    near = [*base[:150], "changed", *base[151:]]
    planted = [
        (5001, " ".join(base)), (5002, " ".join(base)), (5003, " ".join(near)),
        (5004, "too short"), (5005, "again and again and on " * 30), (5006, None), (5007, ""),
        (5008, "%%% $$$ ### word " * 30), (None, " ".join(rng.choices(words, k=80))),
    ]
    more = spark.createDataFrame(
        [(i, t, "en", None if i == 5001 else "src0", len(t or "")) for i, t in planted], docs.schema
    )
    docs.union(more).selectExpr("*", "'extra' AS size").write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def shingles(text):
    words = text.lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def test_stages(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, corpus).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == before.columns

    raw = spark.read.parquet(f"{corpus}/documents.parquet")
    verdicts = quality_rules.ledger(raw).where(quality_rules.passes(quality_rules.BASE))
    ruled = kept["quality_rules"]
    assert Counter(r.doc_id for r in ruled) == Counter(r.doc_id for r in verdicts.collect())
    ids = {r.doc_id for r in ruled}
    assert {5001, 5002, 5003, None} <= ids and not ids & {5004, 5005, 5006, 5007}

    classed = kept["quality_classifier"]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{corpus}/labels.parquet").collect()}
    good = [r.doc_id for r in ruled if quality.get(r.doc_id) == 1]
    assert len({r.doc_id for r in classed} & set(good)) >= 0.98 * len(good)

    unique = kept["near_duplicates"]
    assert len({r.doc_id for r in unique} & {5001, 5002, 5003}) == 1
    sets = [(r.doc_id, shingles(r.text)) for r in unique]
    all_sets = {r.doc_id: shingles(r.text) for r in classed}
    for n, (_, x) in enumerate(sets):
        assert not any(100 * len(x & y) >= 75 * len(x | y) for _, y in sets[:n])
    left = {i for i, _ in sets}
    for gone, x in all_sets.items():  # every document that went was like another one
        others = (y for other, y in all_sets.items() if other != gone)
        assert gone in left or any(100 * len(x & y) >= 75 * len(x | y) for y in others)

    mixed = kept["source_mix"]
    times = Counter(r.doc_id for r in mixed)
    assert max(times.values()) <= 2 and set(times) <= left
    size = {r.doc_id: len(r.text.split()) for r in unique}
    taken = sum(size[r.doc_id] for r in mixed)
    assert abs(taken - 1.5 * sum(size.values())) < 0.1 * sum(size.values())

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    packed = kept["packing"]
    assert sum(r.length for r in packed) == tokens
    assert all(len(r.ids) == r.length and zlib.crc32(array("I", r.ids).tobytes()) == r.ids_crc32 for r in packed)
    assert len({r.sequence_id for r in packed}) <= -(-tokens // 2048) * 1.1 + 1


def test_run_over_nothing(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
