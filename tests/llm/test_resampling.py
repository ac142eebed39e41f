"""Importance resampling against plain Python, and its cutoff on ties and repeated rows."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tallyline.llm import resampling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, most):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    made = [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(m.encode()) for m in made]


def expected(docs, target, percent, least, most, size):
    count = [0] * size, [0] * size
    for side, texts in enumerate(([t for _, t in docs], target)):
        for text in texts:
            for crc in runs(text, most)[1]:
                count[side][crc % size] += 1
    s_all, t_all = map(sum, count)
    gain = [
        math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size))))
        for s, t in zip(*count, strict=True)
    ]
    rows = []
    for doc_id, text in docs:
        n, crcs = runs(text, most)
        weight = sum(gain[c % size] for c in crcs) // len(crcs) if crcs else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((n, (doc_id, len(crcs), weight, score)))
    able = sorted((r for n, r in rows if n >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranks = able[: percent * len(able) // 100]
    made = [(*r, i) for i, r in enumerate(ranks, 1)]
    rest = [r for _, r in rows]
    for r in ranks:
        rest.remove(r)
    return sorted(made + [(*r, None) for r in rest], key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = ["Alpha", "beta", "GAMMA", "été", "x1", "日本", "Ünder", "the", "of", "b,c"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(120)]
    docs += [(7, docs[7][1])] * 40 + [(8, "word " * 30), (8, "word " * 31), (None, "Beta " * 40), (None, None), (200, "")]
    docs.append((201, " ".join(rng.choices(words, k=30_000))))
    return docs, [" ".join(rng.choices(words[:4], k=50)) for _ in range(5)] + [None, ""]


@pytest.mark.parametrize("most,size,percent,least", [(1, 10_000, 10, 20), (3, 50, 70, 1), (2, 7, 100, 0)])
def test_resample_matches_plain_python(spark, corpus, most, size, percent, least):
    docs, target = corpus
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in docs], "doc_id BIGINT, text STRING, score STRING, at INT")
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "doc_id BIGINT, text STRING")
    rows = resampling.resample(df, aim, percent, least, most, size).collect()
    assert sorted(map(tuple, rows), key=repr) == expected(docs, target, percent, least, most, size)


def test_cutoff_takes_exactly_as_many_rows_as_asked(spark):
    """Rows equal in score, in id and in everything are separated by their own number."""
    rows = spark.createDataFrame(
        [(s, i, n, k) for k, (s, i, n) in enumerate([(5, 1, 1)] * 4 + [(5, None, 1), (5, 2, 3), (5, 2, 1)] + [(-9, 0, 0)] * 3 + [(2**40, 9, 9)])],
        "score BIGINT, doc_id BIGINT, n_features BIGINT, at BIGINT",
    )
    for wanted in range(12):
        assert rows.where(resampling.cutoff(rows, wanted)).count() == wanted
    best = rows.where(resampling.cutoff(rows, 6)).collect()
    assert sorted((r.score, r.doc_id, r.n_features) for r in best) == [(5, 1, 1)] * 4 + [(5, 2, 1), (2**40, 9, 9)]
    places = {r["at"]: r["rank"] for r in resampling.ranked(rows).select("at", "rank").collect()}
    assert sorted(places.values()) == list(range(1, 12)) and places[10] == 1 and places[6] == 6 and places[4] == 8


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    some = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    assert resampling.resample(none, some).count() == 0
    rows = resampling.resample(some, none, percent=50, least_words=1).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1] and len(rows) == 3
