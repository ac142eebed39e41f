"""Sharding, mixing and packing: laws, brute force and edge cases."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyline.llm import mixing, packing, sharding

SF_DIR = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id BIGINT, text STRING, source STRING, size STRING, shard STRING, place STRING"
TEXTS = [None, "", "a", "same text here", "same text here", "b c " * 5000, "x <|endoftext|> y", "Don't e\u0301"]


@pytest.fixture(scope="module")
def edges(spark):
    """Nulls in every column, repeated rows and ids, a hot text, and clashing columns."""
    rows = [(i, t, ["s1", None, "s2"][i % 3], "c", "c", "c") for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", "s1", None, None, None), (3, "same text here", "s1", "c", "c", "c")]
    rows += [(100 + i, "hot text", "s1", "c", "c", "c") for i in range(40)]
    return spark.createDataFrame(rows, SCHEMA)


def check_shards(rows, docs, shards):
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(docs)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_keep_groups_together(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    own = docs.collect()
    rows = sharding.shard(docs).collect()
    check_shards(rows, own, 16)
    text = {r.doc_id: r.text for r in own}
    groups = defaultdict(set)
    for r in rows:
        groups[text[r.doc_id]].add(r.shard)
        assert r.size == len(text[r.doc_id].encode()) + 1
        assert r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
    shared = Counter(text.values())
    cut = [t for t, s in groups.items() if len(s) > 1 and shared[t] <= len(own) // 32]
    assert len(cut) <= 2


def test_shards_on_edges(edges):
    docs = edges.collect()
    rows = sharding.shard(edges, shards=4).collect()
    check_shards(rows, docs, 4)
    by = {r.doc_id: r for r in rows}
    assert (by[0].size, by[0].text_crc32) == (1, 0) == (by[1].size, by[1].text_crc32)
    hot = {r.shard for r in rows if r.doc_id is not None and r.doc_id >= 100}
    assert len(hot) <= 4  # 40 of 50 rows cannot fit in fewer than three shards
    assert sharding.shard(edges.limit(0)).count() == 0


def test_mix_on_edges(edges):
    docs = edges.collect()
    rows = mixing.mix(edges).collect()
    assert len(rows) == len(docs)
    assert all(r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in rows)
    again = mixing.mix(edges).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    total = sum(r.size for r in rows)
    # s1 has few words and stops at twice its size; the rest goes to the others.
    aims = {(r.source_size, r.target) for r in rows}
    assert abs(sum(t for _, t in aims) - 1.5 * total) < 1e-3
    assert all(t <= 2 * s + 1e-6 for s, t in aims)
    mixed = mixing.resample(edges)
    assert mixed.columns == edges.columns
    assert mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix(edges.limit(0)).count() == mixing.resample(edges.limit(0)).count() == 0


def test_targets_share_the_excess(spark):
    sized = spark.createDataFrame(
        [("a", 10), ("b", 1000), ("c", 30), (None, 60)], "source STRING, size BIGINT"
    )
    got = {r.source: r.target for r in mixing.targets(sized).collect()}
    total, weights, size = 1650.0, {"a": 3, "b": 1, "c": 2, None: 3}, {"a": 10, "b": 1000, "c": 30, None: 60}
    want, open_ = {}, set(size)
    while True:
        left = total - sum(want.values())
        share = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * size[s]}
        if not over:
            want |= share
            break
        want |= {s: 2.0 * size[s] for s in over}
        open_ -= over
    assert got == pytest.approx(want)


def test_pack_on_edges(edges):
    docs = edges.collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for d in docs:
        ids = np.array([*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0], "<u4")
        for n, at in enumerate(range(0, len(ids), 2048)):
            own = ids[at : at + 2048]
            want[d.doc_id, n, at, len(own), zlib.crc32(own.tobytes())] += 1
    cut = packing.pieces(edges, TOKENIZER, with_ids=True)
    rows = packing.pack(cut).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        places.sort()
        ends = [o + n for o, n in places]
        assert [o for o, _ in places] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(bins) == -(-sum(r.length for r in rows) // 2048)
    whole = packing.sequences(packing.pack(cut)).collect()
    assert sum(len(s.ids) for s in whole) == sum(r.length for r in rows)
    assert packing.pack(packing.pieces(edges.limit(0), TOKENIZER)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.choice([16, 100, 2048]))
    lengths = {int(n): int(rng.integers(1, 50)) for n in rng.integers(1, size + 1, 40)}
    made = packing.plan(lengths, size)
    used = Counter()
    for pattern, times in zip(made.patterns, made.times, strict=True):
        assert sum(pattern) <= size and times > 0
        for n in pattern:
            used[n] += times
    assert used == lengths
    total = sum(n * c for n, c in lengths.items())
    big = sum(c for n, c in lengths.items() if 2 * n > size)
    assert made.sequences <= max(1.12 * total / size, big) + 2


def test_plan_finds_exact_complements():
    assert packing.plan({60: 5, 40: 5, 70: 2, 20: 2, 10: 2}, 100).sequences == 7
    assert packing.plan({}, 100).sequences == 0


def test_exact_fills_take_fewer_sequences_than_best_fit_alone():
    """Lengths on which best fit alone wastes sequences; without exact fills this fails."""
    for lengths, most in (
        ({27: 28, 40: 28, 33: 33}, 30),
        ({38: 44, 32: 44, 58: 51, 42: 51, 30: 60, 28: 50}, 117),
        ({28: 29, 35: 18, 43: 56, 27: 55, 32: 42, 29: 60, 46: 55}, 115),
    ):
        made = packing.plan(lengths, 100)
        alone = sum(t for _, t in packing.best_fit(sorted(lengths.items(), reverse=True), 100))
        assert made.sequences <= most < alone
        used = Counter()
        for pattern, times in zip(made.patterns, made.times, strict=True):
            assert sum(pattern) <= 100
            used += Counter({k: n * times for k, n in Counter(pattern).items()})
        assert used == Counter(lengths)


def test_exact_fills_fill_whole_sequences():
    made, left = packing.exact_fills({100: 2, 60: 5, 40: 7, 50: 4, 30: 3, 25: 2}, 100)
    assert all(sum(pattern) == 100 for pattern, _ in made)
    used = Counter(dict(left))
    for pattern, times in made:
        used += Counter({k: n * times for k, n in Counter(pattern).items()})
    assert used == Counter({100: 2, 60: 5, 40: 7, 50: 4, 30: 3, 25: 2})
    assert sum(times for _, times in made) >= 10


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_documents_take_no_more_sequences_than_their_tokens_need(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    lengths = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    bound = -(-sum(k * n for k, n in lengths.items()) // packing.SEQUENCE)
    assert packing.plan(lengths).sequences <= bound + 1
