"""Sparse rows of the classifier's sample: exact sums in blocks, in bounded memory."""

import tracemalloc

import numpy as np
import pytest

from tallyline.llm import cotraining as C


def sample(n, most, seed=7):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, most, n)
    total = int(counts.sum())
    places = rng.integers(0, C.HASHED, total).astype(C.PLACE)
    return C.Rows(places, rng.random(total).astype(np.float32), counts, C.HASHED)


@pytest.mark.parametrize("block", [1, 100, 1 << 18])
def test_blocks_do_not_change_sums(monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block, raising=False)
    rng = np.random.default_rng(3)
    rows = sample(300, 90)
    weights, by_row = rng.random(C.HASHED), rng.random(300)
    owner = np.repeat(np.arange(300), rows.counts)
    places, values = rows.places.astype(np.int64), rows.values.astype(float)
    assert np.array_equal(rows.gathered(by_row), np.bincount(places, by_row[owner] * values, C.HASHED))
    assert np.array_equal(rows.summed(weights), np.bincount(owner, values * weights[places], 300))
    assert np.allclose(rows.times(weights), np.bincount(owner, values * weights[places], 300))
    none = C.Rows(places[:0], values[:0], np.zeros(4, np.int64), 5)
    assert not none.times(np.ones(5)).any() and not none.gathered(np.ones(4)).any()


def test_a_fit_holds_few_bytes_per_entry():
    """Sums over the sample used to hold several doubles per entry."""
    rows = sample(4_000, 1_000)
    entries, by_row = len(rows.places), np.ones(4_000)
    weights = np.ones(C.HASHED)
    tracemalloc.start()
    try:
        rows.times(weights)
        rows.gathered(by_row)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 8 * entries
