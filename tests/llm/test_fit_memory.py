"""The driver's memory in a fit of sparse features."""

import tracemalloc

import numpy as np

from tallyhouse.llm import features as ft


def _rows(n, most):
    r = np.random.default_rng(1)
    index = [np.unique(r.integers(0, ft.WIDTH, r.integers(0, most))).astype(np.int32) for _ in range(n)]
    return ft.Rows(list(range(n)), index, [r.random(len(i)).astype(np.float32) for i in index], np.zeros((n, 1))), r


def test_fit_takes_features_in_blocks(monkeypatch):
    rows, r = _rows(2000, 4000)
    y = (r.random(2000) < 0.5).astype(float)
    tracemalloc.start()
    w, b = ft.fit_sparse(rows, np.arange(2000), y, ft.balanced(y), rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 12 bytes a feature are kept, index, value and owner; products of all at once took over 30
    assert peak < 14 * sum(map(len, rows.index)) + (25 << 20)
    monkeypatch.setattr(ft, "BLOCK_FEATURES", 10)
    again = ft.fit_sparse(rows, np.arange(2000), y, ft.balanced(y), rounds=2)
    assert np.array_equal(w, again[0]) and b == again[1]


def test_rows_without_features():
    rows = ft.Rows([0, 1, 2], [np.zeros(0, np.int32), np.array([5], np.int32), np.zeros(0, np.int32)],
                   [np.zeros(0, np.float32), np.ones(1, np.float32), np.zeros(0, np.float32)], np.zeros((3, 1)))
    y = np.array([0.0, 1.0, 0.0])
    w, b = ft.fit_sparse(rows, np.arange(3), y, ft.balanced(y))
    assert w[5] > 0 and b < w[5] + b and not w[:5].any()
