"""Whitening: exact sums against Python integers, whitened rows against numpy, edge rows."""

from math import floor

import numpy as np
import pytest

from tallyhouse.llm import whitening as W
from tallyhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def fitted(vectors):
    """Distinct integer vectors, n, sums and covariance, all from Python integers."""
    x = [tuple(floor(64 * c) + 1_000_000 for c in v) for v in vectors]
    distinct = sorted(set(x))
    n, dims = len(distinct), len(distinct[0])
    sums = [sum(v[i] for v in distinct) for i in range(dims)]
    cov = np.array([[(n * sum(v[i] * v[j] for v in distinct) - sums[i] * sums[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    return x, n, sums, cov


@pytest.mark.parametrize("most", [1, 200, 70_000, 2**40])
def test_scatter_is_exact(most):
    pick = np.random.default_rng(5)
    x = pick.integers(-most, most + 1, (300, 5))
    low = x.min(axis=0).tolist()
    sums, cross = W.scatter(x, low)
    rows = [[int(v) - m for v, m in zip(row, low)] for row in x]
    assert sums == [sum(r[i] for r in rows) for i in range(5)]
    assert all(cross[i, j] == sum(r[i] * r[j] for r in rows) for i in range(5) for j in range(i, 5))


def test_keys_tell_vectors_apart_and_come_back():
    rows = np.array([[0, -1, 5], [127, -128, 0], [128, 0, 0], [0, 0, -40_000], [2**40, 1, -2**61]])
    keys = W.encode(rows)
    assert len(set(keys)) == 5 and (W.decode(keys, 3) == rows).all()
    wide = np.array([[10**30, -1, 0], [1, 2, 3]], dtype=object)
    assert (W.decode(W.encode(wide), 3) == wide).all() and W.encode(wide)[1] == W.encode(np.array([[1, 2, 3]]))[0]


def test_deviations_are_exact():
    model = W.Model(10**9, [123, -77, 10**12], np.ones(3), np.eye(3), 3.0, 0.0)
    x = np.array([[5, -10**9, 4], [10**6, 2, 3]])
    want = [sum((10**9 * int(v) - s) ** 2 for v, s in zip(row, model.sums)) for row in x]
    assert model.whiten(x)[1] == want


def test_query_on_the_table(spark):
    table = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r["embedding"] is not None]
    table = [(i, v) for i, v in table if all(c is not None and np.isfinite(c) for c in v)]
    x, n, sums, cov = fitted([v for _, v in table])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    got = QUERIES["op11_whitening"](spark, SF).collect()
    assert len(got) == 16 * len(table)
    by = {(r["vec_id"], r["component"]): r for r in got}
    signs = {}
    for (i, _), v in zip(table, x):
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        want = (np.array([(n * a - s) / n for a, s in zip(v, sums)]) @ u) / np.sqrt(e)
        for k in range(16):
            r = by[i, k + 1]
            assert (r["n"], r["deviation"]) == (n, deviation)
            if abs(want[k]) > 1e-6:
                assert signs.setdefault(k, np.sign(want[k] * r["whitened"])) == np.sign(want[k] * r["whitened"])
            assert abs(r["whitened"]) == pytest.approx(abs(want[k]), rel=1e-6, abs=1e-9)
            assert r["explained"] == pytest.approx(e[k] / np.trace(cov), rel=1e-9) and r["identity_error"] <= 1e-4


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [0.001, 1.002]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, []),
            (8, [1.0]), (9, [2.0]), (None, [-3.0, 1.0]), (10, [5.0, 7.5]), (11, [1e30, 1.0, 2.0]), (12, [0.0, 1.0, 2.0]),
            (13, [1e300, -1e300, 0.0, 0.0]), (14, [0.0, 1.0, 2.0, 0.0])]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, doc string, n int")
    got = W.whiten(table, W.fit(table)).collect()
    ids = [r["doc"]["vec_id"] for r in got]
    assert sorted(map(str, ids)) == sorted(["1"] * 4 + ["2"] * 2 + ["None"] * 2 + ["10"] * 2 + ["8", "9"] + ["11"] * 3 + ["12"] * 3 + ["13"] * 4 + ["14"] * 4)
    two = [v for i, v in rows if v is not None and len(v) == 2 and None not in v and np.isfinite(v).all()]
    x, n, sums, _ = fitted(two)
    assert n == 3  # 0.001 falls into the cell of 0.0
    for r in got:
        v = r["doc"]["embedding"]
        if len(v) == 2:
            assert r["n"] == 3 and r["deviation"] == sum((n * (floor(64 * c) + 1_000_000) - s) ** 2 for c, s in zip(v, sums))
        if len(v) >= 3:
            assert r["deviation"] is None and int(r["deviation_text"]) > 2**63 and (r["whitened"] is None) == (r["component"] > 1)
    one = [r for r in got if len(r["doc"]["embedding"]) == 1]
    assert sorted(round(abs(r["whitened"]), 9) for r in one) == [1.0, 1.0] and one[0]["explained"] == 1.0


def test_constant_and_empty_tables(spark):
    table = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id long, embedding array<float>")
    got = W.whiten(table, W.fit(table)).collect()
    assert len(got) == 8 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 and r["n"] == 1 for r in got)
    assert W.whiten(table.limit(0), W.fit(table.limit(0))).count() == 0


def test_many_rows_over_rounds(spark, monkeypatch):
    monkeypatch.setattr(W, "ROUND_ROWS", 64)
    pick = np.random.default_rng(6)
    vectors = (pick.normal(size=(700, 6)) * [1, 2, 3, 4, 5, 0.1]).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    _, n, sums, cov = fitted(vectors.astype(float))
    model = W.fit(table)[6]
    assert model.n == n and [s + n * 1_000_000 for s in model.sums] == sums
    assert np.allclose(model.values, np.linalg.eigvalsh(cov)[::-1], rtol=1e-12)
