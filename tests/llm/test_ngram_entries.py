"""Index entries of the Jaccard join as they are shuffled."""

import numpy as np

from tallyhouse.llm import ngram_join


def test_entries_come_back():
    e = np.zeros(5, ngram_join._ENTRY)
    e["sig"] = [0, 1 << 16, 2**64 - 1, 12345 << 20, 7 << 60]
    e["id"] = [-1, 0, 2**62, -(2**63), 5]
    e["n"] = [1, 255, 256, 2**31 - 1, 70000]
    got = ngram_join.unpacked(ngram_join.packed(e))
    assert (got["id"] == e["id"]).all() and (got["n"] == e["n"]).all() and (got["sig"] == e["sig"] >> np.uint64(16)).all()
    assert len(ngram_join.unpacked(ngram_join.packed(e[:0]))) == 0


def test_counters_come_back_and_rank():
    c = np.array([0, 1, 255, 256, 70_000, 2**32 - 1], np.uint32)
    assert (ngram_join.counters_of(ngram_join.counter_bytes(c)) == c).all()
    assert len(ngram_join.counters_of(ngram_join.counter_bytes(c[:0]))) == 0


def _docs(spark):
    rows = [(i, " ".join(f"w{i * 31 + j}" for j in range(40))) for i in range(60)]
    near = [(100 + i, t + " and more") for i, t in rows[:20]]
    return spark.createDataFrame([*rows, *near, rows[0], rows[0], (None, "a b c d e f g"), (200, None)], "doc_id long, text string")


def test_index_entries_are_not_stored(spark, monkeypatch):
    """The entries are the most bytes of the join: they are shuffled, not written before."""
    written = {}
    plain = ngram_join.stored

    def stored(df, name):
        written[name] = df.columns
        return plain(df, name)

    monkeypatch.setattr(ngram_join, "stored", stored)
    got = sorted(map(tuple, ngram_join.jaccard_join(_docs(spark)).collect()), key=str)
    assert [c for c in got if c[0] == 100] == [(100, 38, 0)] and [c for c in got if c[0] == 0] == [(0, 36, 0)] * 3
    assert len(got) == 84 and not [n for n, columns in written.items() if "entries" in columns]


def test_sketches_come_with_the_sizes(spark):
    rows = ngram_join.sizes_and_counters(_docs(spark).coalesce(1)).where("chunk IS NULL").collect()
    first = {}
    for r in rows:
        assert (r["sketch"] is not None) == (r["n"] > 0 and r["id"] not in first)
        first[r["id"]] = True
    counted = ngram_join.sizes_and_counters(_docs(spark))
    rank, frequent = ngram_join.ranks(counted)
    shingles = sum(r["n"] for r in rows)
    assert len(rank) == 1 << ngram_join.COUNTER_BITS and 0 < (rank > 0).sum() <= shingles and rank.max() >= 4 and frequent > rank.max()
