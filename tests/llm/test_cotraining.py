"""Co-training over all rows: moments, pseudo-labels, copies, odd columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import cotraining as C
from tallyhouse.llm import features as ft

SCHEMA = "doc_id long, text string, source string, lang string, n_chars string"


@pytest.fixture(scope="module")
def docs(spark):
    good = [(i, f"a calm page number {i} with plain words about rivers and towns " * 6, "web", "en", str(400 + i)) for i in range(60)]
    bad = [(100 + i, f"$$$ BUY NOW!!! {i} ### click %%% " * 8, "spam", "en", "abc") for i in range(60)]
    copies = [(1000 + i, "the same calm page with plain words about rivers and towns " * 6, "web", "en", None) for i in range(300)]
    odd = [(None, "no id", None, None, "1"), (5000, None, "web", "en", "nan"), (5001, "", None, None, ""), (1, "a second text of one id", "web", "en", "3")]
    return spark.createDataFrame(good + bad + copies + odd, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1) for i in range(20)] + [(100 + i, 0) for i in range(20)], "doc_id long, quality int")


def test_moments_are_of_all_rows(docs):
    views = C.Views(docs, "text", "doc_id", ["source", "lang"], ["n_chars"])
    width = ft.LAYOUT + 2 + 2 * ft.CELLS
    mean, spread = views.moments(width)
    rows = ft.sample_features(docs.withColumn("k", F.monotonically_increasing_id()),
                              docs.withColumn("k", F.monotonically_increasing_id()).select(F.col("k").alias("pick")), "k", "text", ["source", "lang"], ["n_chars"])
    assert len(rows) == docs.count()
    want = rows.meta.std(0)
    assert np.allclose(mean, rows.meta.mean(0)) and np.allclose(spread, np.where(want < 1e-9, 1.0, want), atol=1e-6)


def test_every_confident_row_is_offered_and_a_text_counts_once(spark, docs, labels):
    views = C.Views(docs, "text", "doc_id", ["source", "lang"], ["n_chars"])
    width = ft.LAYOUT + 2 + 2 * ft.CELLS
    sure = C.Model(np.zeros(ft.WIDTH, np.float32), 9.0, np.zeros(width), np.ones(width), np.append(np.zeros(width), -9.0))
    ids = labels.select(F.col("doc_id").alias("pick"))
    got = views.confident(sure, ids)
    labelled = {r["pick"] for r in ids.collect()}
    want = sorted(str(r["doc_id"]) for r in docs.where("doc_id IS NOT NULL").collect() if r["doc_id"] not in labelled)
    assert sorted(r["id"] for r in got.collect()) == want
    assert {(r["text_says"], r["meta_says"]) for r in got.collect()} == {(1, 0)}
    given = C._given(got, "text_says", 10**9, 0)
    assert set(given.values()) == {1.0} and sum(int(i) >= 1000 and int(i) < 2000 for i in given) == 1
    few = C._given(got, "text_says", 10, 0)
    assert 1 <= len(few) <= 30 and few == C._given(got, "text_says", 10, 0)


def test_fit_and_classify(docs, labels):
    got = {(r["doc"]["doc_id"], r["doc"]["text"]): r["kept"] for r in C.classify(docs, C.fit(docs, labels)).collect()}
    assert all(k for (i, _), k in got.items() if i is not None and (20 <= i < 60 or 1000 <= i < 2000))
    assert not any(k for (i, _), k in got.items() if i is not None and 120 <= i < 160)


def test_few_labels(docs, labels):
    one = labels.where("doc_id IN (1, 2, 3, 100)")
    model = C.fit(docs, one)
    assert model.known and np.isfinite(model.final).all() and C.classify(docs, model).count() == docs.count()
    assert not C.fit(docs, labels.where("quality = 1")).known
    assert C.fit(docs.limit(0), labels).known is False


def test_folds_hold_both_classes():
    y = {str(i): int(i < 3) for i in range(20)}
    fold = C._folds(y)
    assert all({y[i] for i in y if fold[i] == f} == {0, 1} for f in set(fold.values())) and len(set(fold.values())) == 3
    assert set(C._folds({"a": 1, "b": 0, "c": 0}).values()) == {0}
