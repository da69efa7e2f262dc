"""Quality classifier by co-training of a text view and a page-metadata view."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features as ft
from .common import Words, slices, stored, text_buffer, texts_of, with_text

ROUNDS = 2
#: Pseudo-labels of either class that a view's fit takes from the other view in a
#: round, about: a hashed sample of all that are confident, texts counted once.
EXCHANGED = 80
#: Least probability of a pseudo-label.
CONFIDENT = 0.95
THRESHOLD = 0.5
#: Parts of the labelled rows that calibration leaves out of the fit in turn, at most.
FOLDS = 3
_HASH = 1 << 30


@dataclass
class Model:
    text: np.ndarray
    text_bias: float
    mean: np.ndarray
    spread: np.ndarray
    meta: np.ndarray
    views: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 1.0, 0.0]))  # slope, intercept of either view
    final: np.ndarray = field(default_factory=lambda: np.array([0.5, 0.5, 0.0]))
    known: bool = True

    def meta_margin(self, meta: np.ndarray) -> np.ndarray:
        return np.clip((meta - self.mean) / self.spread, -6, 6) @ self.meta[:-1] + self.meta[-1]

    def combine(self, text: np.ndarray, meta: np.ndarray):
        """Calibrated probability of either view, and of both."""
        a = self.views[0] * text + self.views[1]
        b = self.views[2] * meta + self.views[3]
        return ft.sigmoid(a), ft.sigmoid(b), ft.sigmoid(np.clip(a, -30, 30) * self.final[0] + np.clip(b, -30, 30) * self.final[1] + self.final[2])


class Views:
    """Both views over the rows of a table."""

    def __init__(self, docs: DataFrame, text: str, doc_id: str, categories, numbers):
        self.docs, self.text, self.doc_id = docs, text, doc_id
        self.names = [*categories, *numbers]
        self.cats = [f"c{i}" for i in range(len(categories))]
        self.nums = [f"c{i}" for i in range(len(categories), len(self.names))]
        self.categories, self.numbers = categories, numbers

    def _rows(self, *more):
        return self.docs.select(F.col(self.text).cast("string").alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(self.names)], *more)

    def moments(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Mean and spread of the metadata over all rows."""
        cats, nums = self.cats, self.nums

        def run(batches):
            n, one, two = 0, np.zeros(width), np.zeros(width)
            for part in slices(batches, "text", ft.PASS_BYTES):
                meta = ft.metadata(part, *text_buffer(part.column("text")), cats, nums)
                n, one, two = n + len(meta), one + meta.sum(0), two + (meta * meta).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array([n] * width), pa.array(one), pa.array(two)], ["i", "n", "one", "two"])

        got = (self._rows().mapInArrow(run, "i long, n long, one double, two double").groupBy("i")
               .agg(F.sum("n").alias("n"), F.sum("one").alias("one"), F.sum("two").alias("two")).orderBy("i").collect())
        n = max([1, *(r["n"] for r in got)])
        mean = np.array([r["one"] / n for r in got]) if got else np.zeros(width)
        spread = np.sqrt(np.maximum(np.array([r["two"] / n for r in got]) - mean * mean, 0)) if got else np.ones(width)
        return mean, np.where(spread < 1e-9, 1.0, spread)

    def confident(self, model: Model, labelled: DataFrame) -> DataFrame:
        """Rows that are not ``labelled`` and of which a view is sure: ``id``, ``content``
        (hash of the text), and the class that either view gives, null if unsure."""
        cats, nums = self.cats, self.nums
        shared = self.docs.sparkSession.sparkContext.broadcast(model)
        rows = (self._rows(F.col(self.doc_id).alias("pick"), F.xxhash64(F.col(self.text)).alias("content")).where("pick IS NOT NULL")
                .join(F.broadcast(labelled), "pick", "left_anti").withColumn("id", F.col("pick").cast("string")).drop("pick"))

        def run(batches):
            model = shared.value
            for part in slices(batches, "text", ft.PASS_BYTES):
                data, offsets = text_buffer(part.column("text"))
                text = ft.linear(ft.families(Words(data, offsets, lower=False), offsets), model.text) + model.text_bias
                meta = model.meta_margin(ft.metadata(part, data, offsets, cats, nums))
                given = [np.where(p >= CONFIDENT, 1, np.where(p <= 1 - CONFIDENT, 0, -1)) for p in (ft.sigmoid(text), ft.sigmoid(meta))]
                sure = np.flatnonzero((given[0] >= 0) | (given[1] >= 0))
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(sure)), part.column("content").take(pa.array(sure)),
                                                  *[pa.array(g[sure].astype(np.int32)) for g in given]], ["id", "content", "text_says", "meta_says"])

        return stored(rows.mapInArrow(run, "id string, content long, text_says int, meta_says int"), "cotraining-sure")

    def features(self, ids: list) -> ft.Rows:
        kind = self.docs.schema[self.doc_id].dataType.simpleString()
        spark = self.docs.sparkSession
        wanted = spark.createDataFrame([(i,) for i in ids], "pick string").select(F.col("pick").cast(kind).alias("pick"))
        return ft.sample_features(self.docs, wanted, self.doc_id, self.text, self.categories, self.numbers, once=True)


def _given(sure: DataFrame, view: str, exchanged: int, step: int) -> dict[str, float]:
    """About ``exchanged`` of the ids that a view is sure of, for either class: a hashed
    sample of all distinct texts, so that a text with many copies counts once."""
    out: dict[str, float] = {}
    once = stored(sure.where(F.col(view) >= 0).groupBy("content").agg(F.min("id").alias("id"), F.min(view).alias("says")), "cotraining-given")
    for r in once.groupBy("says").agg(F.count("*").alias("n")).orderBy("says").collect():
        limit = int(min(1.0, exchanged / r["n"]) * _HASH)
        picked = once.where((F.col("says") == r["says"]) & (F.pmod(F.xxhash64("id", F.lit(f"{view} {step}")), F.lit(_HASH)) < limit))
        out.update({p["id"]: float(r["says"]) for p in picked.collect()})
    return out


class _Sample:
    """Features of the labelled and pseudo-labelled rows, held by the driver."""

    def __init__(self, rows: ft.Rows):
        self.rows = rows
        self.at = {i: k for k, i in enumerate(rows.ids)}

    def add(self, rows: ft.Rows) -> None:
        new = [k for k, i in enumerate(rows.ids) if i not in self.at]
        mine = self.rows
        for k in new:
            self.at[rows.ids[k]] = len(mine.ids)
            mine.ids.append(rows.ids[k])
            mine.index.append(rows.index[k])
            mine.value.append(rows.value[k])
        if new:
            mine.meta = np.concatenate([mine.meta, rows.meta[new]])

    def fit(self, known: list[dict[str, float]], mean: np.ndarray, spread: np.ndarray) -> Model:
        """Both views, each from the rows and classes ``known`` to it."""
        at, t = zip(*sorted((self.at[i], c) for i, c in known[0].items() if i in self.at))
        at, t = np.array(at), np.array(t)
        w, bias = ft.fit_sparse(self.rows, at, t, ft.balanced(t))
        at, t = zip(*sorted((self.at[i], c) for i, c in known[1].items() if i in self.at))
        at, t = np.array(at), np.array(t)
        dense = np.clip((self.rows.meta[at] - mean) / spread, -6, 6)
        m = ft.fit_dense(dense, t, ft.balanced(t) * len(at), ridge=1.0)
        return Model(w.astype(np.float32), bias, mean, spread, m)

    def margins(self, model: Model, ids: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at = [self.at[i] for i in ids]
        return (np.array([float(self.rows.value[k] @ model.text[self.rows.index[k]]) for k in at]) + model.text_bias,
                model.meta_margin(self.rows.meta[at]))


def _folds(y_of: dict[str, int], most: int = FOLDS) -> dict[str, int]:
    """A part for each labelled id, in turn within its class in order of a hash; one
    part for all where a class has a single row."""
    many = min([most, *(sum(y == k for y in y_of.values()) for k in (0, 1))])
    out: dict[str, int] = {}
    for k in (0, 1):
        for place, i in enumerate(sorted((i for i, y in y_of.items() if y == k), key=lambda i: (zlib.crc32(f"fold {i}".encode()), i))):
            out[i] = place % max(1, many)
    return out


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        categories=("source", "lang"), numbers=("n_chars",), per_class: int = ft.PER_CLASS, rounds: int = ROUNDS,
        exchanged: int = EXCHANGED) -> Model:
    """Co-train on at most ``per_class`` labelled documents of each class (by a hash of
    the id; a documented bound) and on pseudo-labels from all others.

    Each round fits both views and scores every document that is not in the
    labelled sample. What a view is sure of is handed to the other: a fit
    takes a hashed sample of about ``exchanged`` of these for either class. Mean and
    spread of the metadata are those of the whole table.

    Calibration and the weights of the views come from labelled rows that a fit
    has left out: each of up to ``FOLDS`` parts is scored by views fitted without it.
    With a single row of a class nothing can be left out, and the views count alike,
    uncalibrated. Without labels of both classes every document is kept.
    A repeated id is one row of the fit, that of the least text.
    """
    categories = [c for c in categories if c in docs.columns]
    numbers = [c for c in numbers if c in docs.columns]
    ids, y_of, odds = ft.labelled_sample(labels, doc_id, label, per_class)
    width = ft.LAYOUT + 2 * len(numbers) + ft.CELLS * len(categories)
    neutral = Model(np.zeros(ft.WIDTH, np.float32), 0.0, np.zeros(width), np.ones(width), np.zeros(width + 1), known=False)
    if ids is None:
        return neutral
    views = Views(docs, text, doc_id, categories, numbers)
    sample = _Sample(views.features(list(y_of)))
    y_of = {i: y for i, y in y_of.items() if i in sample.at}
    if len(set(y_of.values())) < 2:
        return neutral
    mean, spread = views.moments(width)
    known = [{i: float(y) for i, y in y_of.items()} for _ in range(2)]
    model = sample.fit(known, mean, spread)
    for step in range(rounds):
        sure = views.confident(model, ids)
        given = [_given(sure, view, exchanged, step) for view in ("text_says", "meta_says")]
        sample.add(views.features(sorted({*given[0], *given[1]})))
        for mine, theirs in ((known[0], given[1]), (known[1], given[0])):
            mine.update({i: c for i, c in theirs.items() if i not in mine and i in sample.at})
        model = sample.fit(known, mean, spread)

    fold = _folds(y_of)
    if len(set(fold.values())) < 2:
        model.final[2] += odds
        return model
    judged, text_m, meta_m = [], [], []
    for f in sorted(set(fold.values())):
        out = [i for i in y_of if fold[i] == f]
        left = sample.fit([{i: c for i, c in k.items() if fold.get(i) != f} for k in known], mean, spread)
        t, m = sample.margins(left, out)
        judged += out
        text_m.append(t)
        meta_m.append(m)
    y, text_m, meta_m = np.array([float(y_of[i]) for i in judged]), np.concatenate(text_m), np.concatenate(meta_m)
    even = ft.balanced(y) * len(y)
    a = ft.fit_dense(text_m[:, None], y, even, ridge=1e-3)
    b = ft.fit_dense(meta_m[:, None], y, even, ridge=1e-3)
    model.views = np.array([max(a[0], 0.0), a[1], max(b[0], 0.0), b[1]])
    both = np.stack([np.clip(model.views[0] * text_m + model.views[1], -30, 30),
                     np.clip(model.views[2] * meta_m + model.views[3], -30, 30)], axis=1)
    model.final = ft.fit_dense(both, y, even, ridge=1e-2)
    model.final[:2] = np.maximum(model.final[:2], 0.0)
    model.final[2] += odds
    return model


def classify(docs: DataFrame, model: Model, text: str = "text", categories=("source", "lang"), numbers=("n_chars",),
             payload: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Score every document: ``doc`` (struct of the payload columns, all by default),
    ``text_score``, ``meta_score``, ``score`` (0 to 1), ``kept``.

    Null metadata are values of their own; a null text is empty. An unfitted
    model keeps everything. Repeated rows are scored each.
    """
    categories = [c for c in categories if c in docs.columns]
    numbers = [c for c in numbers if c in docs.columns]
    names = [*categories, *numbers]
    cats, nums = [f"c{i}" for i in range(len(categories))], [f"c{i}" for i in range(len(categories), len(names))]
    rows, place = with_text(docs, text, payload, *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    schema = rows.select("doc", *[F.lit(0.0).alias(c) for c in ("text_score", "meta_score", "score")], F.lit(True).alias("kept")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for part in slices(texts_of(batches, place), "text", ft.PASS_BYTES):
            data, offsets = text_buffer(part.column("text"))
            margin = ft.linear(ft.families(Words(data, offsets, lower=False), offsets), model.text) + model.text_bias
            a, b, p = model.combine(margin, model.meta_margin(metadata(part, data, offsets)))
            kept = p >= threshold if model.known else np.ones(len(p), bool)
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(a), pa.array(b), pa.array(p), pa.array(kept)], schema.names)

    def metadata(part, data, offsets):
        return ft.metadata(part, data, offsets, cats, nums)

    return rows.mapInArrow(run, schema)
