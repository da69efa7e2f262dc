"""Quality rules: text statistics and a hashed n-gram logistic regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features as ft
from .common import Words, _powers, mix, slices, text_buffer

MIN_WORDS = 50
#: A text fails when more than half of its words stand in repeated windows.
REPEATED_PERCENT = 50
WINDOW = 3
#: Least calibrated probability of good quality of a kept text.
THRESHOLD = 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _distinct_per_row(key: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    _, first = np.unique(key, return_index=True)
    return np.bincount(row[first], minlength=n_rows)


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same row."""
    n_rows = len(offsets) - 1
    if not len(words.start):
        return np.zeros(n_rows, np.int64)
    cut = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate((offsets[:-1], cut + 1)))
    begin = begin[begin < len(data)]
    line_of_word = np.searchsorted(begin, words.start, "right") - 1
    used = np.unique(line_of_word)
    end = np.append(begin[1:], len(data))
    place = np.arange(len(data)) - np.repeat(begin, end - begin)
    value = data.astype(np.uint64) + np.uint64(1)
    value[data == 10] = 0  # the break is not part of the line
    value *= _powers(int((end - begin).max()))[place]
    size = end - begin - (data[end - 1] == 10)
    line = mix(np.add.reduceat(value, begin) ^ (size.astype(np.uint64) << np.uint64(40)))[used]
    row = np.searchsorted(offsets, begin[used], "right") - 1
    key = mix(line ^ mix(row.astype(np.uint64)))
    return np.bincount(row, minlength=n_rows) - _distinct_per_row(key, row, n_rows)


def repeated_words(words: Words, n_rows: int, window: int = WINDOW) -> np.ndarray:
    """Words inside windows that the row holds twice or more."""
    h, row = words.hash, words.doc
    if len(h) < window:
        return np.zeros(n_rows, np.int64)
    last = len(h) - window + 1
    key = mix(row[:last].astype(np.uint64))
    for j in range(window):
        key = mix(key ^ h[j:last + j])
    inside = row[:last] == row[window - 1:]
    at = np.flatnonzero(inside)
    _, inverse, count = np.unique(key[at], return_inverse=True, return_counts=True)
    again = at[count[inverse] > 1]
    covered = np.zeros(len(h), bool)
    for j in range(window):
        covered[again + j] = True
    return np.bincount(row[covered], minlength=n_rows)


def statistics(data: np.ndarray, offsets: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    in_word = np.zeros(len(data) + 1, np.int64)
    np.add.at(in_word, words.start, 1)
    np.add.at(in_word, words.end, -1)
    in_word = np.cumsum(in_word[:-1]) > 0
    n_rows = len(offsets) - 1
    return {"n_words": words.counts().astype(np.int64),
            "word_chars": ft.row_sums(in_word & ((data & 0xC0) != 0x80), offsets).astype(np.int64),
            "n_symbols": ft.row_sums(_SYMBOL[data], offsets).astype(np.int64),
            "n_dup_lines": duplicate_lines(data, offsets, words).astype(np.int64),
            "n_repeat_words": repeated_words(words, n_rows).astype(np.int64)}


@dataclass
class Model:
    weights: np.ndarray  # of the hashed features
    slope: float  # calibration: probability = sigmoid(slope * margin + intercept)
    intercept: float


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        per_class: int = ft.PER_CLASS) -> Model:
    """Fit on at most ``per_class`` labelled documents of each class; a quarter of
    them, by a hash of the id, calibrates the margins (Platt) and the log odds
    of the whole label table correct for the even classes. Without labels of
    both classes every text gets probability one."""
    ids, y_of, odds = ft.labelled_sample(labels, doc_id, label, per_class)
    neutral = Model(np.zeros(ft.WIDTH, np.float32), 0.0, 60.0)
    if ids is None:
        return neutral
    rows = ft.sample_features(docs, ids, doc_id, text)
    y = np.array([y_of[i] for i in rows.ids], float)
    if len(set(y)) < 2:
        return neutral
    held = ft.is_fold(rows.ids)
    if min(len(set(y[held])), len(set(y[~held]))) < 2:
        held = np.zeros(len(y), bool)
    train = np.flatnonzero(~held)
    w, _ = ft.fit_sparse(rows, train, y[train], ft.balanced(y[train]))
    check = np.flatnonzero(held) if held.any() else train
    margin = np.array([float(rows.value[i] @ w[rows.index[i]]) for i in check])
    slope, intercept = ft.fit_dense(margin[:, None], y[check], ft.balanced(y[check]) * len(check), ridge=1e-3)
    return Model(w.astype(np.float32), float(max(slope, 0.0)), float(intercept + odds))


def apply_rules(docs: DataFrame, model: Model, text: str = "text", payload: list[str] | None = None,
                threshold: float = THRESHOLD) -> DataFrame:
    """Statistics, base verdict, calibrated probability and verdict of every text.

    Returns ``doc`` (struct of the payload columns, all by default), ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``quality`` and ``kept``. Null and empty texts have no words
    and fail; repeated rows are scored each; a text is scored whole.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in payload or docs.columns]).alias("doc"),
                       F.col(text).cast("string").alias("text"))
    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = rows.select("doc", *[F.lit(0).cast("long").alias(c) for c in counted], F.lit(True).alias("base_failed"),
                         F.lit(0.0).alias("quality"), F.lit(True).alias("kept")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for part in slices(batches, "text"):
            data, offsets = text_buffer(part.column("text"))
            words = Words(data, offsets, lower=False)
            got = statistics(data, offsets, words)
            failed = (got["n_words"] < MIN_WORDS) | (100 * got["n_repeat_words"] > REPEATED_PERCENT * got["n_words"])
            p = ft.sigmoid(model.slope * ft.linear(ft.families(words, offsets), model.weights) + model.intercept)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), *[pa.array(got[c], pa.int64()) for c in counted], pa.array(failed), pa.array(p),
                 pa.array(~failed & (p >= threshold))], schema.names)

    return rows.mapInArrow(run, schema)
