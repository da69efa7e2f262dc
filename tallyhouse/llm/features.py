"""Hashed text features, page layout features and logistic regression for the
quality models. Models are fitted on bounded samples; every row is scored."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, blob, mix, slices, text_buffer

#: Each feature family is hashed to 2**BITS weights.
BITS = 17
FAMILIES = 3  # words, 3 characters, 4 characters
WIDTH = FAMILIES << BITS
#: Shares are multiplied by this, so that weights stay of the order of one.
SCALE = 50.0
#: Text of one pass; its features take some hundred bytes a byte.
PASS_BYTES = 1 << 19
#: Sparse features that a fit takes at once.
BLOCK_FEATURES = 1 << 18
#: Labelled documents per class that a model is fitted on at most.
PER_CLASS = 1000
#: Layout features of a text, see :func:`layout`.
LAYOUT = 8
#: Hashed cells of each categorical metadata column.
CELLS = 64

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each character of a UTF-8 buffer (its bytes, in one), and the rows' bounds."""
    leads = (data & 0xC0) != 0x80
    at = np.flatnonzero(leads)
    size = np.diff(np.append(at, len(data)))
    value = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        value[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return value, np.concatenate(([0], np.cumsum(leads)))[offsets]


def families(words: Words, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per family the hashed index of every feature occurrence and the bounds of
    each row's occurrences. Character n-grams do not cross rows."""
    out = [((words.hash >> np.uint64(64 - BITS)).astype(np.int64), words.first)]
    letter, begin = characters(words.data, offsets)
    size = np.diff(begin)
    row = np.repeat(np.arange(len(size)), size)
    value = letter
    for n in (2, 3, 4):
        value = (value[:-1] ^ (value[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + letter[n - 1:]
        if n == 2:
            continue
        inside = row[:len(value)] == row[n - 1:]
        hashed = (value[inside] * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        out.append((hashed.astype(np.int64) + ((n - 2) << BITS), np.concatenate(([0], np.cumsum(np.maximum(size - (n - 1), 0))))))
    return out


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def linear(found, weights: np.ndarray) -> np.ndarray:
    """Sum over the families of the mean weight of a row's features, scaled."""
    score = np.zeros(len(found[0][1]) - 1)
    for index, bounds in found:
        score += SCALE * row_sums(weights[index], bounds) / np.maximum(np.diff(bounds), 1)
    return score


def sparse(found) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same features as (index, value) per row."""
    rows = []
    for i in range(len(found[0][1]) - 1):
        index, value = [], []
        for ids, bounds in found:
            if bounds[i + 1] > bounds[i]:
                u, n = np.unique(ids[bounds[i]:bounds[i + 1]], return_counts=True)
                index.append(u)
                value.append(SCALE * n / (bounds[i + 1] - bounds[i]))
        rows.append((np.concatenate(index or [np.zeros(0, int)]).astype(np.int32),
                     np.concatenate(value or [np.zeros(0)]).astype(np.float32)))
    return rows


def layout(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Page layout per row: log size, log lines, log line length, shares of upper
    case, digits, symbols, exclamation marks and white space."""
    size = np.diff(offsets)
    share = np.maximum(size, 1)
    count = lambda mask: row_sums(mask, offsets)
    lines = count(data == 10) + 1
    return np.stack([np.log1p(size), np.log1p(lines), np.log1p(size / lines),
                     count((data >= 65) & (data <= 90)) / share, count((data >= 48) & (data <= 57)) / share,
                     count(_SYMBOLS[data]) / share, count(data == 33) / share, count(data <= 32) / share], axis=1)


@dataclass
class Rows:
    """Bounded sample held by the driver: sparse text features, dense metadata."""

    ids: list
    index: list
    value: list
    meta: np.ndarray

    def __len__(self):
        return len(self.ids)


def metadata(batch: pa.RecordBatch, data, offsets, categories: list[str], numbers: list[str]) -> np.ndarray:
    """Layout, numeric columns (log of the size; null: 0 and a flag) and hashed
    categorical columns (null is a value of its own)."""
    parts = [layout(data, offsets)]
    for c in numbers:
        raw = np.array([number(x) for x in batch.column(c).to_pylist()], dtype=float).reshape(-1)
        raw[~np.isfinite(raw)] = np.nan
        parts.append(np.stack([np.sign(raw) * np.log1p(np.abs(raw)), np.isnan(raw)], axis=1))
    for c in categories:
        column = batch.column(c)
        words = np.array([hash_text(x) for x in column.to_pylist()], dtype=np.int64).reshape(-1)
        cells = np.zeros((batch.num_rows, CELLS))
        cells[np.arange(batch.num_rows), words] = 1
        parts.append(cells)
    return np.nan_to_num(np.concatenate(parts, axis=1))


def number(x) -> float:
    """A numeric value; one that cannot be read as a number counts as null."""
    try:
        return np.nan if x is None else float(x)
    except (TypeError, ValueError):
        return np.nan


def hash_text(x) -> int:
    """Cell of a whole value, 0 for null."""
    if x is None:
        return 0
    code = hashlib.blake2b(str(x).encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return 1 + int.from_bytes(code, "little") % (CELLS - 1)


def sample_features(docs: DataFrame, ids: DataFrame, doc_id: str, text: str, categories=(), numbers=(), once: bool = False) -> Rows:
    """Features of the documents in ``ids`` (column ``pick``; a bounded table). ``once``:
    of a repeated id only the row of the least text, found map-side first."""
    names = [*categories, *numbers]
    rows = (docs.join(F.broadcast(ids), docs[doc_id] == ids["pick"], "left_semi")
            .select(F.col(doc_id).cast("string").alias("id"), F.col(text).cast("string").alias("text"),
                    *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)]))
    if once:
        rest = [c for c in rows.columns if c != "id"]
        rows = rows.groupBy("id").agg(F.min(F.struct(*rest)).alias("r")).select("id", "r.*")
    cats, nums = [f"c{i}" for i in range(len(categories))], [f"c{i}" for i in range(len(categories), len(names))]

    def run(batches):
        for part in slices(batches, "text", PASS_BYTES):
            data, offsets = text_buffer(part.column("text"))
            got = sparse(families(Words(data, offsets, lower=False), offsets))
            meta = metadata(part, data, offsets, cats, nums)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([blob(i) for i, _ in got], pa.binary()), pa.array([blob(v) for _, v in got], pa.binary()),
                 pa.array([blob(m) for m in meta], pa.binary())], ["id", "index", "value", "meta"])

    got = rows.mapInArrow(run, "id string, index binary, value binary, meta binary").toArrow().to_pydict()
    order = sorted(range(len(got["id"])), key=lambda i: (got["id"][i], got["index"][i], got["value"][i]))
    return Rows([got["id"][i] for i in order], [np.frombuffer(got["index"][i], np.int32) for i in order],
                [np.frombuffer(got["value"][i], np.float32) for i in order],
                np.array([np.frombuffer(got["meta"][i], np.float64) for i in order])
                .reshape(len(order), LAYOUT + 2 * len(numbers) + CELLS * len(categories)))


def labelled_sample(labels: DataFrame, doc_id: str, label: str, per_class: int) -> tuple[DataFrame | None, dict[str, int], float]:
    """At most ``per_class`` labelled ids of each class, in order of a hash.

    Contradicting labels of one id and null ids or labels are left out. Returns
    the ids (column ``pick``), their labels by id text, and the log odds of the
    classes in the whole table.
    """
    spark = labels.sparkSession
    agreed = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("pick"))
              .agg(F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("z")).where("y = z"))
    sizes = {r["y"]: r["n"] for r in agreed.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = [r for y in (0, 1) for r in agreed.where(F.col("y") == y).orderBy(F.xxhash64("pick"), "pick").limit(per_class).collect()]
    if len(sizes) < 2:
        return None, {}, 0.0
    kind = agreed.schema["pick"].dataType.simpleString()
    ids = spark.createDataFrame([(r["pick"],) for r in picked], f"pick {kind}")
    return ids, {str(r["pick"]): r["y"] for r in picked}, float(np.log(sizes[1] / sizes[0]))


def fit_sparse(rows: Rows, at: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 120) -> tuple[np.ndarray, float]:
    """Logistic regression with a small ridge by Adam over all rows of ``at``, whose
    features are taken in blocks: the driver never holds numbers of all of them at once."""
    size = np.array([len(rows.index[i]) for i in at], np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // BLOCK_FEATURES, prepend=-1))
    blocks = [(a, np.concatenate([rows.index[i] for i in at[a:b]]), np.concatenate([rows.value[i] for i in at[a:b]]),
               np.repeat(np.arange(b - a, dtype=np.int32), size[a:b])) for a, b in zip(cuts, [*cuts[1:], len(at)])]
    w, b = np.zeros(WIDTH), 0.0
    m, v, mb, vb = np.zeros(WIDTH), np.zeros(WIDTH), 0.0, 0.0
    margin = np.zeros(len(at))
    for t in range(1, rounds + 1):
        for a, index, value, owner in blocks:
            got = np.bincount(owner, value * w[index])
            margin[a:a + len(got)] = got
        gap = weight * (1 / (1 + np.exp(-margin - b)) - y)
        g = np.zeros(WIDTH)
        for a, index, value, owner in blocks:
            np.add.at(g, index, value * gap[a + owner])
        g += 1e-4 * w
        gb = gap.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
        b -= 0.05 * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.99 ** t)) + 1e-6)
    return w, float(b)


def fit_dense(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method; the intercept comes last."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + penalty * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return w


def balanced(y: np.ndarray) -> np.ndarray:
    """Weights under which both classes count alike, summing to one."""
    n = np.array([max(1, (y == k).sum()) for k in (0, 1)])
    return 0.5 / n[y.astype(int)]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def is_fold(ids: list[str], fold: int = 4) -> np.ndarray:
    """True for the rows kept back for calibration, by a hash of the id."""
    return np.array([hash_text(f"fold {i}") % fold == 0 for i in ids], bool)
