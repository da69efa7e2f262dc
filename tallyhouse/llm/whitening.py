"""Embedding whitening from an exact scatter matrix, counted bit by bit.

Entries become integers; the distinct integer vectors are transposed into bit
planes (one bit per row, 64 rows a word), and the cross-products of two
dimensions are the popcounts of their planes' ANDs, weighted by the planes'
powers of two. All sums are integers of any length, so they do not depend on
order, partitions or lost tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64.0, 1_000_000
#: Components of the result at most.
COMPONENTS = 16
#: Rows that one round of bit planes holds; with the planes of a dimension pair it bounds a task's memory.
ROUND_ROWS = 8192
#: Eigenvalues up to this share of the largest are taken for zero.
FLAT = 1e-12

_WIDTHS = ((1, np.int8), (2, np.int16), (4, np.int32), (8, np.int64))


def integers(vectors: np.ndarray) -> list[list[int]] | np.ndarray:
    """floor(SCALE * c), without the offset. Doubles are scaled by a power of two
    exactly; beyond 64 bits Python's integers are used."""
    scaled = np.floor(vectors * SCALE)
    if scaled.size == 0 or np.abs(scaled).max() < 2.0 ** 62:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled], dtype=object)


def encode(x: np.ndarray) -> list[bytes]:
    """A key per row: the width of its entries (the least that holds them all) and the entries."""
    if x.dtype == object:
        return [_encode_wide(row) for row in x]
    if x.shape[1] == 0:
        return [b"\x01"] * len(x)
    least, most = x.min(axis=1), x.max(axis=1)
    keys: list[bytes] = [b""] * len(x)
    done = np.zeros(len(x), bool)
    for width, kind in _WIDTHS:
        limits = np.iinfo(kind)
        fits = ~done & (least >= limits.min) & (most <= limits.max)
        rows = np.flatnonzero(fits)
        small = x[rows].astype(kind)
        for at, row in zip(rows.tolist(), small):
            keys[at] = bytes((width,)) + row.tobytes()
        done |= fits
    return keys


def _encode_wide(row) -> bytes:
    width = max((int(v).bit_length() + 8) // 8 for v in row)
    for known, _ in _WIDTHS:
        if width <= known:
            width = known
            break
    return bytes((min(width, 255),)) + b"".join(int(v).to_bytes(width, "little", signed=True) for v in row)


def decode(keys: list[bytes], dims: int) -> np.ndarray:
    """The rows of :func:`encode`, all of ``dims`` entries."""
    if not dims:
        return np.zeros((len(keys), 0), np.int64)
    kinds = dict(_WIDTHS)
    widths = {len(k) for k in keys}
    if all((size - 1) // dims in kinds for size in widths):
        out = np.empty((len(keys), dims), np.int64)
        sizes = np.array([len(k) for k in keys])
        for size in widths:
            rows = np.flatnonzero(sizes == size)
            raw = b"".join(keys[r][1:] for r in rows.tolist())
            out[rows] = np.frombuffer(raw, kinds[(size - 1) // dims]).reshape(len(rows), dims)
        return out
    out = np.empty((len(keys), dims), object)
    for r, key in enumerate(keys):
        width = (len(key) - 1) // dims
        out[r] = [int.from_bytes(key[1 + i * width:1 + (i + 1) * width], "little", signed=True) for i in range(dims)]
    return out


def planes(x: np.ndarray, low: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of ``x - low``: words (plane x rows / 64), and each plane's
    dimension and bit. Planes without a set bit are left out."""
    rows, dims = x.shape
    words, dim, bit = [], [], []
    for i in range(dims):
        shifted = x[:, i] - low[i]
        top = int(shifted.max()).bit_length()
        for b in range(top):
            marks = np.asarray((shifted >> b) & 1, dtype=bool)
            if marks.any():
                padded = np.zeros(-(-rows // 64) * 64, bool)
                padded[:rows] = marks
                words.append(np.packbits(padded, bitorder="little").view(np.uint64))
                dim.append(i)
                bit.append(b)
    return np.array(words, np.uint64).reshape(len(words), -(-rows // 64)), np.array(dim, int), np.array(bit, int)


def scatter(x: np.ndarray, low: list[int]) -> tuple[list[int], np.ndarray]:
    """Sums and cross-products (upper triangle, Python integers) of ``x - low`` by weighted AND-popcounts."""
    dims = x.shape[1]
    words, dim, bit = planes(x, low)
    sums = [0] * dims
    cross = np.zeros((dims, dims), object)
    for p in range(len(words)):
        i, weight = int(dim[p]), 1 << int(bit[p])
        sums[i] += weight * int(np.bitwise_count(words[p]).sum(dtype=np.int64))
        # planes lie in order of their dimension: those of dimension i and later
        first = int(np.searchsorted(dim, i))
        counts = np.bitwise_count(words[p] & words[first:]).sum(axis=1, dtype=np.int64)
        at, begin = np.unique(dim[first:], return_index=True)
        if int(bit[first:].max()) + int(x.shape[0]).bit_length() < 60:
            cross[i, at] += weight * np.add.reduceat(counts << bit[first:], begin).astype(object)
        else:
            for j, count, b in zip(dim[first:].tolist(), counts.tolist(), bit[first:].tolist()):
                cross[i, j] += weight * (count << b)
    return sums, cross


@dataclass
class Model:
    """Whitening of the vectors of one length: ``n`` fitted rows, ``sums`` and scatter
    of their integers (less the offset), ``values`` and unit ``vectors`` of the
    covariance by falling eigenvalue, its ``trace`` and the ``identity_error``. The
    covariance is of entries over ``2 ** shift``, 0 unless doubles could not hold it."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None
    shift: int = 0

    @classmethod
    def of(cls, n: int, sums: list[int], cross: dict[tuple[int, int], int], low: list[int]) -> Model:
        dims = len(sums)
        centred = np.zeros((dims, dims))
        # centred as integers, then one correctly rounded division
        whole = {(i, j): n * value - sums[i] * sums[j] for (i, j), value in cross.items()}
        shift = max(0, max((abs(v).bit_length() for v in whole.values()), default=0) - 2 * n.bit_length() - 900) // 2
        for (i, j), value in whole.items():
            centred[i, j] = centred[j, i] = value / (n * n << 2 * shift)
        e, u = np.linalg.eigh(centred)
        e, u = e[::-1], u[:, ::-1]
        if dims:
            u = u * np.where(u[np.abs(u).argmax(axis=0), np.arange(dims)] < 0, -1.0, 1.0)
        k = min(COMPONENTS, dims)
        use = (e[:k] > FLAT * max(e[0], 0.0)) if dims else np.zeros(0, bool)
        error = None
        if use.any():
            w = u[:, :k][:, use] / np.sqrt(e[:k][use])
            error = float(np.abs(w.T @ centred @ w - np.eye(w.shape[1])).max())
        return cls(n, [s + n * m for s, m in zip(sums, low)], np.where(use, e[:k], 0.0), u[:, :k],
                   float(np.trace(centred)), error, shift)

    def deviations(self, centred: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S)^2, exact."""
        size = np.abs(centred)
        if size.dtype == object or (size.size and int(size.max()) >= 1 << 62):
            return [sum(int(v) ** 2 for v in row) for row in centred]
        # limbs of 21 bits, so that no sum of products passes 64
        limb = [(size >> (21 * k)) & 0x1FFFFF for k in range(3)]
        parts = [(a + b, ((limb[a] * limb[b]).sum(axis=1) << (a != b)).tolist()) for a in range(3) for b in range(a, 3)]
        return [sum(v << (21 * k) for (k, _), v in zip(parts, row)) for row in zip(*(p for _, p in parts))]

    def whiten(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Whitened rows (rows x components; nan where an eigenvalue is zero) and their deviations."""
        most = max(map(abs, self.sums), default=0) + (int(np.abs(x).max()) if x.size else 0) * self.n
        if most >= 1 << 62:
            x = x.astype(object)
        centred = x * self.n - np.array(self.sums, x.dtype)
        with np.errstate(divide="ignore", invalid="ignore"):
            flat = np.asarray(centred / (self.n << self.shift), dtype=float)
            scaled = (flat @ self.vectors) / np.sqrt(np.where(self.values > 0, self.values, np.nan))
        return scaled, self.deviations(centred)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Doubles of a list column end to end, the length of every row, and whether it is whole."""
    lists = column.cast(pa.large_list(pa.float64()))
    flat = lists.flatten()
    size = np.diff(np.asarray(lists.offsets))
    size[np.asarray(lists.is_null())] = 0
    value = flat.to_numpy(zero_copy_only=False)
    bad = ~np.isfinite(value) | np.asarray(flat.is_null())
    row = np.repeat(np.arange(len(lists)), size)
    good = ~np.asarray(lists.is_null())
    good[row[bad]] = False
    return value, size, good


def _by_length(value: np.ndarray, size: np.ndarray, good: np.ndarray):
    """Per vector length: numbers of the good rows and their vectors."""
    start = np.concatenate(([0], np.cumsum(size)))[:-1]
    for dims in np.unique(size[good]).tolist():
        rows = np.flatnonzero(good & (size == dims))
        yield dims, rows, value[start[rows][:, None] + np.arange(dims)]


def fit_list(rows: DataFrame, vector: str) -> DataFrame:
    """``dims`` and ``key``: every distinct integer vector once, packed into as few
    bytes as hold it."""

    def run(batches):
        for batch in batches:
            for dims, _, vectors in _by_length(*_numbers(batch.column(0))):
                keys = list(dict.fromkeys(encode(integers(vectors))))
                yield pa.RecordBatch.from_arrays([pa.array([dims] * len(keys), pa.int32()), pa.array(keys, pa.binary())], ["dims", "key"])

    packed = rows.select(F.col(vector).cast("array<double>").alias("v")).mapInArrow(run, "dims int, key binary")
    return stored(packed.distinct(), "whitening-fit")


def _chunks(batches):
    """Integer vectors of one length, ``ROUND_ROWS`` at a time."""
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for dims, key in zip(batch.column("dims").to_pylist(), batch.column("key").to_pylist()):
            mine = held.setdefault(dims, [])
            mine.append(key)
            if len(mine) == ROUND_ROWS:
                yield dims, decode(mine, dims)
                held[dims] = []
    for dims, mine in held.items():
        if mine:
            yield dims, decode(mine, dims)


#: Sums travel in digits of this many bits, as longs that Spark adds up.
DIGIT_BITS = 40
_SUMS = "dims int, i int, j int, digit int, value long"


def _digits(rows):
    """One batch of ``(dims, i, j, integer)``, each integer in signed digits."""
    out = []
    for dims, i, j, value in rows:
        rest, digit, sign = abs(int(value)), 0, -1 if value < 0 else 1
        while rest or not digit:
            out.append((dims, i, j, digit, sign * (rest & ((1 << DIGIT_BITS) - 1))))
            rest >>= DIGIT_BITS
            digit += 1
    columns = list(zip(*out)) or [[]] * 5
    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in columns[:4]], pa.array(columns[4], pa.int64())],
                                     ["dims", "i", "j", "digit", "value"])


def fit(rows: DataFrame, vector: str = "embedding") -> dict[int, Model]:
    """Whitening per vector length, from every distinct integer vector once.

    Two passes over the fit list: the least entry of each dimension, then sums
    and cross-products of what is above it, each task's as one row per pair of
    dimensions. The driver gets about d * (d + 1) / 2 sums for d dimensions.
    """
    fitted = fit_list(rows, vector)

    def least(batches):
        low: dict[int, np.ndarray] = {}
        for dims, x in _chunks(batches):
            mine = x.min(axis=0) if dims else np.zeros(0, int)
            low[dims] = np.minimum(low[dims], mine) if dims in low else mine
        # floor(64 * c) of a double is a double, so this is exact
        flat = [(d, i, float(v)) for d, row in low.items() for i, v in enumerate(row.tolist())]
        columns = list(zip(*flat)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.float64())],
                                         ["dims", "i", "value"])

    lows: dict[int, list[int]] = {}
    for r in fitted.mapInArrow(least, "dims int, i int, value double").groupBy("dims", "i").agg(F.min("value").alias("low")).orderBy("dims", "i").collect():
        lows.setdefault(r["dims"], []).append(int(r["low"]))
    counts = {r["dims"]: r["n"] for r in fitted.groupBy("dims").agg(F.count("*").alias("n")).collect()}

    def sums(batches):
        total: dict[int, list] = {}
        for dims, x in _chunks(batches):
            if dims:
                one, two = scatter(x, lows[dims])
                mine = total.setdefault(dims, [[0] * dims, np.zeros((dims, dims), object)])
                mine[0] = [a + b for a, b in zip(mine[0], one)]
                mine[1] = mine[1] + two
        yield from _digits([(d, -1, i, v) for d, (one, _) in total.items() for i, v in enumerate(one)]
                                + [(d, i, j, two[i, j]) for d, (_, two) in total.items() for i in range(d) for j in range(i, d)])

    one: dict[int, list[int]] = {d: [0] * d for d in counts}
    two: dict[int, dict] = {d: {(i, j): 0 for i in range(d) for j in range(i, d)} for d in counts}
    for r in fitted.mapInArrow(sums, _SUMS).groupBy("dims", "i", "j", "digit").agg(F.sum("value").alias("value")).collect():
        part = int(r["value"]) << (DIGIT_BITS * r["digit"])
        if r["i"] < 0:
            one[r["dims"]][r["j"]] += part
        else:
            two[r["dims"]][r["i"], r["j"]] += part
    return {d: Model.of(n, one[d], two[d], lows.get(d, [])) for d, n in counts.items()}


def whiten(rows: DataFrame, models: dict[int, Model], vector: str = "embedding", payload: list[str] | None = None) -> DataFrame:
    """Every row with a whole vector, once per component.

    Returns ``doc`` (struct of the payload columns, all by default), ``component``
    (from 1), ``n``, ``deviation`` (exact; null where it passes 64 bits, then
    ``deviation_text`` still holds it), ``whitened``, ``explained``,
    ``identity_error`` and ``deviation_text``.

    Rows whose vector is null or holds a null or non-finite entry are dropped.
    Vectors of each length are whitened on their own; an empty vector has no
    component, so no row. Where an eigenvalue is zero (few distinct vectors, a
    constant dimension) ``whitened`` is null and ``explained`` 0, or null where all
    variance is. Repeated rows come out alike. An empty table gives no rows.
    """
    inside = rows.select(F.struct(*[F.col(f"`{c}`") for c in payload or rows.columns]).alias("doc"),
                         F.col(vector).cast("array<double>").alias("v"))
    schema = inside.selectExpr("doc", "0 AS dims", "'' AS deviation_text", "array(cast(null AS double)) AS whitened").schema

    def run(batches):
        for batch in batches:
            doc, column = batch.column("doc"), batch.column("v")
            for dims, at, vectors in _by_length(*_numbers(column)):
                made, deviation = models[dims].whiten(integers(vectors))
                flat = pa.array(made.ravel(), pa.float64(), from_pandas=True)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * made.shape[1], pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [doc.take(pa.array(at)), pa.array([dims] * len(at), pa.int32()), pa.array(list(map(str, deviation)), pa.string()), lists],
                    schema.names)

    spark = rows.sparkSession
    facts = [(d, k + 1, m.n, float(e / m.trace) if m.trace > 0 else None, m.identity_error)
             for d, m in models.items() for k, e in enumerate(m.values.tolist())]
    fact = spark.createDataFrame(facts, "dims int, component int, n long, explained double, identity_error double")
    got = inside.mapInArrow(run, schema).select("doc", "dims", "deviation_text", F.posexplode("whitened").alias("k", "whitened"))
    # one row per component of each vector length: what the driver holds, at most 16 each
    got = got.withColumn("component", F.col("k") + 1).join(F.broadcast(fact), ["dims", "component"])
    return got.select("doc", "component", "n", F.expr("try_cast(deviation_text AS bigint)").alias("deviation"), "whitened", "explained",
                      "identity_error", "deviation_text")
