"""Embedding near-duplicates by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blob, mix, partitions, stored
from .components import components

MIN_COSINE = 0.98
#: Hash tables, polytopes per table, and buckets per vector and table (the own
#: one and the next best, multiprobe).
TABLES = 5
POLYTOPES = 2
PROBES = 3
#: Rows of a block; buckets beyond it are compared block by block.
BLOCK = 512
SEED = 20250


@lru_cache(maxsize=8)
def _signs(width: int) -> np.ndarray:
    """Random diagonal signs: tables x polytopes x 3 rotations x width."""
    return np.random.default_rng(SEED + width).choice([-1.0, 1.0], (TABLES, POLYTOPES, 3, width))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows (width a power of two), scaled to keep lengths."""
    width, h = x.shape[1], 1
    while h < width:
        y = x.reshape(len(x), -1, 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(len(x), width)
        h *= 2
    return x / np.sqrt(width)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest part first, so that tiny
    and huge values survive."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), np.finfo(float).tiny)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bucket_keys(x: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Keys of the buckets of unit rows: rows x TABLES x PROBES.

    Per table, the nearest vertices (largest coordinate and its sign) of
    POLYTOPES rotations make the own bucket; further probes replace the vertex
    whose second choice is nearest to its first.
    """
    n, d = x.shape
    width = 1 << max(1, (d - 1).bit_length())
    if width > d:
        x = np.concatenate((x, np.zeros((n, width - d))), axis=1)
    signs = _signs(width)
    out = np.empty((n, TABLES, PROBES), np.uint64)
    at = np.arange(n)
    for t in range(TABLES):
        best, loss, other = [], [], []
        for p in range(POLYTOPES):
            y = x
            for r in range(3):
                y = hadamard(y * signs[t, p, r])
            size = np.abs(y)
            order = np.argpartition(-size, PROBES - 1, axis=1)[:, :PROBES] if width > PROBES else np.argsort(-size, axis=1)[:, :PROBES]
            order = np.take_along_axis(order, np.argsort(-np.take_along_axis(size, order, 1), axis=1, kind="stable"), 1)
            code = order * 2 + (np.take_along_axis(y, order, 1) < 0)
            best.append(code[:, 0])
            for k in range(1, order.shape[1]):
                loss.append(size[at, order[:, 0]] - size[at, order[:, k]])
                other.append((p, code[:, k]))
        ranked = np.argsort(np.stack(loss, 1), axis=1, kind="stable")
        for k in range(PROBES):
            codes = [b.copy() for b in best]
            if k:
                pick = ranked[:, k - 1]
                for i, (p, c) in enumerate(other):
                    codes[p] = np.where(pick == i, c, codes[p])
            key = mix(group ^ np.uint64(t + 1))
            for c in codes:
                key = mix(key ^ c.astype(np.uint64))
            out[:, t, k] = key
    return out


def hashed(vectors: DataFrame) -> DataFrame:
    """``rep``, ``n``, ``vector`` (doubles) and ``keys`` of distinct vectors."""
    def run(batches):
        for batch in batches:
            labels = batch.column("label").to_numpy()
            column = batch.column("embedding")
            size = np.asarray(column.value_lengths())
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                part = column.take(pa.array(at))
                x = unit(part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), int(d)))
                keys = bucket_keys(x, mix(labels[at].astype(np.uint64)) ^ np.uint64(d))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").take(pa.array(at)), batch.column("n").take(pa.array(at)),
                     pa.array([blob(r) for r in x], pa.binary()),
                     pa.array(list(keys.reshape(len(at), -1).view(np.int64)), pa.list_(pa.int64()))],
                    ["rep", "n", "vector", "keys"])

    return vectors.select("rep", "n", F.xxhash64("label").alias("label"), "embedding").mapInArrow(
        run, "rep long, n long, vector binary, keys array<long>")


def _linked(cell: dict, same: bool, least: float):
    """Pairs of a cell with cosine ``least`` or more: indices i, j, and whether this
    bucket is the first that both rows share (so that a pair counts once)."""
    x, block, keys, bucket = cell["x"], cell["block"], cell["keys"], cell["bucket"]
    left = np.flatnonzero(block == block.min())
    right = left if same else np.flatnonzero(block != block.min())
    cosine = np.clip(x[left] @ x[right].T, -1, 1)
    i, j = np.nonzero(cosine >= least)
    i, j = left[i], right[j]
    if same:
        i, j = i[i < j], j[i < j]
    first = np.zeros(len(i), bool)
    for a in range(0, len(i), 50_000):
        p, q = keys[i[a:a + 50_000]], keys[j[a:a + 50_000]]
        met = (p[:, :, :, None] == q[:, :, None, :]).any(axis=3)  # pair x table x probe of p
        common = np.where(met.reshape(len(p), -1), p.reshape(len(p), -1), np.iinfo(np.int64).max)
        first[a:a + 50_000] = common.min(axis=1) == bucket
    return i, j, first


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    least: float = MIN_COSINE) -> DataFrame:
    """Groups of vectors of one label linked by cosine ``least`` or more.

    Returns one row per vector: ``vec_id``, ``n_links`` (other rows linked
    directly), ``component_id`` (smallest id reachable), ``kept``.

    Equal vectors of a label are reduced to one with a count first. Pairs are
    searched in shared buckets only and verified in double precision; large
    buckets are compared in blocks of bounded size, pairs stay inside their
    task, and only sums and a star of links per block leave it.

    Labels may be of any type that can be grouped by; only their equality counts.

    Vectors that are null, empty, zero or hold null or non-finite parts, and
    rows with null label or id, link with nothing; vectors of different length
    neither. Repeated rows count as copies. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).alias("label"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
              & finite & F.exists("embedding", lambda v: v != 0))
    usable = F.coalesce(usable, F.lit(False))
    reps = stored(rows.where(usable).groupBy("label", "embedding")
                  .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vector-reps")
    table = stored(hashed(reps), "vector-keys")

    slim = table.select("rep", F.explode(F.array_distinct("keys")).alias("bucket"))
    sizes = stored(slim.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "vector-buckets")
    live = slim.join(sizes, "bucket")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    live = (live.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("rep", "bucket", "block", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi")))
    cells = (live.join(table, "rep").repartition(partitions(spark), "bucket", "lo", "hi")
             .sortWithinPartitions("bucket", "lo", "hi", "rep"))

    def run(batches):
        held: dict | None = None
        for key, part in _runs(batches, ("bucket", "lo", "hi")):
            held = {"bucket": key[0], "block": part["block"], "keys": part["keys"], "x": part["x"]}
            if len(part["rep"]) < 2 or (key[1] != key[2] and len(set(part["block"].tolist())) < 2):
                continue
            i, j, first = _linked(held, key[1] == key[2], least)
            if not len(i):
                continue
            rep, n = part["rep"], part["n"]
            links = np.zeros(len(rep), np.int64)
            np.add.at(links, i[first], n[j[first]])
            np.add.at(links, j[first], n[i[first]])
            root = _local_roots(len(rep), i, j)
            used = np.unique(np.concatenate((i, j)))
            yield pa.RecordBatch.from_arrays([pa.array(rep[used]), pa.array(links[used]), pa.array(rep[root[used]])],
                                             ["rep", "links", "root"])

    found = stored(cells.mapInArrow(run, "rep long, links long, root long"), "vector-links")
    joined = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    degree = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = stored(reps.join(degree, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                           F.coalesce("component", "rep").alias("component_id")), "vector-classes")
    good = rows.where(usable).join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the pairs, per index (rows are sorted by id)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    keys = batch.column("keys")
    return {"rep": batch.column("rep").to_numpy(), "n": batch.column("n").to_numpy(), "block": batch.column("block").to_numpy(),
            "keys": keys.flatten().to_numpy().reshape(batch.num_rows, TABLES, PROBES),
            "vector": np.array(batch.column("vector").to_pylist(), object)}


def _runs(batches, names):
    """(key, columns) of each run of equal keys in sorted batches; a run may
    cross batches and is at most two blocks long."""
    key, parts = None, []

    def done():
        out = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        out["x"] = np.stack([np.frombuffer(v, np.float64) for v in out.pop("vector")])
        return key, out

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names], axis=1)
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        columns = _columns(batch)
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
            here = tuple(keys[a].tolist())
            if key is not None and here != key:
                yield done()
                parts = []
            key = here
            parts.append({c: v[a:b] for c, v in columns.items()})
    if parts:
        yield done()
