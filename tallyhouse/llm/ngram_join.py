"""N-gram Jaccard join by token-combination prefixes.

Every text is the set of its distinct k-word shingles, hashed to 64 bits. Two
sets link when their Jaccard similarity is at least 75/100.

Shingles have one global order, rare ones first. A set that must share
``o = ceil(0.75 n)`` of its ``n`` shingles is indexed by a prefix of that order
such that any linked set shares an indexed signature: rare shingles are indexed
singly; frequent ones are dealt into groups by hash and indexed by combinations
of two within a group. A prefix that shares no signature can have at most one
common shingle per frequent group, so it is extended until the others are
``n - o + 1``. The number of groups goes with the size band of the larger set
(powers of two); a set near a band's edge is indexed for both bands.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, batch_words, blob, mix, partitions, slices, stored, tidy
from .components import components

WORDS = 5
NUM, DEN = 75, 100
#: Hashed counters that rank shingles by frequency; the order may be any, so
#: their fixed number affects speed only; too few of them for the shingles of a
#: corpus tell rare ones from others no more, and candidates grow faster than it.
COUNTER_BITS = 22
CHUNK = 1 << 16
#: A shingle is frequent when its counter exceeds twice the mean by so much.
FREQUENT = 64
#: Entries that a task holds before it hands them on.
HELD = 1_500_000
BLOCK = 1024
#: Text of one pass; its words and hashes take some fifty bytes a byte.
PASS_BYTES = 1 << 19
#: Sets of one signature up to which all its pairs are candidates as they are.
SMALL = 12
#: Bits of the bitmap of ids that keeps texts out of a join.
FILTER_BITS = 22


def shingle_sets(words: Words, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one after the other, and their
    bounds. Rows with fewer than ``k`` words have one shingle, rows without none."""
    h, first = words.hash, words.first
    last = max(0, len(h) - k + 1)
    window = np.full(last, np.uint64(k))
    for j in range(k):
        window = window * np.uint64(0x9FB21C651E98DF25) + h[j:last + j]
    window = mix(window)
    out, size = [], np.zeros(len(first) - 1, np.int64)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b - a >= k:
            got = np.sort(window[a:b - k + 1])
            if len(got) > 1:
                got = got[np.concatenate(([True], got[1:] != got[:-1]))]
        elif b > a:
            one = np.full(1, np.uint64(b - a))
            for x in h[a:b]:
                one = one * np.uint64(0x9FB21C651E98DF25) + x
            got = mix(one)
        else:
            continue
        out.append(got)
        size[i] = len(got)
    return np.concatenate(out or [np.zeros(0, np.uint64)]), np.concatenate(([0], np.cumsum(size)))


def set_ids(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit id of each set (0 for an empty one): equal sets, equal ids."""
    total = np.concatenate(([np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)))
    n = np.diff(bounds)
    return np.where(n > 0, mix((total[bounds[1:]] - total[bounds[:-1]]) ^ n.astype(np.uint64)), np.uint64(0)).view(np.int64)


def sizes_and_counters(docs: DataFrame) -> DataFrame:
    """One pass over all texts: a row (doc_id, n, id, sketch) per document, and per task
    the hashed counters of its shingles in compressed chunks (chunk, counters). Of
    equal sets that a task meets the first alone has its sketch."""
    def run(batches):
        counters, seen = np.zeros(1 << COUNTER_BITS, np.uint32), set()
        for part in slices(batches, "text", PASS_BYTES):
            hashes, bounds = shingle_sets(batch_words(part, "text", lower=True))
            np.add.at(counters, (hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), np.uint32(1))
            ids, sketches = set_ids(hashes, bounds), []
            for i, a, b in zip(ids.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                sketches.append(None if a == b or i in seen else sketch(hashes[a:b]))
                seen.add(i)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(bounds)), pa.array(ids), pa.array(sketches, pa.binary()),
                                              pa.nulls(part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.binary())],
                                             ["doc_id", "n", "id", "sketch", "chunk", "counters"])
        if counters.any():
            chunks = counters.reshape(-1, CHUNK)
            k = len(chunks)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()),
                 pa.array(np.arange(k, dtype=np.int32)), pa.array([counter_bytes(c) for c in chunks], pa.binary())],
                ["doc_id", "n", "id", "sketch", "chunk", "counters"])

    return docs.mapInArrow(tidy(run), "doc_id long, n long, id long, sketch binary, chunk int, counters binary")


def counter_bytes(counters: np.ndarray) -> bytes:
    """Compressed byte planes of 32-bit counters; all but the lowest are mostly empty."""
    return zlib.compress(blob(np.ascontiguousarray(counters, "<u4").view(np.uint8).reshape(-1, 4).T), 6)


def counters_of(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<u4")[:, 0]


def _rank(counts: np.ndarray) -> np.ndarray:
    """Rank of counts, finer than powers of two."""
    return np.minimum(255, 4 * np.log2(counts + 1)).astype(np.uint8)


def ranks(counted: DataFrame) -> tuple[np.ndarray, int]:
    """Rank of every counter and the least frequent rank. The table has a fixed
    size; tasks add up chunks as they stream by, the driver gets a byte a counter."""
    spark = counted.sparkSession

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[c] = sums.get(c, 0) + counters_of(x).astype(np.uint64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([blob(_rank(s)) for s in sums.values()], pa.binary())],
                                             ["chunk", "ranks"])

    rows = (counted.where("chunk IS NOT NULL").select("chunk", "counters").repartition(partitions(spark), "chunk")
            .mapInArrow(tidy(run), "chunk int, ranks binary").collect())
    rank = np.zeros(1 << COUNTER_BITS, np.uint8)
    for r in rows:
        rank[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["ranks"], np.uint8)
    mean = (counted.where("chunk IS NULL").agg(F.sum("n")).first()[0] or 0) / len(rank)  # each shingle of a set counts once
    return rank, int(_rank(np.array([2 * mean + FREQUENT]))[0]) + 1


def signatures(hashes: np.ndarray, rank: np.ndarray, frequent: int) -> np.ndarray:
    """Signatures of one set (sorted distinct hashes) under the global order."""
    n = len(hashes)
    need = n - -(-NUM * n // DEN) + 1
    order = np.argsort(rank, kind="stable")
    if rank[order[need - 1]] < frequent:
        return mix(hashes[order[:need]])
    rare = int((rank < frequent).sum())
    band = n.bit_length() - 1
    out = [mix(hashes[order[:min(need, rare)]])]
    common = hashes[order[rare:]]
    for b in (band, band + 1):
        if DEN * n < NUM << b:
            continue
        groups = (1 << b) // 4
        salt = mix(np.array([b + 1000], np.uint64))[0]
        if not groups:  # small sets: frequent shingles singly
            out.append(mix(common[:max(0, need - rare)] ^ salt))
            continue
        group = (mix(common ^ salt) % np.uint64(groups)).astype(np.int64)
        counts = np.ones(len(common), np.int64)
        counts[np.unique(group, return_index=True)[1]] = 0
        length = int(np.searchsorted(np.cumsum(counts), need - rare)) + 1
        by = np.argsort(group[:length], kind="stable")
        g, x = group[:length][by], common[:length][by]
        step = 1
        while True:
            i = np.flatnonzero(g[step:] == g[:-step]) if step < len(g) else np.zeros(0, int)
            if not len(i):
                break
            a, c = np.minimum(x[i], x[i + step]), np.maximum(x[i], x[i + step])
            out.append(mix(mix(a ^ salt) ^ c))
            step += 1
    return np.concatenate(out)


def sketch(hashes: np.ndarray) -> bytes:
    """Bitmap of a set with four bits a shingle, rounded to a power of two."""
    bits = 1 << max(6, (4 * len(hashes) - 1).bit_length())
    out = np.zeros(bits, bool)
    out[(hashes & np.uint64(bits - 1)).astype(np.int64)] = True
    return blob(np.packbits(out, bitorder="little"))


_ENTRY = np.dtype([("sig", "<u8"), ("id", "<i8"), ("n", "<i4")])


def packed(entries: np.ndarray) -> bytes:
    """Entries column by column in 18 bytes each: 48 bits of the signature, the id,
    and the byte planes of the size. Signatures that fall together bring more
    candidates, which are compared; no pair is lost."""
    def planes(x):
        return x.view(np.uint8).reshape(len(x), x.itemsize)
    sig, n = planes(entries["sig"] >> np.uint64(16))[:, :6], planes(np.ascontiguousarray(entries["n"]))
    return blob(sig) + blob(entries["id"]) + blob(n.T)


def unpacked(data: bytes) -> np.ndarray:
    k = len(data) // 18
    out = np.zeros(k, _ENTRY)
    raw = np.frombuffer(data, np.uint8)
    sig = np.zeros((k, 8), np.uint8)
    sig[:, :6] = raw[:6 * k].reshape(k, 6)
    out["sig"] = sig.view("<u8")[:, 0]
    out["id"] = raw[6 * k:14 * k].view("<i8")
    out["n"] = np.ascontiguousarray(raw[14 * k:].reshape(4, k).T).view("<i4")[:, 0]
    return out


def indexed(docs: DataFrame, rank: np.ndarray, frequent: int, parts: int) -> DataFrame:
    """Index entries of all texts, packed per part of the signature space: rows
    (part, entries). Equal sets that a task meets are indexed once."""
    shared = docs.sparkSession.sparkContext.broadcast((rank, frequent))

    def run(batches):
        rank, frequent = shared.value
        held, total, seen = [], 0, set()

        def give():
            entries = np.concatenate(held)
            part = (entries["sig"] % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            entries, part = entries[order], part[order]
            cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            blobs = [packed(e) for e in np.split(entries, cut[1:])]
            return pa.RecordBatch.from_arrays([pa.array(part[cut].astype(np.int32)), pa.array(blobs, pa.binary())], ["part", "entries"])

        for piece in slices(batches, "text", PASS_BYTES):
            hashes, bounds = shingle_sets(batch_words(piece, "text", lower=True))
            ids, order = set_ids(hashes, bounds).tolist(), rank[(hashes >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
            for i, a, b in zip(ids, bounds[:-1].tolist(), bounds[1:].tolist()):
                if a == b or i in seen:
                    continue
                seen.add(i)
                sigs = signatures(hashes[a:b], order[a:b], frequent)
                one = np.empty(len(sigs), _ENTRY)
                one["sig"], one["id"], one["n"] = sigs, i, b - a
                held.append(one)
                total += len(one)
            if total >= HELD:
                yield give()
                held, total, seen = [], 0, set()
        if held:
            yield give()

    return docs.mapInArrow(tidy(run), "part int, entries binary")


def shared_signatures(index: DataFrame) -> DataFrame:
    """(sig, id, n, size, times) of every signature that ``size`` sets have, two or more.

    A near copy shares many signatures with the same few sets, so signatures with
    equal lists of sets become one, ``sig`` being a hash of the list and ``times``
    their number. Lists whose hashes collide are compared together: no pair is lost.
    """
    def run(batches):
        held = [unpacked(x) for batch in batches for x in batch.column(1).to_pylist()]
        if not held:
            return
        entries = np.concatenate(held)
        held.clear()
        entries = entries[np.lexsort((entries["id"], entries["sig"]))]
        same = (entries["sig"][1:] == entries["sig"][:-1]) & (entries["id"][1:] == entries["id"][:-1])
        entries = entries[np.concatenate(([True], ~same))]
        same = entries["sig"][1:] == entries["sig"][:-1]
        live = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        entries = entries[live]
        if not len(entries):
            return
        first = np.concatenate(([True], entries["sig"][1:] != entries["sig"][:-1]))
        run_of = np.cumsum(first) - 1
        lists = np.add.reduceat(mix(entries["id"].astype(np.uint64)), np.flatnonzero(first))[run_of]
        size = np.bincount(run_of)[run_of]
        order = np.lexsort((entries["id"], lists))
        entries, lists, size = entries[order], lists[order], size[order]
        first = np.flatnonzero(np.concatenate(([True], (lists[1:] != lists[:-1]) | (entries["id"][1:] != entries["id"][:-1]))))
        times = np.diff(np.append(first, len(entries)))
        entries, lists, size = entries[first], lists[first].view(np.int64), size[first].astype(np.int32)
        for a in range(0, len(entries), 100_000):
            e = entries[a:a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(lists[a:a + 100_000]), pa.array(e["id"].copy()), pa.array(e["n"].copy()),
                                              pa.array(size[a:a + 100_000]), pa.array(times[a:a + 100_000])], ["sig", "id", "n", "size", "times"])

    return (index.repartition(partitions(index.sparkSession), "part")
            .mapInArrow(tidy(run), "sig long, id long, n int, size int, times long").groupBy("sig", "id")
            .agg(F.min("n").alias("n"), F.max("size").alias("size"), F.sum("times").alias("times")))


def _similar(pairs: DataFrame, table: DataFrame, column: str, keep, name: str) -> DataFrame:
    """Pairs (a, b) for which ``keep(x, y, m, n)`` holds of the rows' ``column`` and sizes."""
    left = table.select(F.col("id").alias("a"), F.col("n").alias("m"), F.col(column).alias("x"))
    right = table.select(F.col("id").alias("b"), "n", F.col(column).alias("y"))

    def run(batches):
        for batch in batches:
            c = {k: batch.column(k).to_pylist() for k in ("a", "b", "m", "n", "x", "y")}
            ok = [keep(x, y, m, n) for x, y, m, n in zip(c["x"], c["y"], c["m"], c["n"])]
            at = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], ["a", "b"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "m", "n", "x", "y")
    return stored(joined.mapInArrow(tidy(run), "a long, b long"), name)


def _may_link(x: bytes, y: bytes, m: int, n: int) -> bool:
    """False only if the sets cannot link: every bit of one bitmap that the other
    lacks stands for at least one shingle that the other lacks."""
    if NUM * max(m, n) > DEN * min(m, n):
        return False
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[:len(a) // 2] | a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] | b[len(b) // 2:]
    most = min(m - int(np.bitwise_count(a & ~b).sum()), n - int(np.bitwise_count(b & ~a).sum()))
    return DEN * most >= NUM * (m + n - most)


def _link(x: bytes, y: bytes, m: int, n: int) -> bool:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = np.concatenate((a, b))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return DEN * common >= NUM * (m + n - common)


def verified(pairs: DataFrame, docs: DataFrame, counted: DataFrame, passed: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) of set ids that link: bitmaps rule out what cannot, then the
    sets of the others, and of pairs whose bitmaps have ``passed`` before, are
    built again from their texts and compared. ``pairs`` is a stored table."""
    pairs = _similar(pairs, _sketches(counted, pairs.select(F.explode(F.array("a", "b")).alias("id"))),
                     "sketch", _may_link, "jaccard-candidates")
    if passed is not None:
        pairs = stored(pairs.union(passed).distinct(), "jaccard-open")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = (counted.where("chunk IS NULL AND n > 0").join(nodes, "id").groupBy("id").agg(F.min("doc_id").alias("doc_id"))
              .select("doc_id", F.col("id").alias("want")))

    def run(batches):
        for part in slices(batches, "text"):
            hashes, bounds = shingle_sets(batch_words(part, "text", lower=True))
            ids = set_ids(hashes, bounds)
            # rows that share a doc_id may hold other texts
            at = np.flatnonzero(ids == part.column("want").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), pa.array(np.diff(bounds)[at].astype(np.int32)),
                 pa.array([blob(hashes[bounds[i]:bounds[i + 1]]) for i in at], pa.binary())], ["id", "n", "hashes"])

    wanted = stored(wanted, "jaccard-wanted")
    sets = stored(_perhaps_in(docs, wanted).join(wanted, "doc_id").select("want", "text").mapInArrow(tidy(run), "id long, n int, hashes binary"),
                  "jaccard-sets")
    # one row per set, but where a row is repeated with its doc_id; else the sets need not be shuffled for that
    if not sets.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").isEmpty():
        sets = sets.dropDuplicates(["id"])
    return _similar(pairs, sets, "hashes", _link, "jaccard-links")


def _sketches(counted: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, n, sketch) of each set that is in ``wanted``, and of some that are not."""
    rows = counted.where("sketch IS NOT NULL").select("id", "n", "sketch")
    return _perhaps_in(rows, wanted, "id").dropDuplicates(["id"])


def _perhaps_in(docs: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose hashed ``key`` is in a bitmap of those of ``wanted``, so
    that the join after it need not shuffle the other rows. The bitmap has a
    fixed size (at most 2**FILTER_BITS / 64 rows), so it can be broadcast."""
    def cell(c):
        return F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS))

    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("cell") % 64).cast("int"))
    bitmap = (wanted.select(cell(key).alias("cell")).groupBy(F.floor(F.col("cell") / 64).alias("word"))
              .agg(F.bit_or(bit).alias("bits")))
    return (docs.withColumn("cell", cell(key)).withColumn("word", F.floor(F.col("cell") / 64))
            .join(F.broadcast(bitmap), "word").where(F.col("bits").bitwiseAND(bit) != 0).select(*docs.columns))


def _bits_apart(x: np.ndarray, m: int, many: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether a bitmap leaves open a link with each of many of its length."""
    both = np.bitwise_count(many & x).sum(axis=1, dtype=np.int64)
    most = np.minimum(m - int(np.bitwise_count(x).sum()) + both, n - np.bitwise_count(many).sum(axis=1, dtype=np.int64) + both)
    return DEN * most >= NUM * (m + n - most)


def _open_pairs(live: DataFrame, groups: DataFrame, counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs that share a signature, fit in size and lie in different
    groups so far: those whose bitmaps are still to be compared, and the others.

    Signatures whose sets are all in one group drop out. Those of up to SMALL
    sets give their pairs as they are. Sets of larger ones bring their bitmaps,
    are dealt into blocks, and only pairs that the bitmaps leave open go out: no
    task holds a whole signature, and no pairs of a whole group are made rows.
    """
    entries = (live.join(groups.withColumnRenamed("node", "id"), "id", "left")
               .select("sig", "id", "n", F.coalesce("component", "id").alias("group")))
    entries = stored(entries, "jaccard-entries")
    mixed = stored(entries.groupBy("sig").agg(F.count("*").alias("size"), F.min("group").alias("lo"), F.max("group").alias("hi"))
                   .where("lo <> hi").select("sig", "size"), "jaccard-mixed")
    small = entries.join(mixed.where(F.col("size") <= SMALL), "sig").withColumn("sketch", F.lit(None).cast("binary"))
    large = stored(entries.join(mixed.where(F.col("size") > SMALL), "sig"), "jaccard-large")
    large = large.join(_sketches(counted, large.select("id")).drop("n"), "id")
    return (stored(_cell_pairs(small).distinct(), "jaccard-small-pairs"), stored(_cell_pairs(large).distinct(), "jaccard-large-pairs"))


def _cell_pairs(entries: DataFrame) -> DataFrame:
    """Pairs (a, b) of one signature, block by block, from (sig, id, n, group, size, sketch)."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    cells = (entries.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("sig", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "block", "id", "n", "group",
                     "sketch"))
    cells = cells.repartition(partitions(entries.sparkSession), "sig", "lo", "hi").sortWithinPartitions("sig", "lo", "hi", "n")

    def run(batches):
        held: list[np.ndarray] = []

        def give():
            both = np.unique(np.concatenate(held), axis=0)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])

        total = 0
        for rows, maps in _cell_runs(batches):
            block, ids, n, group = rows[:, 3], rows[:, 4], rows[:, 5], rows[:, 6]
            same = rows[0, 1] == rows[0, 2]
            by_size = _stacked(maps)
            for i in range(len(rows) - 1):  # sorted by size: partners follow and are at most 4/3 as large
                end = int(np.searchsorted(n, DEN * n[i] // NUM, "right"))
                j = np.arange(i + 1, end)
                j = j[group[j] != group[i]]
                if not same:
                    j = j[block[j] != block[i]]
                if by_size is not None and len(j):
                    j = _open_partners(i, j, n, by_size)
                if len(j):
                    held.append(np.stack((np.minimum(ids[j], ids[i]), np.maximum(ids[j], ids[i])), axis=1))
                    total += len(j)
            if total > 500_000:
                yield give()
                total = 0
        if held:
            yield give()

    return cells.mapInArrow(tidy(run), "a long, b long")


def _stacked(maps: list) -> tuple | None:
    """Bitmaps of equal length as matrices: length of each row, its place, matrices."""
    if maps[0] is None:
        return None
    length = np.fromiter(map(len, maps), np.int64, len(maps))
    place, stack = np.zeros(len(maps), np.int64), {}
    for size in np.unique(length).tolist():
        at = np.flatnonzero(length == size)
        place[at] = np.arange(len(at))
        stack[size] = np.frombuffer(b"".join(maps[i] for i in at.tolist()), np.uint8).reshape(len(at), size)
    return length, place, stack


def _open_partners(i: int, j: np.ndarray, n: np.ndarray, by_size: tuple) -> np.ndarray:
    length, place, stack = by_size
    out = []
    for size in np.unique(length[j]).tolist():
        at = j[length[j] == size]
        x, many = stack[int(length[i])][place[i]], stack[size][place[at]]
        while len(x) < many.shape[1]:
            half = many.shape[1] // 2
            many = many[:, :half] | many[:, half:]
        while len(x) > many.shape[1]:
            x = x[:len(x) // 2] | x[len(x) // 2:]
        out.append(at[_bits_apart(x, int(n[i]), many, n[at])])
    return np.concatenate(out)


def _cell_runs(batches):
    """Rows and bitmaps of each run of equal (sig, lo, hi); at most two blocks long."""
    key, parts, maps = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns[:-1]], axis=1)
        sketches = batch.columns[-1].to_pylist()
        cut = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(rows)]):
            here = tuple(rows[a, :3].tolist())
            if parts and here != key:
                yield np.concatenate(parts), maps
                parts, maps = [], []
            key = here
            parts.append(rows[a:b])
            maps = maps + sketches[a:b] if maps else sketches[a:b]
    if parts:
        yield np.concatenate(parts), maps


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of documents linked by Jaccard similarity of 5-word shingles, 75 % or more.

    Returns one row per document: ``doc_id``, ``n_shingles``, ``component_id``
    (smallest doc_id reachable by links, itself included).

    A-Z is lower-cased; a text with fewer than five words is one shingle; null,
    empty and wordless texts, and rows without id, link with nothing. Equal sets
    are one node from the start, so groups of copies cost one comparison. Two
    passes of candidates: every set with the set that its signatures point to
    most, then the pairs that those links have left in different groups;
    no candidate is dropped unless a bound proves it apart. Repeated rows are
    copies; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = stored(sizes_and_counters(docs), "jaccard-sizes")
    rank, frequent = ranks(counted)
    parts = 4 * partitions(spark)
    usable = docs.where("doc_id IS NOT NULL")
    # the entries are many times the rest: they are shuffled once, and not stored before
    live = stored(shared_signatures(indexed(usable, rank, frequent, parts)), "jaccard-live")
    # an original shares all its signatures with its copies, which differ from
    # one another: per signature, the set whose signatures are most shared
    weight = live.groupBy("id").agg(F.sum(F.col("size") * F.col("times")).alias("weight"))
    pivots = stored(live.join(stored(weight, "jaccard-weights"), "id").groupBy("sig")
                    .agg(F.max(F.struct("weight", "id", "n")).alias("best"))
                    .select("sig", F.col("best.id").alias("a"), F.col("best.n").alias("m")), "jaccard-pivots")
    fits = DEN * F.least("n", "m").cast("long") >= NUM * F.greatest("n", "m").cast("long")
    stars = live.join(pivots, "sig").where(fits & (F.col("id") != F.col("a"))).groupBy("id", "a").agg(F.sum("times").alias("shared"))
    # the pivot that a set shares most signatures with; the second pass sees to the rest
    stars = stars.groupBy("id").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", F.col("id").alias("b"))
    links = verified(stored(stars, "jaccard-stars"), usable, counted)
    groups = stored(components(links.withColumnRenamed("a", "u").withColumnRenamed("b", "v")), "jaccard-groups")
    small, large = _open_pairs(live, groups, counted)
    more = verified(small, usable, counted, large)
    links = links.union(more).select(F.col("a").alias("u"), F.col("b").alias("v"))
    groups = stored(components(links).withColumnRenamed("node", "id"), "jaccard-groups")

    rows = counted.where("chunk IS NULL").select("doc_id", F.col("n").alias("n_shingles"), "id")
    least = (rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("id").agg(F.min("doc_id").alias("least"))
             .join(groups, "id", "left").withColumn("component", F.coalesce("component", "id")))
    least = stored(least, "jaccard-least")
    found = stored(least.join(least.groupBy("component").agg(F.min("least").alias("component_id")), "component")
                   .select("id", "component_id"), "jaccard-components")
    linked = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").join(found, "id").select("doc_id", "n_shingles", "component_id")
    alone = (rows.where("n_shingles = 0 OR doc_id IS NULL")
             .select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return linked.union(alone)
