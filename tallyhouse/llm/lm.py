"""Language-model scores from a log-frequency Bloom filter of bigram counts.

All texts become blocks of token numbers, built anew in each of three passes (a
stored copy would take as much disk as the texts) and named by their content,
so that a block that came out otherwise the second time is an error, never a
wrong count. Exact unigram counts travel between blocks and hash parts
pre-aggregated per block, so a frequent word costs one entry per block. Bigrams travel the same way: each block sends its
distinct ones to their hash part, which builds one segment of the filter, where a
bigram of count c is entered at levels 1 to ``1 + floor(log2 c)``, and sends back
the level of each, found by probing level after level until one is missing. The
filter grows with the training tokens and is never in one place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, blob, mix, partitions, slices, stored, text_buffer

#: Additive smoothing of the unigrams.
ADDED = 0.1
#: Weight of the bigram estimate against the unigram.
BIGRAM_WEIGHT = 0.5
#: Bits per training token.
BITS_PER_TOKEN = 6
HASHES = 3
#: Share of a segment's bits that may be set; a segment that needs more is longer.
LOAD = 0.6
_END = np.uint64(0x1B873593CC9E2D51)


def blocks(docs: DataFrame, text: str, held_out: Column, payload: list[str]) -> DataFrame:
    """Token blocks: ``docs`` (array of payload structs), ``held`` (a byte per row),
    ``ends`` (int32 per row), ``tokens`` (numbers into ``words``), ``words``
    (sorted distinct 64-bit hashes), ``seen`` (int32 training count of each), and
    ``block``, a hash of words, counts and bigrams."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in payload]).alias("doc"), F.col(text).cast("string").alias("text"),
                       held_out.alias("held"))
    schema = rows.select(F.array("doc").alias("docs"), *[F.lit(b"").alias(c) for c in ("held", "ends", "tokens", "words", "seen")],
                         F.lit(0).cast("long").alias("block")).schema

    def run(batches):
        for part in slices(batches, "text"):
            words = Words(*text_buffer(part.column("text")), lower=True)
            n, count = part.num_rows, words.counts()
            ends = np.cumsum(count + 1)
            token = np.empty(int(ends[-1]), np.uint64)
            is_end = np.zeros(len(token), bool)
            is_end[ends - 1] = True
            token[is_end] = _END
            token[~is_end] = words.hash
            held = part.column("held").to_numpy(zero_copy_only=False).astype(bool)
            unique, number = np.unique(token, return_inverse=True)
            seen = np.bincount(number[~np.repeat(held, count + 1)], minlength=len(unique))
            small = np.uint16 if len(unique) <= 1 << 16 else np.uint32
            name = mix(np.concatenate((unique + mix(seen.astype(np.uint64)), _pairs(number, unique, ends)))).sum()
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column("doc")), *[pa.array([blob(x)], pa.binary()) for x in (
                    held, ends.astype(np.int32), number.astype(small), unique, seen.astype(np.int32))],
                 pa.array([int(name.view(np.int64))], pa.int64())], schema.names)

    return rows.mapInArrow(run, schema)


def _numbers(tokens: bytes, words: bytes) -> np.ndarray:
    return np.frombuffer(tokens, np.uint16 if len(words) // 8 <= 1 << 16 else np.uint32)


def _by_part(batches):
    """(part, rows) of each run of batches sorted by their first column."""
    part, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if held and row[0] != part:
                yield part, held
                held = []
            part = row[0]
            held.append(row[1:])
    if held:
        yield part, held


def _first(blocks: list[int]) -> list[int]:
    """Places of the first row of each block: equal blocks have equal answers, and one does for all."""
    return np.unique(np.array(blocks, np.int64), return_index=True)[1].tolist()


def _split(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order of the hashes by part, the parts present, and their bounds."""
    part = (hashes % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    found, first = np.unique(part[order], return_index=True)
    return order, found, np.append(first, len(order))


def _gathered(hashes: np.ndarray, parts: int, answers: list, name: str, kind) -> np.ndarray:
    """What the parts answered for each of a block's hashes."""
    order, found, cut = _split(hashes, parts)
    out = np.empty(len(hashes), kind)
    place = {p: k for k, p in enumerate(found.tolist())}
    got = [a for a in answers if a[name] is not None]
    if {a["part"] for a in got} != set(place):
        raise ValueError("a block of texts came out otherwise when it was built again")
    for a in got:
        k = place[a["part"]]
        out[order[cut[k]:cut[k + 1]]] = np.frombuffer(a[name], kind)
    return out


def unigrams(table: DataFrame, parts: int) -> DataFrame:
    """Rows (block, part, counts): exact training counts of a block's words of the
    part, in hash order; and a row per part with ``total`` and ``distinct``."""
    def send(batches):
        for batch in batches:
            for block, words, seen in zip(*[c.to_pylist() for c in batch.columns]):
                words, seen = np.frombuffer(words, np.uint64), np.frombuffer(seen, np.int32)
                order, found, cut = _split(words, parts)
                w, s = words[order], seen[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.astype(np.int32)), pa.array(np.full(len(found), block)),
                     pa.array([blob(w[a:b]) for a, b in zip(cut, cut[1:])], pa.binary()),
                     pa.array([blob(s[a:b]) for a, b in zip(cut, cut[1:])], pa.binary())], ["part", "block", "words", "seen"])

    def count(batches):
        for part, rows in _by_part(batches):
            size = [len(w) // 8 for _, w, _ in rows]
            words = np.frombuffer(b"".join(w for _, w, _ in rows), np.uint64)
            seen = np.frombuffer(b"".join(s for _, _, s in rows), np.int32)
            unique, number = np.unique(words, return_inverse=True)
            total = np.zeros(len(unique), np.int64)
            np.add.at(total, number, seen)
            counts = np.split(total[number], np.cumsum(size)[:-1])
            once = _first([b for b, _, _ in rows])
            k = len(once)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[i][0] for i in once] + [None], pa.int64()), pa.array([part] * (k + 1), pa.int32()),
                 pa.array([blob(counts[i]) for i in once] + [None], pa.binary()), pa.array([None] * k + [int(total.sum())], pa.int64()),
                 pa.array([None] * k + [int((total > 0).sum())], pa.int64())], ["block", "part", "counts", "total", "distinct"])

    spark = table.sparkSession
    sent = table.select("block", "words", "seen").mapInArrow(send, "part int, block long, words binary, seen binary")
    return (sent.repartition(partitions(spark), "part").sortWithinPartitions("part")
            .mapInArrow(count, "block long, part int, counts binary, total long, distinct long"))


def _pairs(number: np.ndarray, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every token with the one before it; the end token stands before a
    text's first."""
    h = words[number]
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[0] = _END
    before[ends[:-1]] = _END
    return mix(before * np.uint64(0x9FB21C651E98DF25) + h)


def _places(short: np.ndarray, level: int, bits: int):
    """Bits of 32-bit hashes at a level, one array per hash function."""
    h = mix(short.astype(np.uint64) ^ (np.uint64(level) << np.uint64(40)))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(0xFFFFFFFF)) * np.uint64(bits) >> np.uint64(32) for i in range(HASHES)]


def levels(table: DataFrame, parts: int, bits: int) -> DataFrame:
    """Rows (block, part, levels): the filter's level of each of a block's distinct
    bigrams of the part, a byte each in order of :func:`_split`. A part's segment
    has ``bits`` bits, or more where its bigrams need them."""
    def send(batches):
        for batch in batches:
            for block, held, ends, tokens, words in zip(*[c.to_pylist() for c in batch.columns]):
                number, words = _numbers(tokens, words), np.frombuffer(words, np.uint64)
                ends, held = np.frombuffer(ends, np.int32), np.frombuffer(held, bool)
                unique, again = np.unique(_pairs(number, words, ends), return_inverse=True)
                count = np.bincount(again[~np.repeat(held, np.diff(ends, prepend=0))], minlength=len(unique))
                order, found, cut = _split(unique, parts)
                short, count = (unique[order] >> np.uint64(32)).astype(np.uint32), count[order]
                # most bigrams of a block are single: they go without a count
                once = [count[a:b] == 1 for a, b in zip(cut, cut[1:])]
                pieces = [(short[a:b], count[a:b]) for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.astype(np.int32)), pa.array(np.full(len(found), block)),
                     pa.array([blob(s[o]) for (s, _), o in zip(pieces, once)], pa.binary()),
                     pa.array([blob(s[~o]) for (s, _), o in zip(pieces, once)], pa.binary()),
                     pa.array([blob(c[~o].astype(np.uint32)) for (_, c), o in zip(pieces, once)], pa.binary()),
                     pa.array([blob(np.packbits(o)) for o in once], pa.binary())],
                    ["part", "block", "single", "short", "count", "once"])

    def answer(batches):
        for part, rows in _by_part(batches):
            single = np.frombuffer(b"".join(r[1] for r in rows), np.uint32)
            short = np.frombuffer(b"".join(r[2] for r in rows), np.uint32)
            count = np.frombuffer(b"".join(r[3] for r in rows), np.uint32)
            unique, number = np.unique(np.concatenate((single, short)), return_inverse=True)
            total = np.bincount(number, np.concatenate((np.ones(len(single)), count)), len(unique)).astype(np.int64)
            segment = Segment(unique[total > 0], total[total > 0], bits)
            level = segment.levels(unique)[number]
            at, more, backs = 0, len(single), []
            for _, s, m, _, packed in rows:
                s, m = len(s) // 4, len(m) // 4
                once = np.unpackbits(np.frombuffer(packed, np.uint8), count=s + m).astype(bool)
                back = np.empty(s + m, np.uint8)
                back[once], back[~once] = level[at:at + s], level[more:more + m]
                at, more = at + s, more + m
                backs.append(blob(back))
            first = _first([r[0] for r in rows])
            yield pa.RecordBatch.from_arrays([pa.array([rows[i][0] for i in first], pa.int64()), pa.array([part] * len(first), pa.int32()),
                                              pa.array([backs[i] for i in first], pa.binary())], ["block", "part", "levels"])

    spark = table.sparkSession
    sent = (table.select("block", "held", "ends", "tokens", "words")
            .mapInArrow(send, "part int, block long, single binary, short binary, count binary, once binary"))
    return (sent.repartition(partitions(spark), "part").sortWithinPartitions("part")
            .mapInArrow(answer, "block long, part int, levels binary"))


class Segment:
    """A hash part's share of the filter."""

    def __init__(self, short: np.ndarray, count: np.ndarray, bits: int):
        level = np.floor(np.log2(count)).astype(np.int64) + 1
        self.bits = max(bits, int(np.ceil(HASHES * level.sum() / -np.log1p(-LOAD))))
        self.data = np.zeros(self.bits, bool)
        for j in range(1, int(level.max(initial=0)) + 1):
            for place in _places(short[level >= j], j, self.bits):
                self.data[place.astype(np.int64)] = True

    def levels(self, short: np.ndarray) -> np.ndarray:
        """Probes go up the levels until one is missing."""
        level = np.zeros(len(short), np.uint8)
        alive = np.arange(len(short))
        for j in range(1, 64):
            found = np.ones(len(alive), bool)
            for place in _places(short[alive], j, self.bits):
                found &= self.data[place.astype(np.int64)]
            alive = alive[found]
            if not len(alive):
                break
            level[alive] = j
        return level


def counts(level: np.ndarray) -> np.ndarray:
    """Estimated counts: the middle of the level's range."""
    level = level.astype(np.int64)
    return np.where(level > 0, (1.5 * 2.0 ** (level - 1)).clip(1.0) - 0.5 * (level > 1), 0.0)


def score(docs: DataFrame, held_out: Column, text: str = "text", payload: list[str] | None = None) -> DataFrame:
    """Score every text under a unigram base and the bigram model.

    Trains on the rows where ``held_out`` is false (null counts as true). Returns
    ``doc`` (struct of the payload columns, all by default), ``held_out``,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10).

    Tokens are the words, A-Z lower-cased, and one end per text; a null or empty
    text is its end. ``score`` sums ``log10(w * min(c(uv), c(u)) / c(u) + (1-w) *
    p(v))`` with bigram counts from the filter, unigram counts exact, and ``p`` the
    additive unigram of the base. Repeated rows count as often as they occur.
    Without training rows every count is 0. An empty table gives no rows.
    """
    spark = docs.sparkSession
    payload = payload or docs.columns
    held = F.coalesce(held_out, F.lit(True))
    table = blocks(docs, text, held, payload)
    parts = 4 * partitions(spark)
    counted = stored(unigrams(table, parts), "lm-unigrams")
    sums = counted.agg(F.sum("total"), F.sum("distinct")).first()
    total, distinct = int(sums[0] or 0), int(sums[1] or 0)
    whole = 1 << max(20, (BITS_PER_TOKEN * total).bit_length())
    bits = max(64, whole // parts // 8 * 8)
    back = (counted.where("block IS NOT NULL").select("block", "part", "counts", F.lit(None).cast("binary").alias("levels"))
            .unionByName(levels(table, parts, bits).select("block", "part", F.lit(None).cast("binary").alias("counts"), "levels")))
    answers = back.groupBy("block").agg(F.collect_list(F.struct("part", "counts", "levels")).alias("answers"))
    joined = table.join(answers, "block", "left").select("docs", "held", "ends", "tokens", "words", "answers")
    empty = docs.select(F.struct(*[F.col(f"`{c}`") for c in payload]).alias("doc"))
    schema = empty.select("doc", F.lit(True).alias("held_out"), *[F.lit(0).cast("long").alias(c) for c in ("n_tokens", "n_known", "train_tokens")],
                          *[F.lit(0.0).alias(c) for c in ("base_score", "score")]).schema
    floor = total + ADDED * (distinct + 1)

    def run(batches):
        for batch in batches:
            column = batch.column(0)
            cells = zip(*[batch.column(i).to_pylist() for i in range(1, 6)])
            for i, (held, ends, tokens, words, answers) in enumerate(cells):
                number, words = _numbers(tokens, words), np.frombuffer(words, np.uint64)
                ends = np.frombuffer(ends, np.int32)
                if answers is None:
                    raise ValueError("a block of texts came out otherwise when it was built again")
                unique, again = np.unique(_pairs(number, words, ends), return_inverse=True)
                count = _gathered(words, parts, answers, "counts", np.int64)
                p = (count + ADDED) / floor
                own = p[number]
                both = counts(_gathered(unique, parts, answers, "levels", np.uint8))[again]
                c = count[number]
                before = np.empty_like(c)
                before[1:] = c[:-1]
                before[0] = before[ends[:-1]] = count[np.searchsorted(words, _END)]
                chance = np.minimum(both, before) / np.maximum(before, 1)
                mixed = np.log10(BIGRAM_WEIGHT * chance + (1 - BIGRAM_WEIGHT) * own)
                start = np.concatenate(([0], ends[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [column.slice(i, 1).flatten(), pa.array(np.frombuffer(held, bool)), pa.array(np.diff(ends, prepend=0).astype(np.int64)),
                     pa.array(np.add.reduceat((c > 0).astype(np.int64), start)), pa.array(np.full(len(ends), total)),
                     pa.array(np.add.reduceat(np.log10(own), start)), pa.array(np.add.reduceat(mixed, start))], schema.names)

    return joined.mapInArrow(run, schema)
