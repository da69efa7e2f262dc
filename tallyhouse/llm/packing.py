"""Packing documents into token sequences along a Hilbert curve of their contents."""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, blob, mix, partitions, slices, stored, text_buffer, tidy

SEQUENCE = 2048
#: Id that ends every document.
END_ID = 1
#: Dimensions of the projected document vectors, and bits kept of each.
DIMENSIONS = 4
BITS = 8
#: Pieces whose ids a worker remembers; the memory starts anew beyond it.
REMEMBERED = 2_000_000
#: Words that are encoded in one line.
LINE = 500
#: Lines or pieces that are encoded at once; an encoding takes far more than its ids.
ENCODED = 256
#: Text of one pass; its words, hashes and ids take some fifty bytes a byte.
PASS_BYTES = 1 << 19

# 1: ASCII letters and digits, 2: ASCII punctuation apart from ' < | >
_KIND = np.zeros(256, np.uint8)
_KIND[[c for c in range(128) if chr(c).isalnum()]] = 1
_KIND[[ord(c) for c in '!"#$%&()*+,-./:;=?@[\\]^_`{}~']] = 2



@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _word_end(path: str) -> np.ndarray:
    """Whether an id ends a word."""
    vocabulary = _tokenizer(path).get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return out


def pieces(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words cut further where the tokenizer always cuts: between an ASCII letter
    or digit and ASCII punctuation that no contraction or special token uses.
    Letters are lower-cased as the tokenizer does, where no combining mark
    follows and the slice holds no special token; fewer pieces are distinct."""
    kind = _KIND[data]
    split = np.zeros(len(data), bool)
    split[1:] = (kind[1:] | kind[:-1]) == 3
    if len(data) and not ((data[:-1] == 0x3C) & (data[1:] == 0x7C)).any():
        upper = (data >= 65) & (data <= 90)
        upper[:-1] &= (data[1:] != 0xCC) & (data[1:] != 0xCD)
        data = data + upper.astype(np.uint8) * np.uint8(32)
    return Words(data, offsets, lower=False, split=split)


class WordIds:
    """Token ids of pieces of text. The tokenizer drops white space and never
    joins across it or the cuts of :func:`pieces`, so a text's ids are its
    pieces' ids in order; each distinct piece is encoded once and remembered,
    in arrays sorted by hash."""

    def __init__(self, path: str):
        self.path = path
        self._clear()

    def _clear(self) -> None:
        self.keys, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint16)

    def _learn(self, words: Words, keys: np.ndarray, at: np.ndarray) -> None:
        if len(self.keys) > REMEMBERED:
            self._clear()
        data = words.data.tobytes()
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(words.start[at].tolist(), words.end[at].tolist())]
        # letters alone are one word of the tokenizer, whose last id says so:
        # they go in by the line; the rest go one by one
        plain = np.fromiter((t.lower().isalpha() and t.isalpha() for t in texts), bool, len(texts))
        order = np.argsort(~plain, kind="stable")
        keys, n = keys[order], int(plain.sum())
        texts = [texts[i] for i in order.tolist()]
        lined = [" ".join(texts[i:min(n, i + LINE)]) for i in range(0, n, LINE)]
        flat, size = self._ids(lined)
        ends = np.flatnonzero(_word_end(self.path)[flat]) + 1
        if len(ends) != n:
            raise ValueError("the tokenizer cuts words of letters")
        flat_rest, size_rest = self._ids(texts[n:])
        flat, size = np.concatenate((flat, flat_rest)), np.concatenate((np.diff(ends, prepend=0), size_rest))
        keys = np.concatenate((self.keys, keys))
        order = np.argsort(keys)
        self.begin = np.concatenate((self.begin, len(self.flat) + np.cumsum(size) - size))[order]
        self.size, self.keys = np.concatenate((self.size, size))[order], keys[order]
        self.flat = np.concatenate((self.flat, flat))

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, size = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        for at in range(0, len(texts), ENCODED):
            got = [e.ids for e in _tokenizer(self.path).encode_batch_fast(texts[at:at + ENCODED], add_special_tokens=False)]
            size.append(np.fromiter(map(len, got), np.int64, len(got)))
            flat.append(np.fromiter(chain.from_iterable(got), np.uint16, int(size[-1].sum())))
        return np.concatenate(flat), np.concatenate(size)

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of a slice in order, and ids per word."""
        if not len(words.hash):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        keys, at, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        if len(self.keys):
            new = self.keys[np.minimum(place, len(self.keys) - 1)] != keys
        if new.any():
            if len(self.keys) > REMEMBERED:
                new[:] = True  # the memory starts anew
            self._learn(words, keys[new], at[new])
            place = np.searchsorted(self.keys, keys)
        per_word = self.size[place][inverse]
        ends = np.cumsum(per_word)
        from_ = np.repeat(self.begin[place][inverse] - (ends - per_word), per_word)
        return self.flat[from_ + np.arange(int(ends[-1]))], per_word


@lru_cache(maxsize=2)
def _memory(path: str) -> WordIds:
    """One memory per Python worker, which serves many tasks."""
    return WordIds(path)


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer points (rows, below ``2**bits``) along the Hilbert curve.

    Gray-code rotation of each bit plane from the highest down; at most 63 bits
    in all.
    """
    x = [points[:, d].astype(np.int64) for d in range(points.shape[1])]
    n = len(x)
    plane = 1 << (bits - 1)
    while plane > 1:
        low = plane - 1
        for d in range(n):
            high = (x[d] & plane) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap
        plane >>= 1
    for d in range(1, n):
        x[d] = x[d] ^ x[d - 1]
    flip = np.zeros_like(x[0])
    plane = 1 << (bits - 1)
    while plane > 1:
        flip = np.where((x[n - 1] & plane) != 0, flip ^ (plane - 1), flip)
        plane >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(n):
            key = (key << 1) | (((x[d] ^ flip) >> b) & 1)
    return key


def project(words: Words, dimensions: int = DIMENSIONS, bits: int = BITS) -> np.ndarray:
    """Hashed word vectors of the rows of a slice projected to few dimensions:
    each word adds +1 or -1 to each, by bits of its hash; scaled by the square
    root of the words and cut into ``2**bits`` cells."""
    n_rows = len(words.first) - 1
    count = np.maximum(words.counts(), 1)
    spread = mix(words.hash)
    out = np.empty((n_rows, dimensions), np.int64)
    for d in range(dimensions):
        sign = ((spread >> np.uint64(d)) & np.uint64(1)).astype(np.float64) * 2 - 1
        value = np.bincount(words.doc, weights=sign, minlength=n_rows) / np.sqrt(count)
        out[:, d] = np.clip((np.tanh(value / 4) + 1) * (1 << (bits - 1)), 0, (1 << bits) - 1).astype(np.int64)
    return out


def tokenised(docs: DataFrame, text: str, payload: list[str], tokenizer: str) -> DataFrame:
    """``doc`` (struct of the payload), ``curve`` (Hilbert key), ``tokens``, ``ids`` (uint16)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in payload]).alias("doc"), F.col(text).cast("string").alias("text"))
    schema = rows.select("doc", F.lit(0).cast("long").alias("curve"), F.lit(0).cast("long").alias("tokens"),
                         F.lit(b"").alias("ids")).schema

    def run(batches):
        memory = _memory(tokenizer)
        for part in slices(batches, "text", PASS_BYTES):
            words = pieces(*text_buffer(part.column("text")))
            ids, per_word = memory.encode(words)
            ends = np.concatenate(([0], np.cumsum(per_word)))[words.first]
            each = [blob(np.append(ids[a:b], np.uint16(END_ID))) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(hilbert_key(project(words), BITS)), pa.array(np.diff(ends) + 1),
                 pa.array(each, pa.binary())], ["doc", "curve", "tokens", "ids"])

    return rows.mapInArrow(tidy(run), schema)


def _running_offsets(rows: DataFrame) -> DataFrame:
    """``row``, ``at``: tokens before each row along the curve.

    Range partitions of the small key columns, their totals, then the running
    sum inside each: no task holds more than one range.
    """
    spark = rows.sparkSession
    ranges = stored(rows.select("curve", "row", "tokens")
                    .repartitionByRange(partitions(spark), "curve", "row")
                    .withColumn("range", F.spark_partition_id()), "pack-ranges")
    totals = ranges.groupBy("range").agg(F.sum("tokens").alias("total"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("range", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("range").orderBy("curve", "row").rowsBetween(Window.unboundedPreceding, -1)
    return (ranges.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
            .join(totals, "range").select("row", (F.col("base") + F.col("inside")).alias("at")))


def pack(docs: DataFrame, tokenizer: str, text: str = "text", payload: list[str] | None = None,
         sequence: int = SEQUENCE) -> DataFrame:
    """Pack whole documents, neighbours along the curve together, into sequences.

    The documents lie end to end in the order (Hilbert key, row) and are cut
    every ``sequence`` tokens, so only the last sequence is padded. Returns one
    row per piece: ``doc`` (struct of the payload columns, all by default),
    ``start``, ``length``, ``ids`` (little-endian uint16, as binary), ``doc_tokens``, ``sequence_id``,
    ``offset``.

    A null or empty text is its end id alone. Repeated rows are documents of
    their own. An empty table gives no rows. Columns of ``docs`` never clash.
    """
    payload = payload or docs.columns
    rows = stored(tokenised(docs, text, payload, tokenizer).withColumn("row", F.monotonically_increasing_id()), "pack-tokens")
    placed = rows.select("row", "doc", "ids").join(_running_offsets(rows), "row").drop("row")
    schema = placed.select("doc", *[F.lit(0).cast("long").alias(c) for c in ("start", "length")], F.lit(b"").alias("ids"),
                           *[F.lit(0).cast("long").alias(c) for c in ("doc_tokens", "sequence_id", "offset")]).schema

    def run(batches):
        for part in slices(batches, "ids", PASS_BYTES):
            row, start, length, ids, whole, number, offset = [], [], [], [], [], [], []
            for i, (at, own) in enumerate(zip(part.column("at").to_pylist(), part.column("ids").to_pylist())):
                n, begin = len(own) // 2, 0
                while begin < n:
                    place = (at + begin) % sequence
                    size = min(n - begin, sequence - place)
                    row.append(i)
                    start.append(begin)
                    length.append(size)
                    ids.append(own[2 * begin:2 * (begin + size)])
                    whole.append(n)
                    number.append((at + begin) // sequence)
                    offset.append(place)
                    begin += size
            yield pa.RecordBatch.from_arrays(
                [part.column("doc").take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(whole, pa.int64()), pa.array(number, pa.int64()),
                 pa.array(offset, pa.int64())], schema.names)

    return placed.mapInArrow(tidy(run), schema)


def ids_crc32(pieces: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``, the crc32 of the ids as unsigned 32-bit
    little-endian numbers."""
    schema = pieces.withColumn("ids", F.lit(0).cast("long")).withColumnRenamed("ids", "ids_crc32").schema

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            crc = [zlib.crc32(np.frombuffer(x, np.uint16).astype("<u4").tobytes()) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(crc, pa.int64()), *batch.columns[at + 1:]], schema.names)

    return pieces.mapInArrow(tidy(run), schema)
