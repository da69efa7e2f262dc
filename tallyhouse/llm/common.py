"""Shared pieces of the text operators: bounded Arrow batches, word splitting
and hashing over UTF-8 buffers, stored intermediate tables."""

from __future__ import annotations

import ctypes
import gc
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import shared_dir

#: Text handled at once inside a task; bounds numpy's temporaries.
CHUNK_BYTES = 2 << 20

#: Rows and bytes of an Arrow batch between Spark and Python.
BATCH_ROWS, BATCH_BYTES = 2000, 2 << 20

#: Rows that the Parquet reader decodes at once, and bytes of a row group that is written.
READER_ROWS, GROUP_BYTES = 512, 32 << 20

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_POWERS = np.ones(1, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (xor-shift and multiply, a bijection)."""
    h = h + _PRIME
    h = (h ^ (h >> np.uint64(30))) * _MIX_A
    h = (h ^ (h >> np.uint64(27))) * _MIX_B
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        base = np.full(size, _PRIME, dtype=np.uint64)
        base[0] = 1
        _POWERS = np.cumprod(base, dtype=np.uint64)
    return _POWERS


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker serves many stages, and
    its allocators would keep it. What the first call finds in use, mostly modules, is
    not searched for garbage again: that took more time than a small task's work."""
    gc.collect()
    if not gc.get_freeze_count():
        gc.freeze()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def tidy(run):
    """``run`` of a mapInArrow, with :func:`release_memory` before and after each task."""

    def task(batches):
        release_memory()
        try:
            yield from run(batches)
        finally:
            release_memory()

    return task


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(batches, column: str, max_bytes: int = CHUNK_BYTES):
    """Cut record batches so that ``column`` holds about ``max_bytes`` of text
    each (one longer text is a slice of its own, never cut)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        total = np.cumsum(sizes)
        row = 0
        while row < batch.num_rows:
            done = total[row - 1] if row else 0
            end = max(row + 1, int(np.searchsorted(total, done + max_bytes, "right")))
            yield batch.slice(row, end - row)
            row = end


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text of a slice.

    ``start``/``end``: byte bounds, ``doc``: row of the slice, ``hash``: 64-bit
    hash of the word's bytes (A-Z lower-cased first if asked), ``first``:
    index of each row's first word, with the total at the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool, split: np.ndarray | None = None):
        """``split``: bytes that begin a new piece inside a word, if any."""
        self.data = _LOWER[data] if lower else data
        n_rows = len(offsets) - 1
        is_word = _IS_WORD[data]
        begins, ends = is_word.copy(), is_word.copy()
        if len(data):
            begins[1:] &= ~is_word[:-1]
            ends[:-1] &= ~is_word[1:]
            if split is not None:
                begins |= split
                ends[:-1] |= split[1:]
            inner = offsets[1:-1]
            inner = inner[(inner > 0) & (inner < len(data))]
            begins[inner] = is_word[inner]
            ends[inner - 1] = is_word[inner - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(n_rows), np.diff(self.first))
        self.hash = self._hashes(is_word)

    def _hashes(self, is_word: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        at = np.concatenate(([0], np.cumsum(size)[:-1]))
        place = np.arange(int(size.sum())) - np.repeat(at, size)
        value = (self.data[is_word].astype(np.uint64) + np.uint64(1)) * _powers(int(size.max()))[place]
        return mix(np.add.reduceat(value, at) ^ (size.astype(np.uint64) << np.uint64(48)))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def batch_words(batch: pa.RecordBatch, column: str, lower: bool) -> Words:
    return Words(*text_buffer(batch.column(column)), lower)


def crc_of_ids(ids) -> np.ndarray:
    """crc32 of each id written as decimal text (a null id: of the empty text)."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) for i in ids], dtype=np.int64)


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back: cuts
    the lineage, survives lost executors, and is computed once."""
    spark: SparkSession = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_text(docs: DataFrame, text: str, payload: list[str] | None, *more: Column) -> tuple[DataFrame, int | None]:
    """Rows ``doc`` (struct of the payload columns, all by default), ``text`` and
    ``more``. A text that is a string of the payload is not sent twice: its place
    in the struct comes back, for :func:`texts_of`."""
    names = list(payload or docs.columns)
    at = names.index(text) if text in names and docs.schema[text].dataType.simpleString() == "string" else None
    own = [] if at is not None else [F.col(text).cast("string").alias("text")]
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), *own, *more), at


def texts_of(batches, at: int | None):
    """The batches of :func:`with_text`, each with its column ``text``."""
    for batch in batches:
        yield batch if at is None else batch.append_column("text", pc.struct_field(batch.column("doc"), [at]))


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches and Parquet reads of few rows and bytes for the session's Python
    stages: 10,000 long texts would be held by reader, JVM and Python at once."""
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READER_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
