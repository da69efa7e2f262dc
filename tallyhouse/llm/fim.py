"""Fill-in-middle transformation, its cuts looked up in a compressed set of token boundaries."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, with_text, texts_of

#: Markers of the parts (fixed values of the format).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A text stays plain with 10 in 100, and starts with its suffix with 20 in 100 of the rest.
TRANSFORMED, SUFFIX_FIRST = 90, 20
#: Offsets that share all but their low 16 bits lie in one container.
LOW_BITS = 16
#: Bytes of an offset in an array container, of a whole bitmap, and of a run.
ARRAY_BYTES, BITMAP_BYTES, RUN_BYTES = 2, (1 << LOW_BITS) // 8, 4


class ArrayContainer:
    """The low halves of few offsets, sorted."""

    def __init__(self, marks: np.ndarray):
        self.low = np.flatnonzero(marks).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit per offset, with the counts of its words summed up to each word."""

    def __init__(self, marks: np.ndarray):
        bits = np.zeros(1 << LOW_BITS, bool)
        bits[:len(marks)] = marks
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.upto, k, "right"))
        before = int(self.upto[word - 1]) if word else 0
        bits = np.unpackbits(self.words[word:word + 1].view(np.uint8), bitorder="little")
        return word * 64 + int(np.flatnonzero(bits)[k - before])


class RunContainer:
    """First offset of every run of neighbouring offsets, with lengths summed."""

    def __init__(self, marks: np.ndarray):
        change = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
        self.first = change[::2].astype(np.uint16)
        self.upto = np.cumsum(change[1::2] - change[::2])

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.upto, k, "right"))
        before = int(self.upto[run - 1]) if run else 0
        return int(self.first[run]) + k - before


class BoundarySet:
    """Sorted set of the offsets marked in ``marks``: a container of the smallest
    kind (array, bitmap, runs) for each 65,536 offsets that hold one, found by
    its cumulative cardinality."""

    def __init__(self, marks: np.ndarray):
        self.containers, self.high, sizes = [], [], []
        for high in range(0, len(marks), 1 << LOW_BITS):
            part = marks[high:high + (1 << LOW_BITS)]
            size = int(np.count_nonzero(part))
            if not size:
                continue
            runs = int(part[0]) + int(np.count_nonzero(part[1:] & ~part[:-1]))
            _, kind = min((RUN_BYTES * runs, RunContainer), (ARRAY_BYTES * size, ArrayContainer), (BITMAP_BYTES, BitmapContainer),
                          key=lambda x: x[0])
            self.containers.append(kind(part))
            self.high.append(high)
            sizes.append(size)
        self.upto = np.cumsum(sizes, dtype=np.int64)

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, k: int) -> int:
        """The ``k``-th smallest offset, from 0."""
        at = int(np.searchsorted(self.upto, k, "right"))
        before = int(self.upto[at - 1]) if at else 0
        return self.high[at] + self.containers[at].select(k - before)


def boundaries(text: str) -> BoundarySet:
    """Offsets at which the tokens ``[A-Za-z]+|[^A-Za-z]`` of ``text`` end, less 1."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((points | 32) - 97) < 26
    ends = np.ones(len(points), bool)
    ends[:-1] = ~(letter[:-1] & letter[1:])
    return BoundarySet(ends)


def draws(doc_id) -> list[int]:
    """Four numbers that depend on the id alone (a null id: as empty text)."""
    code = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(code[8 * i:8 * i + 8], 16) for i in range(4)]


def transform(text: str, doc_id) -> tuple[int, str, str, int | None, int | None]:
    """``(tokens, form, output, prefix_chars, middle_chars)`` of one text."""
    ends = boundaries(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= TRANSFORMED:
        return n, "plain", text, None, None
    a, b = (ends.select(k - 1) + 1 if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", a, b - a
    return n, "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", a, b - a


def restore(output: str, form: str) -> str:
    """The text that ``output`` was made from. Markers cannot lie in a transformed
    text, nor arise where a part meets one, as each begins with its only ``<``."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    if not output.startswith(first):
        raise ValueError(f"no {first} at the start of a text of form {form}")
    one, rest = output[len(first):].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    return two + middle + one if form == "spm" else one + middle + two


_COLUMNS = {"n": pa.int64(), "form": pa.string(), "output": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", payload: list[str] | None = None) -> DataFrame:
    """Cut every whole text at two token boundaries and reorder its parts.

    Returns ``doc`` (struct of the payload columns, all by default), ``n`` (tokens),
    ``form`` (``plain``, ``psm``, ``spm``), ``output``, ``prefix_chars`` and
    ``middle_chars`` (code points; null if plain). :func:`restored` gives the text back.

    Cuts depend on the id and the text alone, so reruns, repeated rows and any
    partitioning agree. A null text is empty and plain; a null id counts as an
    empty one. An empty table gives no rows. Columns of ``docs`` never clash. One
    pass without a shuffle; a task holds a slice of the texts, or one long text.
    """
    ids = docs[doc_id].cast("string").alias("__id")
    rows, at = with_text(docs, text, payload, ids)
    schema = rows.selectExpr("doc", "0L AS n", "'' AS form", "'' AS output", "cast(null AS long) AS prefix_chars",
                             "cast(null AS long) AS middle_chars").schema

    def run(batches):
        for part in slices(texts_of(batches, at), "text"):
            got = [transform(t or "", i) for t, i in zip(part.column("text").to_pylist(), part.column("__id").to_pylist())]
            columns = zip(*got) if got else ([] for _ in _COLUMNS)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), *[pa.array(c, t) for c, t in zip(columns, _COLUMNS.values())]], ["doc", *_COLUMNS])

    return rows.mapInArrow(run, schema)


def digests(made: DataFrame) -> DataFrame:
    """Replace ``output`` by ``output_sha256``, and by ``restored_sha256`` of the text
    that a parser rebuilds from output and form (lowercase hex, UTF-8)."""
    keep = [c for c in made.columns if c != "output"]
    schema = made.selectExpr(*keep, "'' AS output_sha256", "'' AS restored_sha256").schema

    def run(batches):
        for part in slices(batches, "output"):
            out, form = part.column("output").to_pylist(), part.column("form").to_pylist()
            hashed = [[hashlib.sha256(x.encode()).hexdigest() for x in texts] for texts in (out, map(restore, out, form))]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *[pa.array(h, pa.string()) for h in hashed]], schema.names)

    return made.mapInArrow(run, schema)


def restored(made: DataFrame) -> DataFrame:
    """``made`` with column ``restored``, the texts before the transformation."""
    schema = made.selectExpr("*", "'' AS restored").schema

    def run(batches):
        for part in slices(batches, "output"):
            texts = list(map(restore, part.column("output").to_pylist(), part.column("form").to_pylist()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], schema.names)

    return made.mapInArrow(run, schema)
