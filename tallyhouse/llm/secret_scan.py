"""Secret scans: known forms by pattern, and values in a credential context by
the cost of guessing them."""

from __future__ import annotations

import re
from math import inf, log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, texts_of, with_text

# Fixed values of the base forms: name, pattern, group and least length of it.
BASE = (
    ("assign", re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
#: Kind of the spans that the guess cost adds.
GUESS = "guess"
KINDS = (*(k for k, *_ in BASE), GUESS)

# A value follows a credential word and a sign, or stands as the password of an address.
_WORD = "pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth(?:orization)?|bearer"
_SIGN = r"""["'\])]*[\x20\t]*(?:=>|:=|[:=])"""
_CONTEXT = re.compile(
    rf"""(?ai:{_WORD}){_SIGN}[\x20\t]*(?:(?ai:bearer|basic)[\x20\t]+)?"""
    r"""(?:"([^"\n]+)"|'([^'\n]+)'|["']?([^\s"'<>]+))"""
    r"""|://[^\s/:@"']+:([^\s/@"']+)@""")
_TAIL = ".,;:!?)]}"
# What every text with a span holds: most texts are passed over by this one search.
_MAY_HOLD = rf"(?i:{_WORD}|passwd){_SIGN}|://|AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}"
#: Least length of a value, and least log10 of the guesses that make it a secret.
LEAST_CHARS, LEAST_GUESSES = 6, 10.0

#: Words known to the guesser, and their lengths.
WORDS, WORD_CHARS = 20_000, (3, 24)
#: Least times that a word occurs in the corpus.
WORD_COUNT = 3

# log10 of the guesses of each kind of span. Opening a span: one of five kinds.
OPEN = log10(5)
#: A brute-force character by its class.
DIGIT, LETTER, SIGN, OTHER = log10(10), log10(26), log10(33), log10(100)
#: Variants of a word: first letter or all in capitals, other capitals, letters written as digits.
CAPITAL, MIXED, LEET = log10(2), log10(10), log10(10)
#: A day of about 120 years, its signs, and a year alone.
DAY, DAY_SIGNS, YEAR = log10(365 * 120), log10(4), log10(120)
#: A keyboard walk: its first key, a step onward, a turn, a shifted key.
KEY, STEP, TURN, SHIFT = log10(47), 0.1, log10(6), log10(2)
#: A repeat: copying from so many characters back, each further character.
PERIODS, COPY = 64, 0.05

# Rows of a common keyboard, plain and shifted (fixed layout).
_ROWS = ("`1234567890-=", " qwertyuiop[]\\", " asdfghjkl;'", " zxcvbnm,./")
_SHIFTED = ("~!@#$%^&*()_+", " QWERTYUIOP{}|", ' ASDFGHJKL:"', " ZXCVBNM<>?")
_KEYS = {c: (r, i, shifted) for shifted, rows in ((False, _ROWS), (True, _SHIFTED)) for r, row in enumerate(rows) for i, c in enumerate(row)
         if c != " "}
# Neighbouring keys of slanted rows.
_STEPS = {(0, 1), (0, -1), (1, 0), (-1, 0), (1, -1), (-1, 1)}
_LEET = str.maketrans("43051789@$!", "aeosltbgasi")

_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d"
                   r"|(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\3(?:19|20)\d\d")
_YEAR = re.compile(r"(?:19|20)\d\d")


def brute_cost(c: str) -> float:
    if "0" <= c <= "9":
        return DIGIT
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return LETTER
    return SIGN if " " <= c <= "~" else OTHER


def word_cost(span: str, ranks: dict[str, int]) -> float | None:
    """log10 of the guesses that find ``span`` as a variant of a known word."""
    low = span.lower()
    plain = low.translate(_LEET)
    rank, leet = (ranks.get(low), 0.0) if low in ranks else (ranks.get(plain), LEET)
    if rank is None:
        return None
    case = 0.0 if span == low else CAPITAL if span[1:] == low[1:] or span == span.upper() else MIXED
    return log10(rank + 1) + case + leet


def date_costs(value: str, at: int):
    """``(end, cost)`` of the dates that begin at ``at``."""
    if day := _DATE.match(value, at):
        yield day.end(), DAY + (DAY_SIGNS if any(day.groups()) else 0.0)
    if year := _YEAR.match(value, at):
        yield year.end(), YEAR


def step(a: str, b: str):
    """Direction from key ``a`` to a neighbouring key ``b``, or None."""
    if a not in _KEYS or b not in _KEYS:
        return None
    (r, i, _), (s, j, _) = _KEYS[a], _KEYS[b]
    return (s - r, j - i) if (s - r, j - i) in _STEPS else None


def guess_cost(value: str, ranks: dict[str, int]) -> tuple[float, list[tuple[str, int, int]]]:
    """Least log10 of the guesses over all segmentations of ``value``, and one such
    segmentation as ``(kind, start, end)``.

    Dynamic programming over the ends of spans. Words and dates are looked up at
    every start; brute-force spans, walks and repeats cost so much a character,
    so each is carried along as an open span. Time is linear in the value.
    """
    n = len(value)
    best: list[tuple[float, str, int]] = [(inf, "", 0)] * (n + 1)
    best[0] = (0.0, "", 0)
    brute, walk, key = (inf, 0), (inf, 0, None), (inf, 0)
    copies: dict[int, tuple[float, int]] = {}
    for i, c in enumerate(value):
        here = best[i][0]
        for size in range(WORD_CHARS[0], min(WORD_CHARS[1], n - i) + 1):
            if (cost := word_cost(value[i:i + size], ranks)) is not None and here + OPEN + cost < best[i + size][0]:
                best[i + size] = (here + OPEN + cost, "word", i)
        for end, cost in date_costs(value, i):
            if here + OPEN + cost < best[end][0]:
                best[end] = (here + OPEN + cost, "date", i)

        brute = min(brute, (here + OPEN, i))
        brute = (brute[0] + brute_cost(c), brute[1])
        way = step(value[i - 1], c) if i else None
        onward = (inf, 0, None)
        if way:
            shift = SHIFT if _KEYS[c][2] else 0.0
            begun = (key[0] + TURN, key[1])
            goes_on = (walk[0] + (STEP if way == walk[2] else TURN), walk[1])
            onward = (*(lambda x: (x[0] + shift, x[1]))(min(begun, goes_on)), way)
        walk = onward
        key = (here + OPEN + KEY + (SHIFT if _KEYS[c][2] else 0.0), i) if c in _KEYS else (inf, 0)
        now = {}
        for p in range(1, min(PERIODS, i) + 1):
            if value[i - p] == c:
                cost, start = min(copies.get(p, (inf, 0)), (here + OPEN + log10(p), i))
                now[p] = (cost + COPY, start)
        copies = now
        ends = [(*brute, "brute"), (walk[0], walk[1], "walk"), *((cost, start, "repeat") for cost, start in copies.values())]
        cost, start, kind = min(ends)
        if cost < best[i + 1][0]:
            best[i + 1] = (cost, kind, start)
    parts, end = [], n
    while end:
        _, kind, start = best[end]
        parts.append((kind, start, end))
        end = start
    return best[n][0], parts[::-1]


def contexts(text: str):
    """``(start, end)`` of the whole values in a credential context."""
    for m in _CONTEXT.finditer(text):
        group = m.lastindex
        start, end = m.span(group)
        if group in (3, 4):
            end = start + len(text[start:end].rstrip(_TAIL))
        if end - start >= LEAST_CHARS:
            yield start, end


def spans(text: str, ranks: dict[str, int]) -> list[tuple[str, int, int, float | None]]:
    """All spans of a text by start, then kind: ``(kind, start, end, log10 guesses)``,
    positions in code points, the cost null for the base forms."""
    found = [(kind, m.start(), m.end(), None) for kind, pattern, group, least in BASE for m in pattern.finditer(text)
             if len(m[group]) >= least]
    for start, end in contexts(text):
        cost, _ = guess_cost(text[start:end], ranks)
        if cost >= LEAST_GUESSES:
            found.append((GUESS, start, end, cost))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def frequent_words(docs: DataFrame, text: str = "text", most: int = WORDS) -> dict[str, int]:
    """Rank of the ``most`` most frequent words of all texts (ties by code point): what
    a guesser tries first. Words are tokens between white space that hold letters
    alone but for punctuation at their ends, so parts of keys do not count.

    Counted per batch, then by Spark; the driver and the workers hold the list."""

    def run(batches):
        for part in slices(batches, "text"):
            tokens = pc.list_flatten(pc.split_pattern_regex(part.column("text"), r"[\x09-\x0D\x20]+"))
            counts = pc.value_counts(pc.utf8_lower(tokens))
            words = pc.struct_field(pc.extract_regex(counts.field("values"), rf"""^["'(\[]*(?P<w>\p{{L}}{{{WORD_CHARS[0]},{WORD_CHARS[1]}}})[.,;:!?"')\]]*$"""), "w")
            keep = pc.is_valid(words)
            yield pa.RecordBatch.from_arrays([words.filter(keep).cast(pa.string()), counts.field("counts").filter(keep)], ["word", "n"])

    counted = docs.select(F.col(text).cast("string").alias("text")).where("text IS NOT NULL").mapInArrow(run, "word string, n long")
    counts = stored(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= WORD_COUNT), "secret-words")
    # how many words are so frequent, in steps of an eighth of a doubling: only those
    # that can be among the first are sorted, so a task sends the driver few of them
    step = F.floor(F.log2("n") * 8).cast("int")
    enough, least = 0, 0
    for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect():
        enough, least = enough + r["words"], r["step"]
        if enough >= most:
            break
    top = counts.where(step >= least).orderBy(F.desc("n"), "word").limit(most)
    return {r["word"]: rank for rank, r in enumerate(top.collect(), 1)}


def scan(docs: DataFrame, ranks: dict[str, int], text: str = "text", payload: list[str] | None = None) -> DataFrame:
    """Find secrets in every whole text.

    Returns ``doc`` (struct of the payload columns, all by default) and ``spans``, an
    array of ``kind``, ``start``, ``end`` (code points, end exclusive) and ``guesses``
    (log10, null for base forms) by start, then kind. ``guess`` spans are values in a
    credential context (after a credential word and a sign, or the password in an
    address) that take at least 10^10 guesses; they may lie in a base span.

    A null or empty text has no spans; repeated rows come out alike; an empty table
    gives no rows. Columns of ``docs`` never clash. One pass without a shuffle.
    """
    rows, at = with_text(docs, text, payload)
    schema = rows.selectExpr("doc", "array(struct('' AS kind, 0L AS start, 0L AS end, cast(null AS double) AS guesses)) AS spans").schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("guesses", pa.float64())]))

    def run(batches):
        for part in slices(texts_of(batches, at), "text"):
            texts = part.column("text")
            found: list[list] = [[] for _ in range(part.num_rows)]
            some = np.flatnonzero(np.asarray(pc.fill_null(pc.match_substring_regex(texts, _MAY_HOLD), False)))
            for row, t in zip(some.tolist(), texts.take(pa.array(some)).to_pylist()):
                found[row] = [dict(zip(("kind", "start", "end", "guesses"), s)) for s in spans(t, ranks)]
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(found, kind)], ["doc", "spans"])

    return rows.mapInArrow(run, schema)


def joined(found: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds and of ``guess``, hash of the base spans, all spans as text."""
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != GUESS)
    return found.select("doc", *[number(k).alias(f"n_{k}") for k in KINDS], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
