"""Language identification by cross-parsing against suffix automata."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of, with_text

UNKNOWN = "und"
#: Documents of each language that training text is taken from, about.
PER_LANGUAGE = 200
#: Code points of training text per language at most, taken in spans of so many.
TRAIN_CHARS = 24_000
SPAN = 60
#: Symbols: word gap, any letter not seen in training, and the alphabet; letters
#: beyond it take three symbols, so none is lost.
ALPHABET = 64
#: Texts are parsed in windows of so many symbols at once; phrases go on across them.
WINDOW = 512
#: Text of one pass through the tables; a longer one goes through in spans of so
#: many code points.
PASS_BYTES = 1 << 20


def automaton(text: np.ndarray, size: int) -> np.ndarray:
    """Transitions of the suffix automaton of ``text`` (symbols below ``size``):
    row = state, state 0 the root; -1 where no factor goes on."""
    last, link, length = 0, [-1], [0]
    step = [[-1] * size]
    for c in text.tolist():
        new = len(step)
        step.append([-1] * size)
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and step[p][c] < 0:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(step)
                step.append(step[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p][c] == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return np.array(step, np.int32)


def parse_table(steps: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """One table for all automata: entry = next place * 2 + (1 if a phrase ends).

    A place is state * (size + 1); the last column is padding and stays. Where
    no match goes on, the phrase ends and the next begins with this symbol at
    the root; a symbol unknown to the language is a phrase of its own, in a state after
    which every symbol begins the next one.
    """
    parts, roots, base = [], [], 0
    for step in steps:
        states = len(step)
        alone = states * (size + 1) + base
        here = np.arange(states + 1, dtype=np.int64) * (size + 1) + base
        first = np.where(step[0] >= 0, step[0].astype(np.int64) * (size + 1) + base, alone)
        out = np.empty((states + 1, size + 1), np.int64)
        out[:, :size] = first * 2 + 1
        out[0, :size] = first * 2
        out[:-1, :size] = np.where(step >= 0, (step.astype(np.int64) * (size + 1) + base) * 2, out[:-1, :size])
        out[:, size] = here * 2
        parts.append(out.reshape(-1))
        roots.append(base)
        base += (states + 1) * (size + 1)
    kind = np.int32 if 2 * base <= np.iinfo(np.int32).max else np.int64
    return np.concatenate(parts or [np.zeros(1, np.int64)]).astype(kind), np.array(roots, kind)


@dataclass
class Model:
    languages: list[str]
    symbol: dict[str, int]  # codes of the letters, lower case
    table: np.ndarray
    roots: np.ndarray
    cost: np.ndarray  # bits of a phrase per language
    size: int


_CLASSES: dict[int, np.ndarray] = {}


def symbol_table(letters: dict[str, int]) -> np.ndarray:
    """Code of every code point: 0 no letter, 1 a letter that no training text has,
    else that of :func:`codes`. Marks that combine with letters count as letters."""
    if 0 not in _CLASSES:
        _CLASSES[0] = np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)], np.uint8)
    table = _CLASSES[0].astype(np.int32)
    for letter, s in letters.items():
        for x in {letter, letter.upper(), letter.title()}:
            if len(x) == 1:
                table[ord(x)] = s
    return table


def codes(letters: list[str], size: int) -> dict[str, int]:
    """Codes of all letters, the most frequent first: a symbol each while there are
    any, then three symbols (a lead that is no letter, and two digits) in a byte each."""
    base, leads = size - 2, 0
    while len(letters) > base - leads + leads * base * base:
        leads += 1
    short = base - leads
    out = {c: i + 2 for i, c in enumerate(sorted(letters[:short]))}
    for i, c in enumerate(letters[short:]):
        lead, rest = divmod(i, base * base)
        out[c] = size - 1 - lead | (rest // base + 2) << 8 | (rest % base + 2) << 16
    return out


def symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts with runs of non-letters as one gap, their owners, and
    the number of letters of each text."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    s = table[code]
    owner = np.repeat(np.arange(len(texts)), size)
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0) | (owner[1:] != owner[:-1])
    letters = np.bincount(owner[s > 0], minlength=len(texts))
    s, owner = s[keep], owner[keep]
    if (s > 255).any():
        times = np.where(s > 255, 3, 1)
        nth = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        s, owner = np.repeat(s, times) >> 8 * nth & 255, np.repeat(owner, times)
    return s, owner, letters


def phrases(texts: list[str], model: Model, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of every text in every language, symbols, and letters per text.

    A single text longer than ``PASS_BYTES`` goes through span by span; the parses go on
    where the span before stopped, so phrases do not end with spans.
    """
    long = len(texts) == 1 and len(texts[0]) > PASS_BYTES
    places = range(0, len(texts[0]), PASS_BYTES) if long else (0,)
    at = np.repeat(model.roots[None, :], len(texts), axis=0)
    count, size, letters = np.zeros(at.shape, np.int64), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    in_gap = False
    for a in places:
        s, owner, n = symbols([texts[0][a:a + PASS_BYTES]] if long else texts, table)
        if in_gap and len(s) and s[0] == 0:  # a gap that began in the span before
            s, owner = s[1:], owner[1:]
        in_gap = long and (s[-1] == 0 if len(s) else in_gap)
        per_text = np.bincount(owner, minlength=len(texts))
        ended, at = breaks(s, per_text, model, at)
        count, size, letters = count + ended, size + per_text, letters + n
    return count + (size > 0)[:, None], size, letters


def breaks(s: np.ndarray, per_text: np.ndarray, model: Model, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase ends in each of the texts whose symbols follow each other in ``s``, and the
    places where the parses stop (both texts x languages); ``entry`` holds those where they
    begin.

    Texts are cut into windows that go through the table in step, each from the root.
    Then every window is parsed again from where the one before it stopped, until
    both parses stand at the same place, from where on they are the same. Where that
    moves a window's own stop, its successor is parsed once more.
    """
    count, stops = np.zeros(entry.shape, np.int64), entry.copy()
    if not len(s) or not len(model.languages):
        return count, stops
    windows = -(-per_text // WINDOW)
    who = np.repeat(np.arange(len(per_text)), windows)
    nth = np.arange(len(who)) - np.repeat(np.cumsum(windows) - windows, windows)
    size = np.minimum(per_text[who] - nth * WINDOW, WINDOW)
    order = np.argsort(-size, kind="stable")  # long windows first, so that full ones can stop
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    column = np.repeat(rank, size)
    grid = np.full((int(size.max()), len(who)), model.size, np.int32)
    grid[np.arange(len(s)) - np.repeat(np.cumsum(size) - size, size), column] = s
    alive = np.bincount(size, minlength=len(grid) + 1)[::-1].cumsum()[::-1]
    who, nth, size = who[order], nth[order], size[order]
    later = np.flatnonzero(nth > 0)
    before = rank[order[later] - 1]
    last = np.flatnonzero(nth == windows[who] - 1)
    trail = np.empty(grid.shape, model.table.dtype)
    for k in range(len(model.languages)):
        began = np.where(nth > 0, model.roots[k], entry[who, k])
        stop, ended = began.copy(), np.zeros(len(who), np.int64)
        for j in range(len(grid)):
            n = alive[j + 1]
            trail[j, :n] = model.table[stop[:n] + grid[j, :n]]
            ended[:n] += trail[j, :n] & 1
            stop[:n] = trail[j, :n] >> 1
        while True:
            moved = stop[before] != began[later]
            todo = later[moved]
            if not len(todo):
                break
            state = began[todo] = stop[before[moved]]
            for j in range(len(grid)):
                got, old = model.table[state + grid[j, todo]], trail[j, todo]
                trail[j, todo] = got
                ended[todo] += (got & 1).astype(np.int64) - (old & 1)
                state = got >> 1
                full = size[todo] == j + 1
                stop[todo[full]] = state[full]
                on = ~full & (state != old >> 1)
                todo, state = todo[on], state[on]
                if not len(todo):
                    break
        count[:, k] = np.bincount(who, ended, len(per_text))
        stops[who[last], k] = stop[last]
    return count, stops


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_language: int = PER_LANGUAGE,
        train_chars: int = TRAIN_CHARS, alphabet: int = ALPHABET) -> Model:
    """Automata of a bounded sample: about ``per_language`` documents of each
    language by a hash of the id, and at most about ``train_chars`` code points of
    them, from the whole length of each (documented bounds); rows with null text,
    language or id are left out. The tables hold at most 2 * train_chars *
    (alphabet + 1) cells per language, thrice that where all letters are rare."""
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull())
    sizes = {r[0]: r[1] for r in usable.groupBy(F.col(lang).cast("string")).count().collect()}
    spread = 1 << 30
    place = F.pmod(F.xxhash64(F.col(doc_id), F.lit("language")), F.lit(spread))
    limit, name_of = F.lit(0), F.col(lang).cast("string")
    for name, n in sorted(sizes.items()):
        limit = F.when(name_of == name, min(spread, int(spread * per_language / n))).otherwise(limit)
    picked = usable.where(place < limit).select(name_of.alias("l"), F.col(doc_id).cast("string").alias("i"),
                                                F.col(text).cast("string").alias("t"), F.length(F.col(text)).alias("n"))
    lengths: dict[str, list[int]] = {}
    for r in (picked.select("l", "n").collect() if sizes else []):
        lengths.setdefault(r["l"], []).append(r["n"])
    share = F.lit(0)
    for name, n in sorted(lengths.items()):
        share = F.when(F.col("l") == name, even_share(n, train_chars)).otherwise(share)
    got = picked.select("l", "i", spans(F.col("t"), F.col("n"), share, F.col("i")).alias("t")).collect() if lengths else []
    texts: dict[str, list[str]] = {}
    for r in sorted(got, key=lambda r: (r["l"], r["i"], r["t"])):
        texts.setdefault(r["l"], []).append(r["t"])
    names = sorted(texts)
    every = symbol_table({})
    seen: dict[str, int] = {}
    for name in names:
        for c in "".join(texts[name]).lower():
            if every[ord(c)]:
                seen[c] = seen.get(c, 0) + 1
    letters = codes(sorted(seen, key=lambda c: (-seen[c], c)), alphabet)
    table = symbol_table(letters)
    steps, cost, learned = [], [], []
    for name in names:
        s, _, n = symbols([" ".join(texts[name])], table)
        if n.sum() == 0:
            continue
        learned.append(name)
        steps.append(automaton(s, alphabet))
        cost.append(np.log2(len(s) + 1))
    if not steps:
        return Model([], letters, np.zeros(1, np.int32), np.zeros(0, np.int32), np.zeros(0), alphabet)
    cells, roots = parse_table(steps, alphabet)
    return Model(learned, letters, cells, roots, np.array(cost), alphabet)


def even_share(lengths: list[int], total: int) -> int:
    """Code points that each text may give, so that all together give ``total`` and
    what short ones lack comes from the longer."""
    left, share = total, 0
    for k, n in enumerate(sorted(lengths)):
        share = left // (len(lengths) - k)
        if n > share:
            return max(1, share)
        left -= n
    return max([1, *lengths])


def spans(text: Column, size: Column, share: Column, key: Column) -> Column:
    """``share`` code points of a text in spans of ``SPAN``, one at a hashed place of
    each of equal stretches of the whole text; a shorter text whole."""
    many = F.greatest(F.lit(1), F.floor(share / SPAN)).cast("int")
    wide = F.least(F.lit(SPAN), share).cast("int")
    at = lambda i: (F.floor((i + F.pmod(F.xxhash64(key, i), F.lit(1 << 20)) / (1 << 20)) * (size - wide) / many) + 1).cast("int")
    return F.when(size <= share, text).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.substring(text, at(i), wide)), " "))


def identify(docs: DataFrame, model: Model, text: str = "text", payload: list[str] | None = None) -> DataFrame:
    """Language of every whole text: ``doc`` (struct of the payload columns, all by
    default), ``lang_pred``, ``score``.

    The language whose training text needs the fewest phrases, weighed by the
    bits of a phrase, wins; ties go to the first by name. ``score`` is how far the
    runner-up is behind (0 to 1; 1 with one language). Null texts and texts
    without a letter are ``und`` with score 0, as is all text if nothing was
    learned. Repeated rows are scored each.
    """
    rows, place = with_text(docs, text, payload)
    schema = rows.select("doc", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        table = symbol_table(model.symbol)
        names = np.array([*model.languages, UNKNOWN], object)
        for part in slices(texts_of(batches, place), "text", PASS_BYTES):
            texts = [t or "" for t in part.column("text").to_pylist()]
            count, _, letters = phrases(texts, model, table)
            best = np.full(len(texts), len(model.languages))
            score = np.zeros(len(texts))
            if model.languages:
                bits = count * model.cost
                found = letters > 0
                best[found] = bits.argmin(1)[found]
                ranked = np.sort(bits, axis=1)
                behind = 1 - ranked[:, 0] / np.maximum(ranked[:, 1], 1e-12) if ranked.shape[1] > 1 else np.ones(len(texts))
                score[found] = behind[found]
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(names[best].tolist(), pa.string()), pa.array(score)], schema.names)

    return rows.mapInArrow(run, schema)
