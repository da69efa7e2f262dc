"""Plain single-process versions of the numbered queries, for small tables."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def roots(ids, links):
    """Smallest id reachable, per id."""
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def token_ids(texts, path, end=1):
    from tokenizers import Tokenizer

    got = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*g.ids, end] for g in got]


def crc_ids(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def shingles(text):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def jaccard_components(docs):
    """docs: (doc_id, text) rows -> {doc_id: (size, component)}."""
    sets = [(i, shingles(t)) for i, t in docs]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k]
             if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    root = roots([i for i, _ in sets], links)
    return {i: (len(s), root[i]) for i, s in sets}


def cosine_links(rows, least=0.98):
    """rows: (vec_id, vector, label) -> {vec_id: (links, component)}."""
    good = {}
    for k, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None for x in v):
            continue
        v = np.array(v, float)
        if len(v) and np.isfinite(v).all() and v.any():
            good[k] = v / np.abs(v).max()
            good[k] /= np.linalg.norm(good[k])
    links = [(a, b) for a in good for b in good if a < b and rows[a][2] == rows[b][2] and len(good[a]) == len(good[b])
             and float(good[a] @ good[b]) >= least]
    n = Counter(x for pair in links for x in pair)
    root = roots([r[0] for r in rows], [(rows[a][0], rows[b][0]) for a, b in links])
    return [(r[0], n[k], root[r[0]]) for k, r in enumerate(rows)]


def statistics(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if count[x] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def unigram_base(docs):
    """docs: (doc_id, text) rows -> rows of (doc_id, held, n_tokens, n_known, N, base)."""
    end = object()
    tokens = [[*words(t, lower=True), end] for _, t in docs]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _ in docs]
    c = Counter(x for t, h in zip(tokens, held) if not h for x in t)
    total, distinct = sum(c.values()), len(c)
    return [(i, h, len(t), sum(c[x] > 0 for x in t), total, sum(log10((c[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in t))
            for (i, _), t, h in zip(docs, tokens, held)]


def conversations(rows):
    """rows: (conv_id, turn, role, text) -> {conv_id: (turns, sha, loss chars, loss sha)}."""
    low = lambda x: (x is not None, x if x is not None else 0)
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((low(turn), role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest())
    return out


def mix_targets(sizes):
    """sizes: {source: words} -> {source: target}, by repeated resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * sizes[s] * (1 + 1e-12)]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        for s in over:
            fixed[s] = 2.0 * sizes[s]
            left -= fixed[s]
