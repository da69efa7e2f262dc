"""Secret scans: guess costs against all segmentations, spans against a plain scan, edge rows."""

import hashlib
import random
import re
from functools import cache
from math import inf, log10

import pytest

from tallyhouse.llm import secret_scan as S
from tallyhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
RANKS = {"password": 1, "dragon": 2, "correct": 40, "horse": 300, "battery": 500, "staple": 900, "the": 3, "let": 4}


def span_costs(value, i, j):
    """Cost of value[i:j] as one span of each kind, straight from the definitions."""
    part = value[i:j]
    yield sum(map(S.brute_cost, part))
    if S.WORD_CHARS[0] <= len(part) <= S.WORD_CHARS[1] and (c := S.word_cost(part, RANKS)) is not None:
        yield c
    for end, c in S.date_costs(value, i):
        if end == j:
            yield c
    ways = [S.step(a, b) for a, b in zip(part, part[1:])]
    if len(part) > 1 and all(ways):
        turns = 1 + sum(a != b for a, b in zip(ways, ways[1:]))
        yield S.KEY + turns * S.TURN + (len(ways) - turns) * S.STEP + sum(S.SHIFT for c in part if S._KEYS[c][2])
    for p in range(1, min(i, S.PERIODS) + 1):
        if all(value[k] == value[k - p] for k in range(i, j)):
            yield log10(p) + S.COPY * len(part)


def least_cost(value):
    @cache
    def rest(i):
        if i == len(value):
            return 0.0
        return min(min(span_costs(value, i, j), default=inf) + S.OPEN + rest(j) for j in range(i + 1, len(value) + 1))
    return rest(0)


def test_guess_cost_is_least_over_all_segmentations():
    pick = random.Random(8)
    parts = ["password", "Dragon", "h0rse", "qwerty", "zxcv", "2019-05-17", "17.05.2019", "1987", "aaaa", "abab", "x7", "9Q", "é", "!@#", "the", "9"]
    for _ in range(250):
        value = "".join(pick.choice(parts) for _ in range(pick.randint(1, 4)))[:22]
        cost, spans = S.guess_cost(value, RANKS)
        assert cost == pytest.approx(least_cost(value)), value
        assert [a for _, a, _ in spans] == [0, *[b for *_, b in spans][:-1]] and spans[-1][2] == len(value)


def test_known_values():
    weak = ["password1987", "Password123", "qwertyuiop", "aaaaaaaaaaaaaaaaaaaa", "abcabcabcabcabcabc", "2019-05-17", "dragondragon"]
    strong = ["b7db7aa4a5fcc78305", "kX9!vQ2#pL7z", "xq7Rz0Pw3LmK9t", "24be64439e3e49cf"]
    assert all(S.guess_cost(v, RANKS)[0] < S.LEAST_GUESSES for v in weak)
    assert all(S.guess_cost(v, RANKS)[0] >= S.LEAST_GUESSES for v in strong)
    long = "aB3$" * 20_000
    cost, parts = S.guess_cost(long, {})
    assert cost < 1.05 * S.COPY * len(long) + 20 and parts[-1][2] == len(long)


def test_contexts_hold_whole_values():
    text = ('é pwd: "two words, x9!" and api-key => Zk49vv2! and "auth": \'q8#Lm2x1\', then postgres://me:s3cr3t-Xy@host/db '
            "Authorization: Bearer abc.def-123. nothing")
    assert [text[a:b] for a, b in S.contexts(text)] == ["two words, x9!", "Zk49vv2", "q8#Lm2x1", "s3cr3t-Xy", "abc.def-123"]


ASSIGN = re.compile("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
                    "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def base(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_forms():
    text = "ſecret=abcdefg PassWord: 'x1y2z3' token=abc AKIA" + "A1" * 8 + " AKIASHORT " + "0a" * 12 + "g api_key=" + "f" * 30
    got = [(s, S.KINDS.index(k), k, e) for k, s, e, _ in S.spans(text, {}) if k != S.GUESS]
    assert got == base(text) and [k for _, _, k, _ in got] == ["assign", "access", "hex", "assign", "hex"]


def test_query_on_the_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op12_secrets"](spark, SF).collect()
    assert len(got) == len(texts) and any(r["n_guess"] for r in got)
    for r in got:
        want = base(texts[r["doc_id"]])
        line = ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in S.KINDS[:3]] == [sum(w[2] == k for w in want) for k in S.KINDS[:3]]
        shown = [x.split(":") for x in r["spans"].split(",") if x]
        assert [x for x in shown if x[0] != S.GUESS] == [[k, str(s), str(e)] for s, _, k, e in want]
        assert want or not shown


def test_words_are_ranked_over_all_texts(spark):
    rows = [("the the The, the (house) k3y house. x",), (None,), ("",), ("house the ab9house élan élan élan!",)]
    docs = spark.createDataFrame(rows, "text string")
    assert S.frequent_words(docs) == {"the": 1, "house": 2, "élan": 3}
    assert S.frequent_words(docs.limit(0)) == {}


def test_odd_rows(spark):
    long = "word " * 30_000 + 'secret = "kX9!vQ2#pL7z"'
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "🙂 pwd=kX9vQ2pL7z"), (4, "password: password")]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, doc string, spans int")
    got = sorted((str(r["doc"]["doc_id"]), r["spans"]) for r in S.digests(S.scan(table, RANKS)).collect())
    assert got == sorted([("1", ""), ("2", ""), *[("3", "guess:150010:150022")] * 2, ("4", "assign:0:18"), ("None", "guess:6:16")])
    assert S.scan(table.limit(0), {}).count() == 0
