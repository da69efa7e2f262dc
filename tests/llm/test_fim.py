"""Fill-in-middle: containers against sorted lists, cuts against the pattern, round trips, edge rows."""

import hashlib
import random
import re

import numpy as np
import pytest

from tallyhouse.llm import fim

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def test_select_agrees_with_the_sorted_offsets():
    pick = np.random.default_rng(2)
    for size, share in ((1, 1.0), (70, 0.5), (65_536, 0.01), (65_536, 0.4), (200_000, 0.0001), (200_000, 0.97), (140_000, 0.5)):
        marks = pick.random(size) < share
        if size == 200_000:
            marks[60_000:131_072] = share > 0.5  # whole containers full or empty
        marks[-1] = True
        got, want = fim.BoundarySet(marks), np.flatnonzero(marks)
        assert len(got) == len(want)
        for k in {0, len(want) - 1, *pick.integers(0, len(want), 300).tolist()}:
            assert got.select(k) == want[k]


def test_each_kind_of_container_is_chosen():
    pick = np.random.default_rng(3)
    kinds = [type(fim.BoundarySet(m).containers[0]) for m in (pick.random(65_536) < 0.01, pick.random(65_536) < 0.5, np.ones(65_536, bool))]
    assert kinds == [fim.ArrayContainer, fim.BitmapContainer, fim.RunContainer]


def plain_transform(i, text):
    t = text or ""
    w, code = TOKEN.findall(t), hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(code[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if t == "" or re.search("<[PSM]>", t) or h[2] % 100 >= 90:
        return len(w), "plain", t, None, None
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return len(w), "spm" if h[3] % 100 < 20 else "psm", out, len(p), len(m)


def test_transform_and_restore():
    pick = random.Random(4)
    letters = [*"abZ <>PSM\n\t09é漢🙂", "<P", "S>", "<<", "word", "́"]
    for i in range(3000):
        text = "".join(pick.choice(letters) for _ in range(pick.randint(0, 40)))
        got = fim.transform(text, i)
        assert got == plain_transform(i, text) and fim.restore(got[2], got[1]) == text


@pytest.fixture(scope="module")
def table(spark):
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    rows = [(1, "some words here"), (1, "some words here"), (2, None), (3, ""), (4, long), (None, "no id é"), (5, "a <M> b"), (6, "🙂" * 70_000)]
    rows += [(i, f"text number {i}, é") for i in range(10, 60)]
    return rows, spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], "doc_id long, text string, doc string, n int, form string, output string")


def test_whole_rows(table):
    rows, docs = table
    made = fim.restored(fim.fill_in_middle(docs))
    got = sorted(((r["doc"]["doc_id"], r["doc"]["text"], r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"])
                  for r in made.collect()), key=str)
    assert got == sorted(((i, t, *plain_transform(i, t)) for i, t in rows), key=str)
    assert all(r["restored"] == (r["doc"]["text"] or "") for r in made.collect())
    assert fim.digests(fim.fill_in_middle(docs.limit(0))).count() == 0
    assert {r[3] for r in got} == {"plain", "psm", "spm"}


def test_digests_are_of_the_output_and_of_the_text(table):
    rows, docs = table
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = fim.digests(fim.fill_in_middle(docs, payload=["doc_id", "text"])).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["doc"]["text"] or ""
        assert (r["output_sha256"], r["restored_sha256"]) == (sha(plain_transform(r["doc"]["doc_id"], text)[2]), sha(text))
