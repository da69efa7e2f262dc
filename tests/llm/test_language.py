"""Cross-parsing against a search in the training text itself."""

import numpy as np
import pytest

from tallyhouse.llm import language


def plain_phrases(text, train, known):
    """Runs of letters and single gaps; each phrase is the longest match in ``train``."""
    shown = "".join(c if c.isalpha() else " " for c in text.lower())
    while "  " in shown:
        shown = shown.replace("  ", " ")
    at = count = 0
    while at < len(shown):
        n = 1
        while at + n < len(shown) and shown[at] in known and shown[at:at + n + 1] in train:
            n += 1
        at, count = at + n, count + 1
    return count


def model_of(trains, size=12):
    letters = sorted({c for t in trains for c in t if c.isalpha()})
    symbol = {c: i + 2 for i, c in enumerate(letters)}
    table = language.symbol_table(symbol)
    steps = [language.automaton(language.symbols([t], table)[0], size) for t in trains]
    return language.Model([f"l{i}" for i in range(len(trains))], symbol, *language.parse_table(steps, size),
                          np.ones(len(trains)), size), table


def texts_for(trains, seed):
    pick = np.random.default_rng(seed)
    out = ["", "a", "  ", "zz9 z", trains[0], trains[0] * 7, "a" * 300, "ab" * 200]
    for n in (3, 17, 64, 65, 400):
        out.append("".join(pick.choice(list("abcdez  9"), n)))
    for _ in range(4):  # pieces of the training texts, joined at odd places
        out.append("".join(t[int(a):int(a) + int(n)] for t in trains for a, n in zip(pick.integers(0, 50, 9), pick.integers(1, 40, 9))))
    return out


@pytest.mark.parametrize("window, pass_bytes", [(512, 1 << 20), (8, 1 << 20), (1, 1 << 20), (8, 50), (64, 7)])
def test_phrases_do_not_end_with_windows_or_spans(monkeypatch, window, pass_bytes):
    monkeypatch.setattr(language, "WINDOW", window)
    monkeypatch.setattr(language, "PASS_BYTES", pass_bytes)
    pick = np.random.default_rng(5)
    trains = ["".join(pick.choice(list("abcd "), 120, p=p)).replace("  ", " ") for p in ([.4, .3, .1, .1, .1], [.1, .1, .4, .2, .2])]
    trains = [" ".join(t.split()) for t in trains]
    model, table = model_of(trains)
    texts = texts_for(trains, window)
    want = [[plain_phrases(t, train, set(train)) for train in trains] for t in texts]
    alone = [language.phrases([t], model, table) for t in texts]
    assert [a[0][0].tolist() for a in alone] == want
    assert [int(a[2][0]) for a in alone] == [sum(c.isalpha() for c in t) for t in texts]
    if pass_bytes > 1000:
        assert language.phrases(texts, model, table)[0].tolist() == want


def test_a_long_copy_of_the_training_text_is_one_phrase():
    pick = np.random.default_rng(2)
    train = "".join(pick.choice(list("abcdefgh"), 5000))
    model, table = model_of([train])
    assert language.phrases([train[7:4900]], model, table)[0].tolist() == [[1]]


def test_places_of_all_languages_follow_each_other():
    step = language.automaton(np.array([2, 3, 2]), 4)
    cells, roots = language.parse_table([step, step], 4)
    assert cells.dtype == np.int32 and roots.dtype == np.int32 and roots[1] == (len(step) + 1) * 5


def test_no_languages():
    model, table = model_of([])
    count, size, letters = language.phrases(["abc", ""], model, table)
    assert count.shape == (2, 0) and size.tolist() == [3, 0] and letters.tolist() == [3, 0]
