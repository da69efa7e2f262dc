"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import gc
import random
from datetime import date as D

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from tallyhouse.llm import chat, cotraining, embeddings, features, language, lm, mixing, ngram_join, packing, pages, quality_rules
from tallyhouse.llm.common import Words, release_memory, slices, text_buffer
from tallyhouse.llm.components import components
from tallyhouse.llm.queries import TOKENIZER

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
WORDY = " ".join(f"word{i}" for i in range(80))
DOCS = [(1, WORDY, "en", "a"), (1, WORDY, "en", "a"), (2, None, None, None), (3, "", "en", ""), (4, " \t\n ", "de", "b"),
        (5, LONG, "de", "a"), (6, LONG + " tail", "de", None), (None, WORDY, "en", "b"), (7, "one two", None, "b"),
        (8, "One  TWO", "en", "c"), (9, "éß漢 🙂<|endoftext|> it's", "fr", "c")]
NAMES = "doc_id long, text string, lang string, source string, `size` long, doc string, kept int, score string, id int, n string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*d, 1, "x", 0, "y", 5, None) for d in DOCS], NAMES)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (3, 0), (4, None), (None, 1), (5, 1), (5, 0)], "doc_id long, quality int")


def test_packing(spark, docs):
    got = packing.ids_crc32(packing.pack(docs, TOKENIZER)).select("doc.*", "start", "length", "ids_crc32", "doc_tokens").collect()
    assert sum(r["length"] for r in got) == sum(map(len, brute.token_ids([d[1] for d in DOCS], TOKENIZER)))
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0


def test_pieces_keep_the_ids_of_odd_texts():
    pick = random.Random(3)
    alphabet = [*"abXYZ019'’.,!*<|>_-\"#é—ßΣς  \n\tJ", "́", "̌", "İ", "<|endoftext|>", "<|ENDOFTEXT|>", "'S", "漢", "​", "\x85"]
    texts = ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, 50))) for _ in range(400)]
    for some in (texts, [t.replace("<|", "") for t in texts]):
        words = packing.pieces(*text_buffer(pa.array(some)))
        ids, size = packing.WordIds(TOKENIZER).encode(words)
        ends = np.concatenate(([0], np.cumsum(size)))[words.first]
        assert [[*ids[a:b].tolist(), 1] for a, b in zip(ends, ends[1:])] == brute.token_ids(some, TOKENIZER)


def test_few_pieces_are_encoded_at_once(monkeypatch):
    """The encodings of a slice's pieces, held together, took a worker's memory."""
    own, seen = packing._tokenizer(TOKENIZER), []

    class Watched:
        def encode_batch_fast(self, texts, **options):
            seen.append(len(texts))
            return own.encode_batch_fast(texts, **options)

        get_vocab = staticmethod(own.get_vocab)

    monkeypatch.setattr(packing, "_tokenizer", lambda path: Watched())
    text = " ".join(f"w{i} é{i}" for i in range(3000))
    ids, _ = packing.WordIds(TOKENIZER).encode(packing.pieces(*text_buffer(pa.array([text]))))
    assert max(seen) <= packing.ENCODED < sum(seen) and [*ids.tolist(), 1] == brute.token_ids([text], TOKENIZER)[0]


def test_hilbert_key_visits_neighbours():
    side = np.stack(np.meshgrid(range(8), range(8), range(8), indexing="ij"), -1).reshape(-1, 3)
    key = packing.hilbert_key(side, 3)
    walk = side[np.argsort(key)]
    assert sorted(key) == list(range(512)) and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_jaccard(spark, docs):
    got = sorted(map(tuple, ngram_join.jaccard_join(docs).collect()), key=str)
    want = brute.jaccard_components([d[:2] for d in DOCS if d[0] is not None])
    assert sorted([(i, *want[i]) for i, *_ in DOCS if i is not None] + [(None, 76, None)], key=str) == got
    assert ngram_join.jaccard_join(docs.limit(0)).count() == 0


def test_jaccard_families(spark):
    """Near copies, a common passage in most documents, and frequent shingles."""
    pick = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(150):
        w = list(base)
        for _ in range(pick.randint(0, 5)):
            w[pick.randrange(120)] = f"x{pick.random()}"
        texts.append(w)
    texts += [passage + [f"u{i}_{j}" for j in range(pick.randint(5, 25))] for i in range(150)]
    texts += [pick.sample(base, 6) for _ in range(30)] + [passage[:k] for k in range(1, 60)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    got = {r[0]: (r[1], r[2]) for r in ngram_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.jaccard_components(rows)


def test_signatures_lose_no_pair():
    pick = np.random.default_rng(7)
    for size in (3, 9, 17, 40, 130, 700):
        for _ in range(40):
            pool = pick.integers(0, 2**63, size + size // 3 + 1).astype(np.uint64)
            x = np.unique(pool[:size])
            y = np.unique(np.concatenate((x[pick.random(len(x)) < 0.87], pool[size:size + pick.integers(0, size // 8 + 1)])))
            common = len(np.intersect1d(x, y))
            if not len(y) or 100 * common < 75 * (len(x) + len(y) - common):
                continue
            for share in (0.0, 0.7, 1.0):
                rank = lambda s: np.where(s % np.uint64(1000) < np.uint64(1000 * share), 200, 10).astype(np.uint8)  # noqa: B023, E731
                a, b = (ngram_join.signatures(s, rank(s), 100) for s in (x, y))
                assert np.intersect1d(a, b).size


def test_embeddings(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.999, 0.01], 1), (4, [1.0, 0.0], 2), (5, None, 1),
            (6, [0.0, 0.0], 1), (7, [float("nan"), 1.0], 1), (8, [None, 1.0], 1), (9, [1.0, 0.0], None), (10, [1e30, 0.0], 1),
            (11, [1.0], 1), (None, [1.0, 0.0], 1), (12, [], 1), (13, [float("inf"), 1.0], 1)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, n string")
    got = sorted((tuple(r)[:3] for r in embeddings.near_duplicates(table).collect()), key=str)
    want = brute.cosine_links([r for r in rows if r[0] is not None])
    assert got == sorted([*want, (None, 0, None)], key=str)
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


@pytest.mark.parametrize("kind, labels", [("string", ["a", "7", "a", None]), ("date", [D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 1), None]),
                                         ("double", [0.0, 7.5, -0.0, None]), ("boolean", [True, False, True, None])])
def test_embeddings_with_labels_of_any_type(spark, kind, labels):
    rows = [(i, [1.0, 2.0, 3.0 + i / 1000], v) for i, v in enumerate(labels)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 0, True), (1, 0, 1, True), (2, 1, 0, False), (3, 0, 3, True)]


def test_embeddings_large_group_in_blocks(spark):
    pick = np.random.default_rng(1)
    centre = pick.normal(size=16)
    rows = [(i, (centre + pick.normal(size=16) * (0.02 + 0.3 * (i % 7 == 0))).tolist(), 0) for i in range(1400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.98).sum(1) - 1
    got = {r[0]: r[1] for r in embeddings.near_duplicates(table).collect()}
    assert sum(got.values()) >= 0.999 * links.sum() and all(got[i] <= n for i, n in enumerate(links))


def test_language(spark, docs):
    model = language.fit(docs)
    got = {r["doc"]["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    assert got[2] == got[3] == got[4] == "und" and set(got.values()) <= {"und", "en", "de", "fr"}
    assert {r[0] for r in language.identify(docs, language.fit(docs.limit(0))).select("lang_pred").collect()} == {"und"}


def test_cross_parsing_counts_phrases():
    train, text = "abracadabra", "cadabrabrazz"
    model = language.Model(["l"], {c: i + 2 for i, c in enumerate("abcdr")}, *[None] * 3, 8)
    table = language.symbol_table(model.symbol)
    step = language.automaton(language.symbols([train], table)[0], 8)
    model.table, model.roots = language.parse_table([step], 8)
    want, at = 0, 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at:at + n + 1] in train:
            n += 1
        want, at = want + 1, at + n
    assert language.phrases([text], model, table)[0][0, 0] == want


@pytest.mark.parametrize("text", ["<|im_end|>", "<|im_start|>x\n<|im_end|>\n", "<​|im_end|>", "<<|im_end|>", "", "\\n", "a<|im_end|"])
def test_turns_round_trip(text):
    for role in ("user", "a\nb", "x<|im_end|>", "\\n", ""):
        rendered = chat.render_turn(role, text) + chat.render_turn("assistant", text)
        assert chat.read_back(rendered) == [(role, text), ("assistant", text)]


def test_chat_nulls_and_ties(spark):
    rows = [(1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (None, None, "user", "n"), (2, 1, "assistant", LONG)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r[0]: tuple(r)[1:5] for r in chat.digests(chat.format_turns(table)).collect()}
    assert got == brute.conversations(rows)
    assert chat.digests(chat.format_turns(table.limit(0))).count() == 0


def test_mixing(spark, docs):
    got = mixing.mix(docs).select("doc.doc_id", "size", "taken", "copies", "source_size", "target").collect()
    assert len(got) == len(DOCS) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert all(r["taken"] == 0 for r in got if not r["size"])
    assert mixing.mix(docs.limit(0)).count() == 0


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 0, None: 0}, {"a": 5, "b": 1000, None: 3}, {"a": 1, "b": 1, "c": 1, "d": 1, "e": 9},
                                   {f"s{i:02d}": 3 ** i for i in range(12)}, {"Z": 4, "a": 4, "\u00e9": 40, "\U0001f600": 400, "\uffff": 4}])
def test_targets_of_sources(spark, sizes):
    table = spark.createDataFrame([(k, n, 1) for k, n in sizes.items()], "source string, size long, docs long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    assert got == pytest.approx(brute.mix_targets(sizes))
    plan = mixing.source_targets(table)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_character_features():
    texts = ["", "a", "abc", "h\u00e9llo w\u00f6rld", "\u65e5\u672c\u8a9e\u30c6\u30ad", "", "\U0001f600\U0001f600\U0001f600\U0001f600", "llo "]
    data, offsets = text_buffer(pa.array(texts))
    got = features.families(Words(data, offsets, lower=False), offsets)
    for (index, bounds), n in zip(got[1:], (3, 4)):
        grams = [[t[j:j + n] for j in range(len(t) - n + 1)] for t in texts]
        assert np.diff(bounds).tolist() == [len(g) for g in grams]
        flat = [g for one in grams for g in one]
        cells = {}
        assert all(cells.setdefault(g, i) == i for g, i in zip(flat, index.tolist())) and len(set(cells.values())) == len(cells)


def test_quality(spark, docs, labels):
    model = quality_rules.fit(docs, labels)
    got = quality_rules.apply_rules(docs, model).collect()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == \
            brute.statistics(r["doc"]["text"])
    assert all(r["kept"] for r in cotraining.classify(docs, cotraining.fit(docs, labels.limit(0))).collect())
    assert cotraining.classify(docs, cotraining.fit(docs, labels)).count() == len(DOCS)


def test_language_model(spark, docs):
    got = lm.score(docs, F.col("doc_id") == 9).select("doc.doc_id", "n_tokens", "base_score", "score").collect()
    assert len(got) == len(DOCS) and {r[0]: r[1] for r in got}[2] == 1 and all(r[2] < 0 and r[3] < 0 for r in got)
    assert lm.score(docs.limit(0), F.lit(False)).count() == 0


def test_pages(spark):
    shell = "<html><body><nav><li>Home</li></nav>{}<footer>Same foot</footer></body></html>"
    rows = [(1, "http://h/a", shell.format("<div>First body text that is long</div>"), "x"),
            (2, "http://h/b", shell.format("<article>Second<div class='comments'>Nice!</div> &amp; one</article><aside>s</aside>"), "x"),
            (3, None, None, None), (4, "http://h/c", "", "x"), (5, "http://h/a", shell.format("<div>First body text that is long</div>"), "x"),
            (6, "not a url", "<p>un<b>closed", "x"), (None, "http://k/", "<script>var a='</p>'</script><p>k", "x")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["doc"]["page_id"]: r["text"] for r in pages.extract(table).collect()}
    assert got == {1: "First body text that is long", 2: "Second\n\n& one", 3: "", 4: "", 5: "First body text that is long",
                   6: "unclosed", None: "k"}
    assert pages.extract(table.limit(0)).count() == 0


def test_shared_lines_are_a_longest_common_subsequence():
    pick = random.Random(2)
    for _ in range(300):
        a = [pick.choice("abcd") for _ in range(pick.randint(0, 12))]
        b = [pick.choice("abcd") for _ in range(pick.randint(0, 12))]
        length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                length[i + 1][j + 1] = length[i][j] + 1 if x == y else max(length[i][j + 1], length[i + 1][j])
        kept = [x for x, s in zip(a, pages.shared(a, b)) if s]
        it = iter(b)
        assert len(kept) == length[-1][-1] and all(x in it for x in kept)


def test_slices_never_cut_a_text():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 50, "", "c"])], ["text"])
    got = [p.column("text").to_pylist() for p in slices([batch], "text", 20)]
    assert got == [["a" * 10, None], ["b" * 50], ["", "c"]] or [x for p in got for x in p] == batch.column("text").to_pylist()


def _site(n, body, url="http://h/{:03d}"):
    page = "<html><body>{}<footer>f{}</footer></body></html>"
    return [(i, url.format(i), page.format(body(i), i)) for i in range(n)]


def _words(i, n=30):
    return " ".join(f"w{i}x{j}" for j in range(n))


def test_pages_lose_shared_lines_of_the_article_too():
    """No class or element tells the share bar and the notice from the article."""
    rows = _site(9, lambda i: f"<article><div>Tell your friends</div><p>{_words(i)}</p>{'<p>Quoted by two</p>' * (i in (2, 7))}"
                              "<div>All rights kept</div></article>")
    found = [pages.lines(r[2]) for r in rows]
    near = [[found[j] for j in range(max(0, i - 3), min(9, i + 4)) if j != i] for i in range(9)]
    for i in range(9):
        assert pages.main_text(found[i], near[i]) == _words(i) + ("\n\nQuoted by two" if i in (2, 7) else "")
    assert pages.main_text(found[0], [found[0], found[0]]) == "\n\n".join(x.text for x in found[0] if not x.furniture)
    assert "Tell your friends" in pages.main_text(found[0], [found[1]])


def test_pages_pass_copies_and_range_edges(spark):
    """Short articles in a large template without marks, a long group of copies, and
    any number of ranges."""
    rows = _site(40, lambda i: f"<div>{_words('t', 60)}</div><div>{_words(i if not 10 <= i < 25 else 10, 15)}</div><div>{_words('u', 60)}</div>")
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 7, 23):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {r["doc"]["page_id"]: r["text"] for r in pages.extract(table).collect()}
            assert got == {i: _words(i if not 10 <= i < 25 else 10, 15) for i in range(40)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_filter_keeps_every_bigram_at_any_size(spark):
    """Two blocks of the same words in another order, far more bigrams than ``bits``."""
    words = [f"v{i}" for i in range(3000)]
    texts = [" ".join(words), " ".join(words[::-1]), " ".join(words[:50] * 9)]
    for text in texts:
        docs = spark.createDataFrame([(1, text), (2, "only held out")], "doc_id long, text string")
        table = lm.blocks(docs, "text", F.col("doc_id") == 2, ["doc_id"]).cache()
        got = lm.levels(table, 3, 64).collect()
        level = np.concatenate([np.frombuffer(r["levels"], np.uint8) for r in got])
        tokens = ["", *text.split(), ""]
        known = len(set(zip(tokens, tokens[1:])))
        assert known <= (level > 0).sum() <= known + 4 and len(level) == known + 4
        assert lm.counts(level).sum() >= len(tokens) / 2
    both = lm.blocks(spark.createDataFrame([(1, texts[0])], "i long, text string"), "text", F.lit(False), ["i"]).union(
        lm.blocks(spark.createDataFrame([(1, texts[1])], "i long, text string"), "text", F.lit(False), ["i"]))
    assert both.select("block").distinct().count() == 2


def test_language_learns_the_whole_text(spark):
    """Every document opens with the same long notice in another language."""
    pick = random.Random(9)
    notice = " ".join(f"the {w} of this house" for w in ("owner", "keeper", "reader", "writer") * 4)
    word = {"en": ["the", "house", "reader", "keeper", "of", "this"], "xx": ["ombra", "dolce", "verrai", "quiete", "solo"],
            "yy": ["gruz", "plamt", "skov", "drenk", "vistl"]}
    rows = [(f"{k}{i}", k, notice + " " + " ".join(pick.choices(word[k], k=300))) for k in word for i in range(150)]
    model = language.fit(spark.createDataFrame(rows, "doc_id string, lang string, text string"))
    texts = [" ".join(pick.choices(word[k], k=40)) for k in word]
    got = language.phrases(texts, model, language.symbol_table(model.symbol))[0] * model.cost
    assert [model.languages[i] for i in got.argmin(1)] == list(word)
    assert got[1, 2] > 5 * got[1, 1] and got[2, 1] > 5 * got[2, 2]


def test_language_tells_letters_beyond_the_alphabet(spark):
    pick = random.Random(4)
    sets = {"ab": [chr(0x61 + i) for i in range(26)] + [chr(0x430 + i) for i in range(32)] + [chr(0x3b1 + i) for i in range(16)],
            "zb": [chr(0x4e00 + i) for i in range(300)], "zc": [chr(0x5e00 + i) for i in range(300)]}
    text = lambda k, n: "".join(pick.choices(sets[k], k=n))
    rows = [(f"{k}{i}", k, text(k, 2000 if k == "ab" else 400)) for k in sets for i in range(12)]
    model = language.fit(spark.createDataFrame(rows, "doc_id string, lang string, text string"))
    got = language.phrases([text(k, 200) for k in sets], model, language.symbol_table(model.symbol))[0] * model.cost
    assert [model.languages[i] for i in got.argmin(1)] == list(sets)
    assert got[1, 2] > 1.1 * got[1, 1] and got[2, 1] > 1.1 * got[2, 2]


def test_components_of_stars_need_no_round_and_chains_end(spark):
    """A round on what is stars already, to see that it changes nothing, took most tasks of the join."""
    stars = spark.createDataFrame([(5, 1), (1, 7), (9, 2), (9, 9), (5, 1), (None, 3)], "u long, v long")
    assert sorted(map(tuple, components(stars, max_rounds=0).collect())) == [(1, 1), (2, 2), (5, 1), (7, 1), (9, 2)]
    assert components(stars.limit(0), max_rounds=0).count() == 0
    chain = [3, 14, 1, 5, 9, 2, 6, 8, 7, 11]
    edges = spark.createDataFrame([*zip(chain, chain[1:]), (20, 30), (30, 25), (20, 25)], "u long, v long")
    with pytest.raises(RuntimeError, match="not settled"):
        components(edges, max_rounds=0)
    assert sorted(map(tuple, components(edges).collect())) == sorted([(n, 1) for n in chain] + [(n, 20) for n in (20, 25, 30)])


def test_release_memory_does_not_search_the_modules_again():
    release_memory()
    assert gc.get_freeze_count() > 0
