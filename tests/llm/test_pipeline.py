"""The pipeline end to end, and the rows that its stages must keep."""

from pyspark.sql import functions as F

import brute
import corpus_pipeline as P

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], SCHEMA)


def words(seed, n=40):
    return " ".join(f"{seed}{k}" for k in range(n))


def test_dedup_decides_by_row(spark):
    a, b, c, d = (words(x) for x in "abcd")
    rows = [(1, a, "en"), (5, a, "en"), (5, b, "en"), (7, c, "en"), (7, d, "en"), (7, d, "en"), (8, d + " more", "en"),
            (None, a, "en"), (None, a, "en"), (9, "", "en"), (9, "", "en"), (10, None, "en")]
    got = sorted(map(str, ((r["doc_id"], r["text"]) for r in P.jaccard_dedup(spark, table(spark, rows), SF).collect())))
    assert got == sorted(map(str, [(1, a), (5, b), (7, c), (7, d), (None, a), (None, a), (9, ""), (9, ""), (10, None)]))
    assert P.jaccard_dedup(spark, table(spark, rows).limit(0), SF).count() == 0


def test_language_stage_keeps_all_letters_where_nothing_is_taught(spark):
    rows = [(1, "some words", None), (2, "漢字", None), (3, "12 34", None), (4, None, None), (5, "", None)]
    assert sorted(r["doc_id"] for r in P.language_id(spark, table(spark, rows), SF).collect()) == [1, 2]


def test_run_end_to_end(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    pieces = P.run(spark, SF)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = pieces.collect()
    kept = {r["doc_id"] for r in rows}
    # one document of a group, all with letters, and every clean labelled one that is the first of its group
    texts = [(i, r["text"]) for i, r in docs.items()]
    component = {i: c for i, (_, c) in brute.jaccard_components(texts).items()}
    assert len({component[i] for i in kept}) == len(kept)
    assert all(any(x.isalpha() for x in docs[i]["text"]) for i in kept)
    clean = [i for i, q in quality.items() if q == 1 and component[i] == i and docs[i]["text"]]
    copies = pieces.where("start = 0").groupBy("doc_id").count()
    assert copies.agg(F.max("count")).first()[0] <= 2 and kept
    assert sum(i in kept for i in clean) >= 0.6 * len(clean)  # mixing leaves some out
    # sequences are full and gapless, pieces are those of the whole texts
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert [v for _, v in sorted(filled.items())][:-1] == [2048] * (len(filled) - 1)
    some = sorted(kept)[:30]
    ids = dict(zip(some, brute.token_ids([docs[i]["text"] for i in some], P.TOKENIZER)))
    for r in rows:
        if r["doc_id"] in ids:
            assert brute.crc_ids(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]) == r["ids_crc32"]


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in P.STAGES] == ["quality classifier", "language ID", "n-gram Jaccard join", "mixing", "packing"]
