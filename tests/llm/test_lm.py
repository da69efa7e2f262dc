"""Blocks of equal content in the language model."""

from pyspark.sql import functions as F

from tallyhouse.llm import lm


def test_equal_blocks_share_one_answer(spark):
    docs = spark.range(0, 10, 1, 10).select(F.col("id").alias("doc_id"), F.lit("a b c a b").alias("text"))
    table = lm.blocks(docs, "text", F.lit(False), ["doc_id"])
    got = lm.unigrams(table, 4).where("block IS NOT NULL").groupBy("block", "part").count().collect()
    assert got and {r["count"] for r in got} == {1}
    levels = lm.levels(table, 4, 64).groupBy("block", "part").count().collect()
    assert levels and {r["count"] for r in levels} == {1}
    rows = lm.score(docs, F.lit(False)).collect()
    assert sorted(r["doc"]["doc_id"] for r in rows) == list(range(10))
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows} == {(6, 6, 60)}
    assert len({(r["base_score"], r["score"]) for r in rows}) == 1
