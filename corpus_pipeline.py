"""Corpus pipeline: filter, deduplicate, mix and pack ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run`
writes each result as Parquet in the shared folder and hands it to the next.
All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import cotraining, language, mixing, ngram_join, packing
from tallyhouse.llm.common import bounded_batches, stored
from tallyhouse.llm.queries import TOKENIZER


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    bounded_batches(spark)
    model = cotraining.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return cotraining.classify(docs, model).where("kept").select("doc.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that the labelled rows teach; null
    texts and texts without a letter go. Where no row has a language, nothing is
    taught and every text with a letter stays."""
    bounded_batches(spark)
    model = language.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return language.identify(docs, model).where(F.col("lang_pred") != language.UNKNOWN).select("doc.*")


def _row_key() -> Column:
    """Rows of one key have the same id and text, so they are repeats of a document."""
    return F.xxhash64("doc_id", "text")


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest id, once. Rows
    without id, and texts without words, are no duplicates of anything. Decided by
    id and text: where an id stands for several texts, each is a document."""
    bounded_batches(spark)
    keyed = docs.where("doc_id IS NOT NULL").select(_row_key().alias("key"), "doc_id", "text")
    groups = (ngram_join.jaccard_join(keyed, doc_id="key").where("n_shingles > 0")
              .groupBy(F.col("doc_id").alias("key"), F.col("component_id").alias("of")).agg(F.count("*").alias("times")))
    ids = keyed.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    groups = stored(groups.join(ids, "key"), "pipeline-groups")
    stays = groups.groupBy("of").agg(F.min(F.struct("doc_id", "key")).alias("first")).select(F.col("first.key").alias("key"), F.lit(True).alias("stays"))
    decided = groups.join(stays, "key", "left").select("key", "times", F.coalesce("stays", F.lit(False)).alias("stays"))
    # rows that are alone in their group and unrepeated need no decision
    gone = stored(decided.where("NOT stays").select("key"), "pipeline-gone")
    again = stored(decided.where("stays AND times > 1").select("key"), "pipeline-again")
    left = docs.withColumn("__key", F.when(F.col("doc_id").isNotNull(), _row_key()))
    left = left.join(gone, F.col("__key") == gone["key"], "left_anti")
    once = left.join(again, F.col("__key") == again["key"], "left_semi").dropDuplicates(["__key"])
    return left.join(again, F.col("__key") == again["key"], "left_anti").unionByName(once).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    got = mixing.mix(docs).where("copies > 0")
    return got.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    bounded_batches(spark)
    got = packing.ids_crc32(packing.pack(docs, TOKENIZER, payload=["doc_id"]))
    return got.select("doc.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality classifier", quality_classifier), ("language ID", language_id), ("n-gram Jaccard join", jaccard_dedup),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Models are trained on the way; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what its predecessor kept; the pieces of
    the packed sequences. Columns that ``documents`` has beside its own are carried
    along; an empty table gives no pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
