"""Ranks and row numbers by ranges: against plain sorts, with ties across ranges, NULLs, hot values; plan shape."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from testkit import SF_SMALL
from tallyhouse.operators.ranges import rank_by, row_numbers
from tallyhouse.plans import job
from tallyhouse.session import shared_dir
from tallyhouse.sources import raw_sources


def ranks(values):
    key = lambda v: (v is None, v if v is not None else 0)
    return [1 + sum(key(w) > key(v) for w in values) for v in values]


@pytest.fixture
def many_ranges(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


@pytest.mark.parametrize("share", [0.0, 0.3, 0.9, 1.0])
def test_rank_with_ties_and_nulls(spark, many_ranges, share):
    pick = random.Random(round(share * 10))
    values = [None if pick.random() < 0.1 else 7 if pick.random() < share else pick.randint(0, 40) for _ in range(600)]
    table = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    ranked = rank_by(table, "v", "rank")
    got = sorted((r["id"], r["rank"]) for r in ranked.collect())
    assert got == list(enumerate(ranks(values)))


def test_a_hot_value_fills_several_ranges(spark, many_ranges):
    table = spark.range(4000).select("id", F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id")).alias("v"))
    ranked = rank_by(table, "v")
    files = [r["n"] for r in ranked.where("v = 5").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert ranked.where("v = 5").select("rank").distinct().count() == 1 and len(files) > 1
    assert ranked.where("v <> 5").agg(F.countDistinct("rank")).first()[0] == table.where("v <> 5").count()


def test_rank_of_other_types_and_empty_tables(spark, many_ranges):
    nan = float("nan")
    table = spark.createDataFrame([(1.5,), (nan,), (nan,), (None,), (-0.0,), (0.0,)], "v double")
    assert sorted((str(r["v"]), r["rank"]) for r in rank_by(table, "v").collect()) == sorted(
        [("1.5", 4), ("nan", 2), ("nan", 2), ("None", 1), ("-0.0", 5), ("0.0", 5)])
    days = spark.createDataFrame([(dt.date(2024, 1, 2),), (dt.date(2024, 1, 1),)], "v date")
    assert sorted((r["v"].day, r["rank"]) for r in rank_by(days, "v").collect()) == [(1, 2), (2, 1)]
    assert rank_by(table.limit(0), "v").count() == 0 and row_numbers(table.limit(0), [F.col("v")]).count() == 0


def test_row_numbers_are_positions(spark, many_ranges):
    pick = random.Random(3)
    rows = [(i, pick.choice([None, "a", "b", "ž"]), pick.randint(0, 5)) for i in range(500)]
    table = spark.createDataFrame(rows, "id int, s string, n int")
    got = row_numbers(table, [F.col("s").asc_nulls_first(), F.col("n").desc(), F.col("id").asc()])
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", -r[2], r[0]))
    assert [tuple(r)[:3] for r in sorted(got.collect(), key=lambda r: r["row_nr"])] == want
    assert sorted(r["row_nr"] for r in got.collect()) == list(range(1, 501))


def test_no_task_sees_all_rows(spark, many_ranges):
    table = spark.range(100).withColumn("v", F.col("id") % 7)
    for got in (rank_by(table, "v"), row_numbers(table, [F.col("v").asc(), F.col("id").asc()])):
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and not re.search(r"Window .*\[\], \[", plan)


def test_stored_marts_lie_in_their_order(spark):
    raw = raw_sources(spark, SF_SMALL)
    res = job.refresh(spark, raw, shared_dir(spark), run_audit=False)
    files = res.table(spark, "user_segments").select("segment", "total_revenue_czk", "user_id", F.col("_metadata.file_name").alias("file"),
                                                     F.monotonically_increasing_id().alias("at")).collect()
    rows = sorted(files, key=lambda r: (r["file"], r["at"]))
    key = lambda r: (r["segment"], -r["total_revenue_czk"], r["user_id"] or "")
    assert [key(r) for r in rows] == sorted(map(key, rows)) and len(rows) > 100
