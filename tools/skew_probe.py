"""Skew probe: monthly revenue on 3M orders where one user holds a third of
the rows and another third has no user, with broadcast joins disabled (the
users table treated as too big). Compares the largest shuffle read of any
single task for the pre-aggregated plan against a join-first plan, from
Spark's event log written to a fresh scratch folder.

usage: python tools/skew_probe.py
"""
import glob
import json
import os
import sys
import tempfile

import zstandard

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
EVDIR = tempfile.mkdtemp(prefix="skew-probe-")
sys.path.insert(0, HERE)
sys.path.insert(0, os.path.join(HERE, "tests"))
from pyspark.sql import SparkSession, functions as F
from tallyhouse.session import apply_conf
spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled","false")
         .config("spark.ui.showConsoleProgress","false").config("spark.sql.shuffle.partitions","16")
         .config("spark.sql.adaptive.enabled","true")
         .config("spark.sql.autoBroadcastJoinThreshold","-1")   # force shuffle joins (users too big to broadcast)
         .config("spark.driver.memory","8g")
         .config("spark.eventLog.enabled","true").config("spark.eventLog.dir", EVDIR).getOrCreate())
apply_conf(spark)
spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
spark.sparkContext.setLogLevel("ERROR")
import test_skew as T  # noqa: E402
T.N = 3_000_000
from tallyhouse.plans.marts import monthly_revenue_by_country, valid_completed
from tallyhouse.functions.exprs import month_of
orders = T.skewed_orders(spark)
users = spark.range(501).select(F.when(F.col("id") == 500, "hot").otherwise(F.col("id").cast("string")).alias("user_id"), F.lit("CZ").alias("country"))
sc = spark.sparkContext
sc.setJobGroup("ours", "ours")
monthly_revenue_by_country(orders, users).write.format("noop").mode("overwrite").save()
sc.setJobGroup("naive", "naive")
naive = (valid_completed(orders).filter("order_date is not null").join(users, "user_id", "left")
         .groupBy(month_of("order_date").alias("month"), F.coalesce("country", F.lit("UNKNOWN")).alias("country"))
         .agg(F.sum("revenue_czk")))
naive.write.format("noop").mode("overwrite").save()
spark.stop()
d = sorted(glob.glob(os.path.join(EVDIR, "*")))[-1]
text = ""
for f in sorted(glob.glob(d + "/*.zstd")):
    with zstandard.ZstdDecompressor().stream_reader(open(f, 'rb')) as r:
        text += r.read().decode()
job_group, stage_group = {}, {}
per_stage = {}
for line in text.splitlines():
    e = json.loads(line)
    if e["Event"] == "SparkListenerJobStart":
        g = e.get("Properties", {}).get("spark.jobGroup.id")
        for s in e["Stage IDs"]: stage_group[s] = g
    if e["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in e:
        m = e["Task Metrics"]; sr = m.get("Shuffle Read Metrics", {})
        recs = sr.get("Total Records Read", 0)
        per_stage.setdefault(e["Stage ID"], []).append(recs)
for g in ("ours", "naive"):
    worst = max((max(v), s) for s, v in per_stage.items() if stage_group.get(s) == g)
    tot = sum(sum(v) for s, v in per_stage.items() if stage_group.get(s) == g)
    print(g, "max shuffle records read by one task:", worst[0], "total shuffle records:", tot)
