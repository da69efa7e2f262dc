"""Hot keys: a third of the orders on one user, a third without a user, half
on one product, a third without an order id. The plans pre-aggregate (or
limit) map-side, so these groups never land whole on one reducer; here we
check the results stay exact against brute force in pandas."""

from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import keep_best
from tallyhouse.plans.marts import category_performance, monthly_revenue_by_country, user_segments

N = 30000


def skewed_orders(spark):
    i = F.col("id")
    return spark.range(N, numPartitions=8).select(
        F.when(i % 3 == 0, F.lit(None)).otherwise(i.cast("string")).alias("order_id"),
        F.when(i % 3 == 1, F.lit("hot")).when(i % 3 == 2, F.lit(None))
         .otherwise((i % 500).cast("string")).alias("user_id"),
        F.when(i % 2 == 0, F.lit("p_hot")).otherwise(F.concat(F.lit("p"), (i % 7).cast("string"))).alias("product_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), (i % 400).cast("int")).alias("order_date"),
        F.lit(1).cast("decimal(38,0)").alias("quantity"),
        F.when(i % 10 == 0, F.lit("cancelled")).otherwise(F.lit("completed")).alias("status"),
        ((i % 97) + F.lit(0.5)).cast("decimal(18,2)").alias("revenue_czk"),
        ((i % 5) / 100).cast("decimal(6,4)").alias("discount_pct"),
        F.when(i % 11 == 0, 1).otherwise(0).alias("is_revenue_suspicious"),
        F.lit(0).alias("is_status_unknown"),
        F.lit(0).alias("is_quantity_invalid"),
    )


def test_hot_keys_monthly_and_category(spark):
    orders = skewed_orders(spark)
    users = spark.createDataFrame([("hot", "CZ")] + [(str(k), "SK" if k % 2 else None) for k in range(500)],
                                  "user_id string, country string") \
        .select("user_id", "country", F.lit("18-24").alias("age_group"),
                F.lit("2022-06-01").cast("date").alias("registered_at"))
    products = spark.createDataFrame([("p_hot", "Hot", "0.1000")] + [(f"p{k}", f"C{k % 3}", "0.2000") for k in range(7)],
                                     "product_id string, category string, margin_pct string") \
        .withColumn("margin_pct", F.col("margin_pct").cast("decimal(6,4)"))

    po, pu = orders.toPandas(), users.toPandas()
    valid = po[(po.status == "completed") & (po.is_revenue_suspicious == 0)]

    got = {(r.month, r.country): r.revenue_czk for r in monthly_revenue_by_country(orders, users).collect()}
    m = valid.merge(pu[["user_id", "country"]], on="user_id", how="left")
    m.loc[m.user_id.isna(), "country"] = None                 # NULL keys never match
    m["country"] = m.country.fillna("UNKNOWN")
    m["month"] = pd.to_datetime(m.order_date).dt.to_period("M").dt.to_timestamp().dt.date
    expected = m.groupby(["month", "country"]).revenue_czk.apply(lambda s: sum(s, Decimal(0))).to_dict()
    assert got == expected

    pp = products.toPandas()
    c = valid.merge(pp, on="product_id")
    exp_cat = {k: (sum(g.revenue_czk, Decimal(0)), g.order_id.nunique()) for k, g in c.groupby("category")}
    got_cat = {r.category: (r.total_revenue_czk, r.order_count) for r in category_performance(orders, products).collect()}
    assert got_cat == exp_cat

    seg = {r.user_id: r for r in user_segments(users, orders).collect()}
    hot = valid[valid.user_id == "hot"]
    assert seg["hot"].total_revenue_czk == sum(hot.revenue_czk, Decimal(0))
    assert seg["hot"].order_count == hot.order_id.notna().sum()


def test_keep_best_with_a_third_null_keys(spark):
    df = spark.range(N, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 1000).cast("string")).alias("k"),
        F.col("id").alias("v"))
    best = keep_best(df, "k", [F.col("v").desc()])
    rows = {r.k: r.v for r in best.collect()}
    pdf = df.toPandas()
    assert rows[None] == pdf[pdf.k.isna()].v.max()
    assert len(rows) == 1001 and rows["1"] == pdf[pdf.k == "1"].v.max()
