"""Marts (N8–N10) over the staging tables.

Each mart pre-aggregates the orders on the join key before joining the
dimension, so the join sees one row per key (a user or product with a third
of all orders becomes one row per map task after the partial aggregate) and
the dimension join never shuffles the raw fact rows. Whether the dimension is
broadcast is left to AQE, which decides on measured runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.exprs import month_of
from tallyhouse.operators.ranges import rank_by
from tallyhouse.operators.segments import segment
from tallyhouse.operators.series import mom_growth

def mart_order(name: str) -> list[Column]:
    """The order in which a mart is stored, ended by its key so that it is total."""
    country, month = F.col("country").asc_nulls_first(), F.col("month").asc_nulls_first()
    rank, category = F.col("revenue_rank").asc_nulls_first(), F.col("category").asc_nulls_first()
    segments = [F.col("segment").asc_nulls_first(), F.col("total_revenue_czk").desc_nulls_first(), F.col("user_id").asc_nulls_first()]
    return {"monthly_revenue_by_country": [country, month], "category_performance": [rank, category], "user_segments": segments}[name]


def valid_completed(stg_orders: DataFrame) -> DataFrame:
    """Orders that count as revenue: completed and not suspicious."""
    return stg_orders.filter((F.col("status") == "completed") & (F.col("is_revenue_suspicious") == 0))


def monthly_revenue(stg_orders: DataFrame, stg_users: DataFrame) -> DataFrame:
    """(month, country, revenue_czk) before the window step; orders whose user
    is unknown or has no valid country land in 'UNKNOWN'."""
    per_user_month = (valid_completed(stg_orders)
                      .filter(F.col("order_date").isNotNull())
                      .groupBy("user_id", month_of("order_date").alias("month"))
                      .agg(F.sum("revenue_czk").alias("revenue_czk")))
    users = stg_users.select("user_id", "country")
    return (per_user_month.join(users, on="user_id", how="left")
            .groupBy("month", F.coalesce(F.col("country"), F.lit("UNKNOWN")).alias("country"))
            .agg(F.sum("revenue_czk").alias("revenue_czk")))


def monthly_revenue_by_country(stg_orders: DataFrame, stg_users: DataFrame,
                               ordered: bool = False) -> DataFrame:
    """Monthly revenue per country with the previous month and MoM %."""
    out = mom_growth(monthly_revenue(stg_orders, stg_users), "country", "month", "revenue_czk")
    out = out.select("month", "country", "revenue_czk", "prev_month_revenue_czk", "mom_growth_pct")
    return out.orderBy(*mart_order("monthly_revenue_by_country")) if ordered else out


def category_totals(stg_orders: DataFrame, stg_products: DataFrame) -> DataFrame:
    """Per category: revenue, order-weighted margin and discount sums/counts,
    distinct orders.

    Orders are reduced per product first. ``order_id`` is the key of
    ``stg_orders`` (one row per id), so the distinct-order count of a category
    is the count of non-NULL ids — no (category, order_id) shuffle needed.
    """
    per_product = (valid_completed(stg_orders)
                   .filter(F.col("product_id").isNotNull())
                   .groupBy("product_id")
                   .agg(F.sum("revenue_czk").alias("revenue"),
                        F.count(F.lit(1)).alias("n_rows"),
                        F.count("order_id").alias("n_orders"),
                        F.sum("discount_pct").alias("discount_sum"),
                        F.count("discount_pct").alias("discount_n")))
    products = stg_products.filter(F.col("category").isNotNull()).select("product_id", "category", "margin_pct")
    return (per_product.join(products, on="product_id", how="inner")
            .groupBy("category")
            .agg(F.sum("revenue").alias("total_revenue_czk"),
                 F.sum(F.col("margin_pct") * F.col("n_rows")).alias("margin_sum"),
                 F.sum(F.when(F.col("margin_pct").isNotNull(), F.col("n_rows"))).alias("margin_n"),
                 F.sum("n_orders").alias("order_count"),
                 F.sum("discount_sum").alias("discount_sum"),
                 F.sum("discount_n").alias("discount_n")))


def _avg4(total: str, count: str) -> Column:
    # exact-enough mean rounded half-up to 4 places: DECIMAL(28,4)/DECIMAL(18,0)
    # keeps 14 fractional digits before the final rounding
    num = F.col(total).cast("decimal(28,4)")
    den = F.col(count).cast("decimal(18,0)")
    return F.when(den > 0, F.round(num / den, 4)).cast("decimal(5,4)")


def category_performance(stg_orders: DataFrame, stg_products: DataFrame, ordered: bool = False) -> DataFrame:
    """Revenue, average margin and discount, order count and revenue rank per category."""
    totals = category_totals(stg_orders, stg_products)
    shaped = totals.select(
        F.col("category"),
        F.col("total_revenue_czk"),
        _avg4("margin_sum", "margin_n").alias("avg_margin_pct"),
        F.coalesce(F.col("order_count"), F.lit(0)).cast("bigint").alias("order_count"),
        _avg4("discount_sum", "discount_n").alias("avg_discount_pct"),
    )
    ranked = rank_by(shaped, "total_revenue_czk", "revenue_rank")
    out = ranked.select("category", F.col("total_revenue_czk").cast("decimal(18,2)").alias("total_revenue_czk"),
                        "avg_margin_pct", "order_count", "avg_discount_pct", "revenue_rank")
    return out.orderBy(*mart_order("category_performance")) if ordered else out


def user_metrics(stg_users: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Per staged user: valid completed order count, revenue (0 when none)
    and last order date. Users without such orders are kept."""
    per_user = (valid_completed(stg_orders)
                .filter(F.col("user_id").isNotNull())
                .groupBy("user_id")
                .agg(F.count("order_id").alias("__orders"),
                     F.sum("revenue_czk").alias("__revenue"),
                     F.max("order_date").alias("last_order_date")))
    users = stg_users.select("user_id", "country", "age_group", "registered_at")
    return (users.join(per_user, on="user_id", how="left")
            .select("user_id", "country", "age_group", "registered_at",
                    F.coalesce(F.col("__orders"), F.lit(0)).alias("order_count"),
                    F.coalesce(F.col("__revenue"), F.lit(0)).alias("total_revenue_czk"),
                    "last_order_date"))


def user_segments(stg_users: DataFrame, stg_orders: DataFrame, ordered: bool = False) -> DataFrame:
    """Per-user frequency, revenue, recency and segment.

    The reference date is the newest order date over all staged orders, a
    scalar subquery evaluated once (no cross join).
    """
    as_of = stg_orders.agg(F.max("order_date")).scalar()
    seg = segment(user_metrics(stg_users, stg_orders), as_of)
    out = seg.select(
        F.col("user_id").cast("string"), F.col("country").cast("string"), F.col("age_group").cast("string"),
        F.col("registered_at").cast("date"), F.col("last_order_date").cast("date"),
        F.col("order_count").cast("bigint"), F.col("total_revenue_czk").cast("decimal(18,2)"),
        F.col("days_since_registered").cast("bigint"), F.col("days_since_last_order").cast("bigint"),
        F.col("segment").cast("string"))
    return out.orderBy(*mart_order("user_segments")) if ordered else out
