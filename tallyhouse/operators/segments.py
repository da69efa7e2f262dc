"""Recency / value segmentation of users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the segmentation rules (first match wins).
LOST_AFTER_DAYS = 365
HIGH_VALUE_ABOVE = 20000
AT_RISK_AFTER_DAYS = 180
NEW_USER_WITHIN_DAYS = 180
SEGMENT_RULES = ("lost", "high_value", "at_risk", "new_user", "regular")


def segment(df: DataFrame, as_of: Column, registered: str = "registered_at",
            last_order: str = "last_order_date", revenue: str = "total_revenue_czk") -> DataFrame:
    """Add ``days_since_registered``, ``days_since_last_order`` and ``segment``.

    ``as_of`` is a scalar column (e.g. ``stg_orders.agg(max(...)).scalar()``,
    a scalar subquery evaluated once), so no join is needed to attach it.
    """
    # attach the scalar once; both differences read the column
    with_ref = df.withColumn("__as_of", as_of)
    ref = F.col("__as_of")
    since_reg = F.datediff(ref, F.col(registered)).cast("bigint")
    since_last = F.when(F.col(last_order).isNull(), F.lit(None)).otherwise(
        F.datediff(ref, F.col(last_order))).cast("bigint")
    out = with_ref.withColumns({"days_since_registered": since_reg,
                                "days_since_last_order": since_last}).drop("__as_of")
    seg = (F.when(F.col(last_order).isNull() | (F.col("days_since_last_order") > LOST_AFTER_DAYS), "lost")
            .when(F.col(revenue) > HIGH_VALUE_ABOVE, "high_value")
            .when(F.col("days_since_last_order") > AT_RISK_AFTER_DAYS, "at_risk")
            .when(F.col("days_since_registered") < NEW_USER_WITHIN_DAYS, "new_user")
            .otherwise("regular"))
    return out.withColumn("segment", seg)
