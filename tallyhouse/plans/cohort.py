"""Cohort retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.cohort import COHORT_OFFSETS, cohort_activity, cohort_sizes, pivot_cohort


def active_orders(stg_orders: DataFrame) -> DataFrame:
    """Completed orders whose raw status was a known value (the suspicious
    revenue flag is *not* applied here)."""
    return stg_orders.filter((F.col("status") == "completed") & (F.col("is_status_unknown") == 0))


def cohort_activity_long(user_segments: DataFrame, stg_orders: DataFrame,
                         offsets: Sequence[int] = COHORT_OFFSETS) -> DataFrame:
    """(cohort_month DATE, offset, users) — distinct active users per cohort and offset."""
    return cohort_activity(user_segments, active_orders(stg_orders), offsets)


def cohort_retention(user_segments: DataFrame, stg_orders: DataFrame,
                     offsets: Sequence[int] = COHORT_OFFSETS, ordered: bool = False) -> DataFrame:
    """Registration-month cohorts with users and % active in months 0..3.

    Cohorts with no activity keep zero counts.
    """
    sizes = cohort_sizes(user_segments)
    activity = cohort_activity_long(user_segments, stg_orders, offsets)
    out = pivot_cohort(sizes, activity, offsets)
    return out.orderBy("cohort_month") if ordered else out
