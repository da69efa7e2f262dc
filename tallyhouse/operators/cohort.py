"""Registration-month cohorts and their monthly activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.exprs import month_index, month_of, retention_pct

COHORT_OFFSETS = (0, 1, 2, 3)


def cohort_sizes(users: DataFrame, user: str = "user_id", registered: str = "registered_at") -> DataFrame:
    """(cohort_month DATE, cohort_size): distinct users per registration month;
    users without a registration month, and blank ids, are left out."""
    return (users.select(F.col(user), month_of(registered).alias("cohort_month"))
                 .filter(F.col("cohort_month").isNotNull() & (F.trim(F.col(user).cast("string")) != ""))
                 .groupBy("cohort_month")
                 .agg(F.count_distinct(F.col(user)).alias("cohort_size")))


def cohort_activity(users: DataFrame, events: DataFrame, offsets: Sequence[int] = COHORT_OFFSETS,
                    user: str = "user_id", registered: str = "registered_at",
                    event_date: str = "order_date") -> DataFrame:
    """Long form (cohort_month DATE, offset INT, users BIGINT): distinct users
    of a cohort active ``offset`` whole calendar months after registering.

    Blank ids are nobody, and users are reduced to distinct (user, month)
    pairs first, so a user listed twice counts once. Events are first reduced to distinct (user, month) pairs — map-side combined, so
    a user with a third of all orders ships one row per task and month — and
    only then joined to the users; after that join each row is one distinct
    (cohort, offset, user), so a plain count is the distinct-user count.
    """
    real = F.col(user).isNotNull() & (F.trim(F.col(user).cast("string")) != "")
    active = (events.filter(real & F.col(event_date).isNotNull())
                    .select(F.col(user), month_of(event_date).alias("event_month"))
                    .distinct())
    cohorts = (users.filter(real)
                    .select(F.col(user), month_of(registered).alias("cohort_month"))
                    .filter(F.col("cohort_month").isNotNull()).distinct())
    offset = (month_index("event_month") - month_index("cohort_month")).cast("int")
    return (active.join(cohorts, on=user, how="inner")
                  .select("cohort_month", offset.alias("offset"))
                  .filter(F.col("offset").isin(*offsets))
                  .groupBy("cohort_month", "offset")
                  .agg(F.count(F.lit(1)).alias("users")))


def pivot_cohort(sizes: DataFrame, activity: DataFrame, offsets: Sequence[int] = COHORT_OFFSETS) -> DataFrame:
    """Wide cohort table: cohort_month 'yyyy-MM', cohort_size, month_k_users
    for each offset (0 when inactive), then month_k_retention_pct."""
    wide = activity.groupBy("cohort_month").agg(
        *[F.sum(F.when(F.col("offset") == k, F.col("users"))).alias(f"month_{k}_users") for k in offsets])
    joined = sizes.join(wide, on="cohort_month", how="left")
    users_cols = [F.coalesce(F.col(f"month_{k}_users"), F.lit(0)).cast("bigint").alias(f"month_{k}_users")
                  for k in offsets]
    pct_cols = [retention_pct(F.coalesce(F.col(f"month_{k}_users"), F.lit(0)), F.col("cohort_size"))
                .alias(f"month_{k}_retention_pct") for k in offsets]
    return joined.select(F.date_format("cohort_month", "yyyy-MM").alias("cohort_month"),
                         F.col("cohort_size").cast("bigint").alias("cohort_size"),
                         *users_cols, *pct_cols)
