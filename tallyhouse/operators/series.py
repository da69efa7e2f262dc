"""Window operators over already-aggregated series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def mom_growth(df: DataFrame, part: str, month: str, value: str,
               prev_name: str | None = None, pct_name: str = "mom_growth_pct",
               prev_month_name: str | None = None) -> DataFrame:
    """Previous period value and month-over-month growth in % per ``part``.

    The previous value is whatever row came before (shown even across a gap);
    the growth is NULL for the first row, when the previous row is not the
    adjacent month, or when the previous value is NULL or 0. Money is kept at
    DECIMAL(18,2) before dividing so the quotient keeps enough digits for an
    exact half-up rounding to 2 places.

    Runs after aggregation: one row per (part, month), so the window's
    shuffle is small however large the orders table is. ``prev_month_name``
    also returns the month of the previous row.
    """
    prev_name = prev_name or f"prev_month_{value}"
    w = Window.partitionBy(part).orderBy(month)
    lagged = df.select(F.col(month), F.col(part), F.col(value).cast("decimal(18,2)").alias("__cur"),
                       F.lag(F.col(value)).over(w).cast("decimal(18,2)").alias("__prev"),
                       F.lag(F.col(month)).over(w).alias("__prev_month"))
    cur, prev, prev_month = F.col("__cur"), F.col("__prev"), F.col("__prev_month")
    growth = (F.when(prev_month.isNull() | (prev_month != F.add_months(F.col(month), -1)), F.lit(None))
               .when(prev.isNull() | (prev == 0), F.lit(None))
               .otherwise(F.round((cur - prev) / prev * F.lit(100), 2)))
    extra = [prev_month.alias(prev_month_name)] if prev_month_name else []
    return lagged.select(F.col(month), F.col(part), cur.alias(value), prev.alias(prev_name), *extra,
                         growth.cast("decimal(10,2)").alias(pct_name))
