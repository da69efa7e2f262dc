"""Staging (N1–N3): typed, normalised, one row per key, with quality flags.

Each function is a single narrow projection followed by one keep-best-per-key
window; the only shuffle is the window's exchange on the key, preceded by a
partial window-group-limit.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.exprs import (
    ALLOWED_AGE_GROUPS,
    ALLOWED_CHANNELS,
    ALLOWED_COUNTRIES,
    ALLOWED_STATUSES,
    STATUS_ALIAS_COMPLETED,
    blank,
    code_or,
    flag,
    initcap_words,
    parse_bool,
    status_norm,
    try_date,
    try_num,
)
from tallyhouse.operators.dedup import keep_best, tie_breakers
from tallyhouse.sources.tables import SOURCE_COLUMNS, as_strings

ORDER_COLUMNS = SOURCE_COLUMNS["raw_orders"]
PRODUCT_COLUMNS = SOURCE_COLUMNS["raw_products"]
USER_COLUMNS = SOURCE_COLUMNS["raw_users"]


def _lineage(df: DataFrame, source: str, with_loaded_at: bool, loaded_at: datetime | None) -> DataFrame:
    """``loaded_at`` is the stamp of the run that all its tables share; without one, the time of the query."""
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    cols = [stamp.alias("loaded_at")] if with_loaded_at else []
    return df.select("*", *cols, F.lit(source).alias("source_table"))


def order_preference(date: str | Column) -> list[Column]:
    """Which row of an ``order_id`` is kept: completed first, then the newest parseable
    ``date``, then the remaining raw columns ascending (deterministic tie-break)."""
    return [F.when(status_norm("status") == "completed", 0).otherwise(1).asc(), F.col(date).desc_nulls_last() if isinstance(date, str)
            else date.desc_nulls_last(), *tie_breakers(ORDER_COLUMNS, exclude=["order_id"])]


def status_unknown(status: str = "status") -> Column:
    """1 where a raw status is neither an allowed one nor the alias of one."""
    raw = F.lower(F.trim(F.col(status)))
    return flag(F.col(status).isNotNull() & ~raw.isin(*ALLOWED_STATUSES, STATUS_ALIAS_COMPLETED))


def stg_orders(orders: DataFrame, with_loaded_at: bool = True, loaded_at: datetime | None = None) -> DataFrame:
    """``stg_orders`` from the all-STRING source ``orders``.

    Per ``order_id`` (raw, untrimmed; all NULL ids form one group) the row
    kept is: completed first, then newest parseable order_date, then the
    remaining raw columns ascending (deterministic tie-break). Only the raw
    columns and the two sort keys cross the shuffle; every output expression
    is evaluated after the dedup, on the surviving rows.
    """
    src = as_strings(orders, "raw_orders")
    keyed = src.select(
        *ORDER_COLUMNS,
        F.when(status_norm("status") == "completed", 0).otherwise(1).alias("__not_completed"),
        try_date("order_date").alias("__date"),
    )
    best = keep_best(
        keyed, "order_id",
        [F.col("__not_completed").asc(), F.col("__date").desc_nulls_last(),
         *tie_breakers(ORDER_COLUMNS, exclude=["order_id"])])
    raw_status = F.lower(F.trim(F.col("status")))
    qty = try_num("quantity")
    rev_int = try_num("revenue_czk")
    out = best.select(
        "order_id", "user_id", "product_id",
        F.col("__date").alias("order_date"),
        qty.alias("quantity"),
        status_norm("status").alias("status"),
        try_num("revenue_czk", 18, 2).alias("revenue_czk"),
        try_num("discount_pct", 6, 4).alias("discount_pct"),
        flag(raw_status.isin("completed", STATUS_ALIAS_COMPLETED)
             & (blank("revenue_czk").isNull() | (rev_int == 0))).alias("is_revenue_suspicious"),
        status_unknown().alias("is_status_unknown"),
        flag(blank("quantity").isNull() | qty.isNull() | (qty <= 0)).alias("is_quantity_invalid"),
    )
    return _lineage(out, "orders", with_loaded_at, loaded_at)


def stg_products(products: DataFrame, with_loaded_at: bool = True, loaded_at: datetime | None = None) -> DataFrame:
    """``stg_products``; per ``product_id`` the active row with the highest
    price wins."""
    src = as_strings(products, "raw_products")
    keyed = src.select(
        *PRODUCT_COLUMNS,
        F.when(parse_bool("is_active") == 1, 0).otherwise(1).alias("__inactive"),
        try_num("price_czk", 18, 2).alias("__price"),
    )
    best = keep_best(
        keyed, "product_id",
        [F.col("__inactive").asc(), F.col("__price").desc_nulls_last(),
         *tie_breakers(PRODUCT_COLUMNS, exclude=["product_id"])])
    price_int = try_num("price_czk")
    margin = try_num("margin_pct", 10, 4)
    out = best.select(
        "product_id",
        F.trim("product_name").alias("product_name"),
        initcap_words(F.lower(F.trim("category"))).alias("category"),
        F.col("__price").alias("price_czk"),
        try_num("margin_pct", 6, 4).alias("margin_pct"),
        parse_bool("is_active").alias("is_active"),
        flag(price_int.isNull() | (price_int <= 0)).alias("is_price_invalid"),
        flag(margin.isNull() | ~margin.between(0, 1)).alias("is_margin_out_of_range"),
        flag(F.col("category").isNull() | (F.trim("category") == "")).alias("is_category_missing"),
    )
    return _lineage(out, "products", with_loaded_at, loaded_at)


def stg_users(users: DataFrame, with_loaded_at: bool = True, loaded_at: datetime | None = None) -> DataFrame:
    """``stg_users``; per ``user_id`` the newest registration wins."""
    src = as_strings(users, "raw_users")
    keyed = src.select(*USER_COLUMNS, try_date("registered_at").alias("__registered"))
    best = keep_best(
        keyed, "user_id",
        [F.col("__registered").desc_nulls_last(),
         *tie_breakers(USER_COLUMNS, exclude=["user_id"])])
    country = F.upper(F.trim("country"))
    channel = F.lower(F.trim("acquisition_channel"))
    out = best.select(
        "user_id",
        code_or("country", ALLOWED_COUNTRIES, case="upper").alias("country"),
        channel.alias("acquisition_channel"),
        F.col("__registered").alias("registered_at"),
        code_or("age_group", ALLOWED_AGE_GROUPS, default="unknown").alias("age_group"),
        flag(F.col("age_group").isNull()
             | ~F.trim("age_group").isin(*ALLOWED_AGE_GROUPS)).alias("is_age_group_unknown"),
        flag(~country.isin(*ALLOWED_COUNTRIES) | F.col("country").isNull()).alias("is_country_unknown"),
        flag(~channel.isin(*ALLOWED_CHANNELS)
             | F.col("acquisition_channel").isNull()).alias("is_channel_unknown"),
        flag(F.col("__registered").isNull()).alias("is_registered_at_invalid"),
    )
    return _lineage(out, "users", with_loaded_at, loaded_at)
