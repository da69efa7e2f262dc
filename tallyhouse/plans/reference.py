"""Reference tables: allowed code lists and the issue catalog.

Built as SQL ``VALUES`` literal tables: the plan node carries its exact size,
so Spark broadcasts them on its own size check (no hint needed, and a large
user-supplied code list would simply not be broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.functions.exprs import ALLOWED_AGE_GROUPS, ALLOWED_STATUSES

# The 26 (table_name, issue_type) keys are fixed values. A description says what
# audit.py counts, a fix what staging and the marts do with such rows.
ISSUE_CATALOG = (
    ("orders", "null_in_key_order_id",
     "order_id is NULL or only spaces.",
     "Staging keeps one such row in all; give every order an id before loading."),
    ("orders", "null_in_key_user_id",
     "user_id is NULL or only spaces.",
     "Staging keeps the row and the marts count it under no user; load the buyer's id."),
    ("orders", "null_in_key_product_id",
     "product_id is NULL or only spaces.",
     "Staging keeps the row and no category receives it; load the product's id."),
    ("orders", "null_order_date",
     "order_date is NULL or only spaces.",
     "Staging leaves the date NULL, which no monthly figure includes; load the day of the order."),
    ("orders", "duplicate_order_id",
     "The trimmed order_id stands in two or more rows; all of them are counted.",
     "Staging keeps one row per id: a completed one first, then the latest date. Send each order once."),
    ("orders", "null_status",
     "status is NULL or only spaces.",
     "Staging leaves the status NULL, so no revenue counts; load a status."),
    ("orders", "invalid_status",
     "status, trimmed and in lower case, is neither in ref_allowed_status nor an alias of completed.",
     "Staging sets it to NULL and raises is_status_unknown; send one of the listed statuses, or have a new one listed first."),
    ("orders", "status_inconsistency",
     "status has capitals or is an alias of completed.",
     "Staging maps it to the listed spelling; send that spelling."),
    ("orders", "completed_zero_or_null_revenue",
     "A completed order whose revenue_czk is zero or cannot be read as a number.",
     "Revenue rounding to zero or left blank raises is_revenue_suspicious and the marts leave the order out; send the amount paid."),
    ("orders", "quantity_le_zero",
     "quantity is a number of zero or less.",
     "Staging keeps it and raises is_quantity_invalid; send a positive number of pieces."),
    ("orders", "discount_out_of_range",
     "discount_pct is a number below 0 or above 1.",
     "Staging keeps it; send the discount as a share of 1."),
    ("orders", "fk_user_id_not_in_users",
     "user_id matches no user_id of users.",
     "Revenue of the order goes to country UNKNOWN; load the user."),
    ("orders", "fk_product_id_not_in_products",
     "product_id matches no product_id of products.",
     "No category receives the order; load the product."),
    ("products", "null_in_key_product_id",
     "product_id is NULL or only spaces.",
     "Staging keeps one such row in all; give every product an id before loading."),
    ("products", "duplicate_product_id",
     "The trimmed product_id stands in two or more rows; all of them are counted.",
     "Staging keeps one row per id: an active one first, then the highest price. Send each product once."),
    ("products", "price_le_zero",
     "price_czk is zero, negative or cannot be read as a number.",
     "Staging raises is_price_invalid where the whole-number price is missing or not positive; send a positive price."),
    ("products", "missing_product_name",
     "product_name is NULL or only spaces.",
     "Staging keeps the row without a name; load one."),
    ("products", "missing_category",
     "category is NULL or only spaces.",
     "Staging raises is_category_missing; load a category so that its sales are grouped."),
    ("products", "margin_out_of_range",
     "margin_pct is a number below 0 or above 1.",
     "Staging keeps it and raises is_margin_out_of_range; send the margin as a share of 1."),
    ("users", "null_in_key_user_id",
     "user_id is NULL or only spaces.",
     "Staging keeps one such row in all; give every user an id before loading."),
    ("users", "duplicate_user_id",
     "The trimmed user_id stands in two or more rows; all of them are counted.",
     "Staging keeps one row per id, the one registered last. Send each user once."),
    ("users", "missing_country",
     "country is NULL or only spaces.",
     "Staging raises is_country_unknown and leaves the country NULL; load a listed country."),
    ("users", "missing_acquisition_channel",
     "acquisition_channel is NULL or only spaces.",
     "Staging raises is_channel_unknown where the channel is NULL or unlisted; load a listed channel."),
    ("users", "missing_registered_at",
     "registered_at is NULL or only spaces.",
     "Staging raises is_registered_at_invalid and no cohort holds the user; load the day of registration."),
    ("users", "missing_age_group",
     "age_group is NULL or only spaces.",
     "Staging writes unknown and raises is_age_group_unknown; load a listed age group."),
    ("users", "invalid_age_group_format",
     "age_group, trimmed, is not in ref_allowed_age_group.",
     "Staging writes unknown and raises is_age_group_unknown; send one of the listed groups, or have a new one listed first."),
)


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_table(spark: SparkSession, rows, columns: tuple[str, ...]) -> DataFrame:
    """A literal table ``SELECT * FROM VALUES (...), ... AS v(columns)``."""
    body = ", ".join("(" + ", ".join(_sql_text(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS v({', '.join(columns)})")


def ref_allowed_status(spark: SparkSession) -> DataFrame:
    """The allowed order statuses."""
    return values_table(spark, [(s,) for s in ALLOWED_STATUSES], ("status",))


def ref_allowed_age_group(spark: SparkSession) -> DataFrame:
    """The allowed age groups."""
    return values_table(spark, [(a,) for a in ALLOWED_AGE_GROUPS], ("age_group",))


def issue_catalog(spark: SparkSession) -> DataFrame:
    """(table_name, issue_type) → description, recommended_fix."""
    return values_table(spark, ISSUE_CATALOG, ("table_name", "issue_type", "description", "recommended_fix"))
