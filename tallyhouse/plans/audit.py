"""Data-quality audit (N7) over the *source* tables.

Every source table gives one row of counts (``*_findings`` for the rules on
single rows, ``key_report`` for keys), unpivoted to long rows, unioned, and
joined to the 26-row catalog. Orders are scanned twice: once for the row
rules, counted per status value, and once for the three keys. The names of the
findings are fixed values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.exprs import STATUS_ALIAS_COMPLETED, blank, status_norm, try_num
from tallyhouse.operators.profile import duplicates, key_report, profile, profile_with_code, to_long
from tallyhouse.plans.reference import issue_catalog, ref_allowed_age_group, ref_allowed_status
from tallyhouse.sources.tables import as_strings

# Key columns of each source table, its own key first.
KEYS = {"orders": ("order_id", "user_id", "product_id"), "products": ("product_id",), "users": ("user_id",)}


def source_keys(source: DataFrame, table: str) -> DataFrame:
    """The key columns of a source table, trimmed, blank as NULL."""
    return as_strings(source, f"raw_{table}").select(*[blank(k).alias(k) for k in KEYS[table]])


def _blanks(names: dict[str, str]) -> dict[str, Column]:
    """finding → "this column is NULL or only spaces"."""
    return {name: blank(column).isNull() for name, column in names.items()}


def _outside_fraction(column: str) -> Column:
    return ~try_num(column, 10, 4).between(0, 1)


def order_findings(orders: DataFrame, statuses: DataFrame) -> DataFrame:
    """One row of counts over the source orders. Numbers that cannot be read
    break no numeric rule."""
    written = blank("status")
    should_be = F.coalesce(status_norm("status"), F.lower(written))
    checks = _blanks({f"null_in_key_{k}": k for k in KEYS["orders"]}
                     | {"null_order_date": "order_date", "null_status": "status"})
    checks |= {
        "status_inconsistency": written != should_be,
        "completed_zero_or_null_revenue": (should_be == "completed")
                                          & (F.coalesce(try_num("revenue_czk", 18, 2), F.lit(0)) == 0),
        "quantity_le_zero": try_num("quantity") <= 0,
        "discount_out_of_range": _outside_fraction("discount_pct"),
    }
    lower = F.lower(written)
    return profile_with_code(as_strings(orders, "raw_orders"), checks,
                             code=F.when(lower != STATUS_ALIAS_COMPLETED, lower),
                             allowed=statuses, unlisted="invalid_status")


def product_findings(products: DataFrame) -> DataFrame:
    """One row of counts over the source products; an unreadable price counts as none."""
    checks = _blanks({"null_in_key_product_id": "product_id", "missing_product_name": "product_name",
                      "missing_category": "category"})
    checks |= {"price_le_zero": F.coalesce(try_num("price_czk", 18, 2), F.lit(0)) <= 0,
               "margin_out_of_range": _outside_fraction("margin_pct")}
    return profile(as_strings(products, "raw_products"), checks)


def user_findings(users: DataFrame, age_groups: DataFrame) -> DataFrame:
    """One row of counts over the source users."""
    checks = _blanks({"null_in_key_user_id": "user_id"}
                     | {f"missing_{c}": c for c in ("country", "acquisition_channel", "registered_at", "age_group")})
    return profile_with_code(as_strings(users, "raw_users"), checks, code=blank("age_group"),
                             allowed=age_groups, unlisted="invalid_age_group_format")


def issues_long(orders: DataFrame, products: DataFrame, users: DataFrame,
                ref_status: DataFrame, ref_age_group: DataFrame) -> DataFrame:
    """All 26 checks as (table_name, issue_type, affected_rows), zeros included."""
    user_keys, product_keys = source_keys(users, "users"), source_keys(products, "products")
    order_keys = key_report(source_keys(orders, "orders"),
                            foreign={"user_id": (user_keys, "fk_user_id_not_in_users"),
                                     "product_id": (product_keys, "fk_product_id_not_in_products")},
                            unique={"order_id": "duplicate_order_id"})
    found = [
        ("orders", order_findings(orders, ref_status)),
        ("orders", order_keys),
        ("products", product_findings(products)),
        ("products", duplicates(product_keys, "product_id", "duplicate_product_id")),
        ("users", user_findings(users, ref_age_group)),
        ("users", duplicates(user_keys, "user_id", "duplicate_user_id")),
    ]
    return reduce(DataFrame.unionByName, [to_long(wide, table) for table, wide in found])


def data_quality_issues(spark: SparkSession, orders: DataFrame, products: DataFrame,
                        users: DataFrame, ref_status: DataFrame | None = None,
                        ref_age_group: DataFrame | None = None, catalog: DataFrame | None = None,
                        ordered: bool = False) -> DataFrame:
    """One row per issue with at least one affected row, with its text.

    The code lists and the catalog default to N4–N6; pass edited ones to
    change what counts as valid.
    """
    catalog = catalog if catalog is not None else issue_catalog(spark)
    ref_status = ref_status if ref_status is not None else ref_allowed_status(spark)
    ref_age_group = ref_age_group if ref_age_group is not None else ref_allowed_age_group(spark)
    out = (issues_long(orders, products, users, ref_status, ref_age_group)
           .filter(F.col("affected_rows") > 0)
           .join(catalog, on=["table_name", "issue_type"], how="left")
           .select("table_name", "issue_type", F.col("affected_rows").cast("bigint").alias("affected_rows"),
                   "description", "recommended_fix"))
    return out.orderBy("table_name", "issue_type") if ordered else out
