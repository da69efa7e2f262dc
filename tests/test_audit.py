"""Audit: every one of the 26 checks on a hand-made source, and the
reusable profile / duplicates / orphans operators."""

from pyspark.sql import functions as F

from testkit import strings
from tallyhouse.operators.profile import duplicates, orphans, profile, to_long
from tallyhouse.plans.audit import data_quality_issues, issues_long
from tallyhouse.plans.reference import ISSUE_CATALOG, ref_allowed_age_group, ref_allowed_status
from tallyhouse.sources.tables import SOURCE_COLUMNS

ORDERS = [
    # order_id, user_id, product_id, order_date, quantity, status, revenue_czk, discount_pct
    ("o1", "u1", "p1", "2024-01-01", "1", "completed", "10", "0.1"),
    ("o1", "u1", "p1", "2024-01-02", "0", "COMPLETED", "0.40", "1.5"),    # dup, qty 0, inconsistent, disc
    (" ", None, "", None, "-2", "kompletní", "0", "-0.1"),                 # null keys/date, alias, zero rev
    (None, "ghost", "missing", "n/a", "abc", "shipped", "", "x"),          # invalid status, fk x2
    ("o3", "u2", "p2", "2024-02-01", "0.4", None, "5", "0.2"),             # null status, qty 0.4 -> 0
    ("o4", " u2 ", "p2", "2024-02-01", "2", " Completed ", "free", "1"),   # trimmed keys match
]
PRODUCTS = [
    ("p1", "A", "toys", "10", "0.2", "1"),
    ("p1", " ", "", "0", "1.2", "0"),            # dup, missing name+category, price 0, margin > 1
    ("", "B", None, "x", "", "1"),                # null key, missing category, bad price
    (" p2 ", "C", "toys", "0.40", "-0.5", "1"),   # price 0.40 is > 0 at scale 2, margin < 0
]
USERS = [
    ("u1", "CZ", "email", "2020-01-01", "18-24"),
    ("u1", "", " ", "", ""),                      # dup, missing country/channel/registered/age
    ("u2", "SK", None, "2021-01-01", "55 plus"),  # missing channel, invalid age
    (None, "PL", "direct", None, " 25-34 "),      # null key, missing registered_at
]

EXPECTED = {
    ("orders", "null_in_key_order_id"): 2, ("orders", "null_in_key_user_id"): 1,
    ("orders", "null_in_key_product_id"): 1, ("orders", "null_order_date"): 1,
    ("orders", "duplicate_order_id"): 2, ("orders", "null_status"): 1, ("orders", "invalid_status"): 1,
    ("orders", "status_inconsistency"): 3, ("orders", "completed_zero_or_null_revenue"): 2,
    ("orders", "quantity_le_zero"): 3, ("orders", "discount_out_of_range"): 2,
    ("orders", "fk_user_id_not_in_users"): 1, ("orders", "fk_product_id_not_in_products"): 1,
    ("products", "null_in_key_product_id"): 1, ("products", "duplicate_product_id"): 2,
    ("products", "price_le_zero"): 2, ("products", "missing_product_name"): 1,
    ("products", "missing_category"): 2, ("products", "margin_out_of_range"): 2,
    ("users", "null_in_key_user_id"): 1, ("users", "duplicate_user_id"): 2, ("users", "missing_country"): 1,
    ("users", "missing_acquisition_channel"): 2, ("users", "missing_registered_at"): 2,
    ("users", "missing_age_group"): 1, ("users", "invalid_age_group_format"): 1,
}


def sources(spark):
    return (strings(spark, SOURCE_COLUMNS["raw_orders"], ORDERS),
            strings(spark, SOURCE_COLUMNS["raw_products"], PRODUCTS),
            strings(spark, SOURCE_COLUMNS["raw_users"], USERS))


def test_catalog_has_26_unique_keys():
    keys = [(t, i) for t, i, _, _ in ISSUE_CATALOG]
    assert len(keys) == 26 and len(set(keys)) == 26
    assert set(keys) == set(EXPECTED)


def test_all_checks(spark):
    o, p, u = sources(spark)
    long = issues_long(o, p, u, ref_allowed_status(spark), ref_allowed_age_group(spark))
    got = {(r.table_name, r.issue_type): r.affected_rows for r in long.collect()}
    assert got == EXPECTED


def test_final_table_drops_zero_rows_and_joins_text(spark):
    o, p, u = sources(spark)
    clean_users = strings(spark, SOURCE_COLUMNS["raw_users"], [("u1", "CZ", "email", "2020-01-01", "18-24")])
    out = data_quality_issues(spark, o, p, clean_users, ordered=True)
    rows = out.collect()
    assert all(r.affected_rows > 0 for r in rows)
    assert not any(r.table_name == "users" for r in rows)
    assert all(r.description and r.recommended_fix for r in rows)
    keys = [(r.table_name, r.issue_type) for r in rows]
    assert keys == sorted(keys)
    assert dict(out.dtypes)["affected_rows"] == "bigint"


def test_edited_code_list_changes_validity(spark):
    o, p, u = sources(spark)
    wider = spark.createDataFrame([("completed",), ("cancelled",), ("returned",), ("shipped",)], "status string")
    out = data_quality_issues(spark, o, p, u, ref_status=wider)
    assert out.filter(F.col("issue_type") == "invalid_status").count() == 0


def test_empty_sources_give_26_zeros(spark):
    o, p, u = (df.limit(0) for df in sources(spark))
    rows = issues_long(o, p, u, ref_allowed_status(spark), ref_allowed_age_group(spark)).collect()
    assert len(rows) == 26 and all(r.affected_rows == 0 for r in rows)


def test_repeated_code_list_rows_count_once(spark):
    o, p, u = sources(spark)
    twice = ref_allowed_status(spark).unionAll(ref_allowed_status(spark))
    got = issues_long(o, p, u, twice, ref_allowed_age_group(spark)).collect()
    assert {(r.table_name, r.issue_type): r.affected_rows for r in got} == EXPECTED


def test_operators(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert duplicates(df, "k").first()[0] == 3
    right = spark.createDataFrame([("b",), ("b",)], "k string")
    assert orphans(df, right, "k").first()[0] == 3
    assert orphans(df.filter("k = 'b'"), right, "k").first()[0] == 0
    prof = profile(df, {"nulls": F.col("k").isNull(), "as": F.col("k") == "a"})
    assert prof.first().asDict() == {"nulls": 2, "as": 3}
    long = {r.issue_type: r.affected_rows for r in to_long(prof, "t").collect()}
    assert long == {"nulls": 2, "as": 3}
