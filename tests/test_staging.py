"""Staging: flags, value rewrites, dedup rules and key invariants."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from testkit import SF_SMALL, strings
from tallyhouse.plans.staging import stg_orders, stg_products, stg_users
from tallyhouse.sources.tables import SOURCE_COLUMNS, raw_sources

OCOLS = SOURCE_COLUMNS["raw_orders"]
PCOLS = SOURCE_COLUMNS["raw_products"]
UCOLS = SOURCE_COLUMNS["raw_users"]


def order(oid, status="completed", rev="10.50", qty="1", date="2024-01-05", user="u1", prod="p1", disc="0.1"):
    return (oid, user, prod, date, qty, status, rev, disc)


def by_id(df, key):
    return {r[key]: r for r in df.collect()}


def test_order_flags(spark):
    rows = [
        order("r1", rev=None), order("r2", rev=""), order("r3", rev="0"), order("r4", rev="0.4"),
        order("r5", rev="0.5"), order("r6", rev="free"), order("r7", rev="-0.4"), order("r8", status="cancelled", rev="0"),
        order("r9", status="KOMPLETNÍ", rev="0"),
        order("s1", status=None), order("s2", status=""), order("s3", status=" Completed "), order("s4", status="shipped"),
        order("q1", qty=None), order("q2", qty=""), order("q3", qty="abc"), order("q4", qty="0"),
        order("q5", qty="0.4"), order("q6", qty="0.5"), order("q7", qty="-1"),
    ]
    got = by_id(stg_orders(strings(spark, OCOLS, rows), with_loaded_at=False), "order_id")
    rev = {k: got[k].is_revenue_suspicious for k in ["r1", "r2", "r3", "r4", "r5", "r6", "r7", "r8", "r9"]}
    assert rev == {"r1": 1, "r2": 1, "r3": 1, "r4": 1, "r5": 0, "r6": 0, "r7": 1, "r8": 0, "r9": 1}
    assert got["r4"].revenue_czk == Decimal("0.40") and got["r6"].revenue_czk is None
    unk = {k: (got[k].status, got[k].is_status_unknown) for k in ["s1", "s2", "s3", "s4", "r9"]}
    assert unk == {"s1": (None, 0), "s2": (None, 1), "s3": ("completed", 0), "s4": (None, 1), "r9": ("completed", 0)}
    qty = {k: got[k].is_quantity_invalid for k in ["q1", "q2", "q3", "q4", "q5", "q6", "q7"]}
    assert qty == {"q1": 1, "q2": 1, "q3": 1, "q4": 1, "q5": 1, "q6": 0, "q7": 1}
    assert got["q6"].quantity == Decimal(1) and got["q5"].quantity == Decimal(0)


def test_order_dedup_rules(spark):
    rows = [
        order(None, user="n1"), order(None, user="n2"),                       # NULL keys: one row
        order("", user="e1"), order("", user="e2"),                           # '' keys: one row
        order("A", user="a"), order(" A", user="space"),                      # distinct raw keys
        order("K", status="cancelled", date="2024-05-01", user="newer"),      # completed beats newer
        order("K", status="completed", date="2024-01-01", user="older"),
        order("D", date=None, user="nodate"), order("D", date="2023-01-01", user="dated"),
        order("T", user="z"), order("T", user="b"),                           # full tie → smallest raw
        order("N", date=None, user="m2"), order("N", date="junk", user="m1"),  # all dates NULL
    ]
    out = stg_orders(strings(spark, OCOLS, rows), with_loaded_at=False)
    got = by_id(out, "order_id")
    assert out.count() == 8
    assert got[None].user_id == "n1" and got[""].user_id == "e1"
    assert got["A"].user_id == "a" and got[" A"].user_id == "space"
    assert got["K"].user_id == "older" and got["D"].user_id == "dated"
    assert got["T"].user_id == "b" and got["N"].user_id == "m1"
    assert got["K"].order_date == dt.date(2024, 1, 1)


def test_products(spark):
    rows = [
        ("p1", " Name ", " home & garden/toys-kids", "10.00", "0.2", "ANO"),
        ("p1", "Other", "x", "99.00", "0.2", "0"),             # inactive loses despite higher price
        ("p2", "B", "", "0.40", "1.0001", "maybe"),
        ("p3", "C", None, "x", "", "1"),
        ("p4", "D", "toys", "5", "100", " true "),
        ("p5", "E", "Toys", "-1", "-0.01", "n"),
        ("p6", "F", "toys", "12.50", "1", "1"), ("p6", "G", "toys", "13.50", "0", "1"),
    ]
    got = by_id(stg_products(strings(spark, PCOLS, rows), with_loaded_at=False), "product_id")
    p1 = got["p1"]
    assert (p1.product_name, p1.category, p1.is_active) == ("Name", "Home & Garden/Toys-Kids", 1)
    assert got["p2"].category == "" and got["p2"].is_category_missing == 1
    assert got["p3"].category is None and got["p3"].is_category_missing == 1
    assert got["p2"].is_price_invalid == 1 and got["p2"].price_czk == Decimal("0.40")
    assert got["p3"].is_price_invalid == 1 and got["p3"].price_czk is None
    assert got["p2"].is_margin_out_of_range == 1 and got["p3"].is_margin_out_of_range == 1
    assert got["p4"].margin_pct is None and got["p4"].is_margin_out_of_range == 1
    assert got["p5"].is_margin_out_of_range == 1 and got["p5"].is_active == 0 and got["p5"].is_price_invalid == 1
    assert got["p6"].product_name == "G" and got["p6"].is_margin_out_of_range == 0
    assert got["p4"].category == "Toys"


def test_users(spark):
    rows = [
        ("u1", " cz", "Email ", "2024-01-05", " 25-34"),
        ("u1", "SK", "organic", "2023-01-05", "18-24"),        # older registration loses
        ("u2", "DE", None, "unknown", "55 plus"),
        ("u3", "", "tiktok", "", None),
        (None, "PL", "direct", "2020-01-01", "55+"), (None, "HU", "direct", "2021-01-01", "55+"),
    ]
    out = stg_users(strings(spark, UCOLS, rows), with_loaded_at=False)
    got = by_id(out, "user_id")
    assert out.count() == 4
    u1 = got["u1"]
    assert (u1.country, u1.acquisition_channel, u1.age_group) == ("CZ", "email", "25-34")
    assert (u1.is_country_unknown, u1.is_channel_unknown, u1.is_age_group_unknown, u1.is_registered_at_invalid) == (0, 0, 0, 0)
    u2 = got["u2"]
    assert (u2.country, u2.age_group, u2.registered_at) == (None, "unknown", None)
    assert (u2.is_country_unknown, u2.is_channel_unknown, u2.is_age_group_unknown, u2.is_registered_at_invalid) == (1, 1, 1, 1)
    assert got["u3"].is_channel_unknown == 1 and got["u3"].is_age_group_unknown == 1
    assert got[None].country == "HU"


def test_fixture_counts_and_keys(spark):
    raw = raw_sources(spark, SF_SMALL)
    o = stg_orders(raw["raw_orders"])
    for df, key in [(o, "order_id"), (stg_products(raw["raw_products"]), "product_id"),
                    (stg_users(raw["raw_users"]), "user_id")]:
        # one row per key, NULL included
        assert df.count() == df.select(key).distinct().count()
    assert set(o.columns) >= {"loaded_at", "source_table"}
    assert o.select("source_table").distinct().collect()[0][0] == "orders"
    assert dict(o.dtypes)["quantity"] == "decimal(38,0)" and dict(o.dtypes)["is_status_unknown"] == "int"
    assert o.filter(F.col("status").isNotNull() & ~F.col("status").isin("completed", "cancelled", "returned")).count() == 0


def test_typed_sources_are_read_as_text(spark):
    import pytest
    from tallyhouse.plans.audit import issues_long
    from tallyhouse.plans.reference import ref_allowed_age_group, ref_allowed_status
    typed = spark.createDataFrame(
        [("o1", "u1", "p1", dt.date(2024, 1, 5), 2, "completed", 10.5, 0.1),
         ("o1", "u1", "p1", dt.date(2024, 1, 6), 0, "completed", 0.0, 1.5)],
        "order_id string, user_id string, product_id string, order_date date, quantity int, "
        "status string, revenue_czk double, discount_pct double")
    got = stg_orders(typed, with_loaded_at=False).first()
    assert (got.order_date, got.quantity, got.is_revenue_suspicious) == (dt.date(2024, 1, 6), Decimal(0), 1)
    users = strings(spark, UCOLS, [("u1", "CZ", "email", "2020-01-01", "18-24")])
    products = strings(spark, PCOLS, [("p1", "A", "toys", "10", "0.2", "1")])
    issues = {r.issue_type: r.affected_rows for r in
              issues_long(typed, products, users, ref_allowed_status(spark), ref_allowed_age_group(spark)).collect()}
    assert issues["quantity_le_zero"] == 1 and issues["discount_out_of_range"] == 1
    with pytest.raises(ValueError, match="missing column"):
        stg_orders(typed.drop("status"))
