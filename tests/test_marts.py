"""Marts and cohort: boundary rows of FIXTURES §4 and invariants."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from testkit import SF_SMALL
from tallyhouse.plans.cohort import cohort_retention
from tallyhouse.plans.marts import category_performance, monthly_revenue_by_country, user_segments
from tallyhouse.plans.staging import stg_orders, stg_products, stg_users
from tallyhouse.sources.tables import raw_sources

O_SCHEMA = ("order_id string, user_id string, product_id string, order_date date, quantity decimal(38,0), "
            "status string, revenue_czk decimal(18,2), discount_pct decimal(6,4), is_revenue_suspicious int, "
            "is_status_unknown int, is_quantity_invalid int")
U_SCHEMA = "user_id string, country string, age_group string, registered_at date"
P_SCHEMA = "product_id string, category string, margin_pct decimal(6,4)"

D = dt.date


def o(oid, user, date, rev, status="completed", susp=0, unknown=0, prod="p1", disc="0.1000"):
    return (oid, user, prod, date, Decimal(1), status, None if rev is None else Decimal(rev),
            None if disc is None else Decimal(disc), susp, unknown, 0)


def test_monthly_revenue_mom(spark):
    orders = spark.createDataFrame([
        o("1", "cz", D(2023, 11, 3), "100"), o("2", "cz", D(2023, 12, 9), "150"),
        o("3", "cz", D(2024, 1, 2), "75"), o("4", "cz", D(2024, 3, 1), "80"),          # gap Feb
        o("5", "sk", D(2024, 1, 1), "0"), o("6", "sk", D(2024, 2, 1), "10"),            # previous 0
        o("7", "sk", D(2024, 2, 2), "5", susp=1), o("8", "sk", D(2024, 2, 3), "5", status="cancelled"),
        o("9", "nobody", D(2024, 1, 5), "1.005"), o("10", None, D(2024, 1, 6), "2"),
        o("11", "cz", None, "999"),
        o("12", "pl", D(2024, 1, 1), None), o("13", "pl", D(2024, 2, 1), "3"),          # previous NULL
    ], O_SCHEMA)
    users = spark.createDataFrame([("cz", "CZ", "18-24", D(2020, 1, 1)), ("sk", "SK", "18-24", D(2020, 1, 1)),
                                   ("pl", "PL", "18-24", D(2020, 1, 1))], U_SCHEMA)
    got = {(r.country, r.month): r for r in monthly_revenue_by_country(orders, users).collect()}
    cz = [got[("CZ", D(y, m, 1))] for y, m in [(2023, 11), (2023, 12), (2024, 1), (2024, 3)]]
    assert [r.mom_growth_pct for r in cz] == [None, Decimal("50.00"), Decimal("-50.00"), None]
    assert cz[3].prev_month_revenue_czk == Decimal("75.00")        # shown across the gap
    assert got[("SK", D(2024, 2, 1))].mom_growth_pct is None        # previous month revenue 0
    assert got[("SK", D(2024, 2, 1))].revenue_czk == Decimal("10.00")
    assert got[("PL", D(2024, 2, 1))].mom_growth_pct is None        # previous month revenue NULL
    assert got[("UNKNOWN", D(2024, 1, 1))].revenue_czk == Decimal("3.01")
    assert ("CZ", None) not in got


def test_mom_rounding_half_up(spark):
    orders = spark.createDataFrame([o("1", "cz", D(2024, 1, 1), "8"), o("2", "cz", D(2024, 2, 1), "9.001"),
                                    o("3", "cz", D(2024, 3, 1), "8.00")], O_SCHEMA)
    users = spark.createDataFrame([("cz", "CZ", "18-24", D(2020, 1, 1))], U_SCHEMA)
    got = {r.month: r.mom_growth_pct for r in monthly_revenue_by_country(orders, users).collect()}
    assert got[D(2024, 2, 1)] == Decimal("12.50")     # 9.00 / 8 = +12.5 %
    assert got[D(2024, 3, 1)] == Decimal("-11.11")    # -1/9 = -11.111...


def test_category_performance(spark):
    orders = spark.createDataFrame([
        o("1", "u", D(2024, 1, 1), "100", prod="a", disc="0.1000"),
        o("2", "u", D(2024, 1, 1), "50", prod="a", disc=None),
        o("3", "u", D(2024, 1, 1), "150", prod="b", disc="0.2000"),
        o("4", "u", D(2024, 1, 1), "70", prod="c", disc="0.0001"),
        o("5", "u", D(2024, 1, 1), "80", prod="d"), o("6", "u", D(2024, 1, 1), "1", prod="a", susp=1),
        o(None, "u", D(2024, 1, 1), "5", prod="c", disc="0.0002"),
    ], O_SCHEMA)
    products = spark.createDataFrame([("a", "Toys", "0.1000"), ("b", "Toys", "0.3000"), ("c", "", "0.1235"),
                                      ("d", None, "0.5")], P_SCHEMA.replace("decimal(6,4)", "string")) \
        .withColumn("margin_pct", F.col("margin_pct").cast("decimal(6,4)"))
    got = {r.category: r for r in category_performance(orders, products).collect()}
    assert set(got) == {"Toys", ""}                        # '' is a category, NULL is dropped
    toys = got["Toys"]
    assert toys.total_revenue_czk == Decimal("300.00") and toys.order_count == 3 and toys.revenue_rank == 1
    assert toys.avg_margin_pct == Decimal("0.1667")        # (0.1 + 0.1 + 0.3) / 3, order-weighted
    assert toys.avg_discount_pct == Decimal("0.1500")      # NULL discount skipped
    empty = got[""]
    assert empty.order_count == 1 and empty.revenue_rank == 2   # NULL order_id not counted
    assert empty.avg_discount_pct == Decimal("0.0002")          # (0.0001 + 0.0002) / 2 = 0.00015 → half up


def test_user_segments_boundaries(spark):
    as_of = D(2024, 12, 31)
    day = dt.timedelta(days=1)
    orders = spark.createDataFrame([
        o("x", "other", as_of, "1", status="cancelled"),                 # sets as_of, not counted
        o("1", "d180", as_of - 180 * day, "10"), o("2", "d181", as_of - 181 * day, "10"),
        o("3", "d365", as_of - 365 * day, "10"), o("4", "d366", as_of - 366 * day, "10"),
        o("5", "rich", as_of, "20000.00"), o("6", "richer", as_of, "20000.01"),
        o("7", "reg179", as_of, "1"), o("8", "reg180", as_of, "1"), o("9", "noreg", as_of, "1"),
        o("10", "susp", as_of, "1", susp=1),
    ], O_SCHEMA)
    old = D(2020, 1, 1)
    users = spark.createDataFrame([
        ("d180", "CZ", "18-24", old), ("d181", "CZ", "18-24", old), ("d365", "CZ", "18-24", old),
        ("d366", "CZ", "18-24", old), ("rich", "CZ", "18-24", old), ("richer", "CZ", "18-24", old),
        ("reg179", "CZ", "18-24", as_of - 179 * day), ("reg180", "CZ", "18-24", as_of - 180 * day),
        ("noreg", "CZ", "18-24", None), ("susp", "CZ", "18-24", old), (None, None, "unknown", old),
    ], U_SCHEMA)
    got = {r.user_id: r for r in user_segments(users, orders).collect()}
    seg = {k: v.segment for k, v in got.items()}
    assert seg == {"d180": "regular", "d181": "at_risk", "d365": "at_risk", "d366": "lost", "rich": "regular",
                   "richer": "high_value", "reg179": "new_user", "reg180": "regular", "noreg": "regular",
                   "susp": "lost", None: "lost"}
    assert got["susp"].order_count == 0 and got["susp"].total_revenue_czk == Decimal("0.00")
    assert got["d181"].days_since_last_order == 181 and got["noreg"].days_since_registered is None


def test_cohort_offsets(spark):
    users = spark.createDataFrame([
        ("a", None, None, D(2023, 11, 15)), ("b", None, None, D(2023, 11, 30)), ("c", None, None, D(2023, 12, 1)),
        ("quiet", None, None, D(2022, 5, 5)), ("nodate", None, None, None), (None, None, None, D(2023, 11, 2)),
    ], U_SCHEMA)
    orders = spark.createDataFrame([
        o("1", "a", D(2023, 11, 20), "1"), o("2", "a", D(2023, 11, 21), "1"),     # offset 0, once
        o("3", "a", D(2024, 2, 1), "1"),                                            # offset 3 (year crossing)
        o("4", "b", D(2024, 3, 1), "1"),                                            # offset 4: out
        o("5", "b", D(2023, 10, 1), "1"),                                           # before registration: out
        o("6", "b", D(2023, 12, 1), "1", susp=1),                                   # suspicious still counts
        o("7", "c", D(2023, 12, 2), "1", unknown=1),                                # unknown status: out
        o("8", "c", None, "1"),                                                     # NULL date: out
        o("9", None, D(2023, 11, 3), "1"),
    ], O_SCHEMA)
    got = {r.cohort_month: r for r in cohort_retention(users, orders).collect()}
    assert set(got) == {"2023-11", "2023-12", "2022-05"}
    nov = got["2023-11"]
    assert (nov.cohort_size, nov.month_0_users, nov.month_1_users, nov.month_2_users, nov.month_3_users) == (2, 1, 1, 0, 1)
    assert (nov.month_0_retention_pct, nov.month_3_retention_pct) == (50.0, 50.0)
    quiet = got["2022-05"]
    assert (quiet.month_0_users, quiet.month_0_retention_pct) == (0, 0.0)


def test_cohort_half_even(spark):
    users = spark.createDataFrame([(f"u{i}", None, None, D(2024, 1, 1)) for i in range(800)], U_SCHEMA)
    orders = spark.createDataFrame([o("1", "u0", D(2024, 1, 2), "1")], O_SCHEMA)
    r = cohort_retention(users, orders).first()
    assert r.cohort_size == 800 and r.month_0_users == 1 and r.month_0_retention_pct == 0.12


@pytest.fixture(scope="module")
def small_chain(spark):
    raw = raw_sources(spark, SF_SMALL)
    so, sp, su = stg_orders(raw["raw_orders"]), stg_products(raw["raw_products"]), stg_users(raw["raw_users"])
    return so, sp, su


def test_invariants(spark, small_chain):
    so, sp, su = small_chain
    mrc = monthly_revenue_by_country(so, su)
    valid = so.filter("status = 'completed' AND is_revenue_suspicious = 0 AND order_date IS NOT NULL")
    assert mrc.agg(F.sum("revenue_czk")).first()[0] == valid.agg(F.sum("revenue_czk")).first()[0]
    us = user_segments(su, so)
    assert us.count() == su.count()
    assert us.select("user_id").distinct().count() == us.count()
    cr = cohort_retention(us, so)
    assert cr.count() == cr.select("cohort_month").distinct().count()          # declared key
    for k in range(4):
        assert cr.filter((F.col(f"month_{k}_retention_pct") < 0) | (F.col(f"month_{k}_retention_pct") > 100)).count() == 0
    cp = category_performance(so, sp)
    assert cp.count() == cp.select("category").distinct().count()


def test_empty_inputs(spark):
    orders = spark.createDataFrame([], O_SCHEMA)
    users = spark.createDataFrame([("u1", "CZ", "18-24", D(2024, 1, 1)), (None, None, "unknown", None)], U_SCHEMA)
    products = spark.createDataFrame([], P_SCHEMA)
    assert monthly_revenue_by_country(orders, users).count() == 0
    assert category_performance(orders, products).count() == 0
    seg = {r.user_id: r for r in user_segments(users, orders).collect()}
    assert {r.segment for r in seg.values()} == {"lost"} and seg["u1"].days_since_registered is None
    cohorts = cohort_retention(user_segments(users, orders), orders).collect()
    assert [(r.cohort_month, r.cohort_size, r.month_0_users, r.month_0_retention_pct) for r in cohorts] == \
        [("2024-01", 1, 0, 0.0)]


def test_strict_casts_raise_on_overflow(spark):
    """Output casts are strict (ANSI) — an average margin of 10 or more
    does not fit DECIMAL(5,4) and fails the job instead of becoming NULL."""
    orders = spark.createDataFrame([o("1", "u", D(2024, 1, 1), "10", prod="a")], O_SCHEMA)
    products = spark.createDataFrame([("a", "Toys", "12.5")], "product_id string, category string, margin_pct string") \
        .withColumn("margin_pct", F.col("margin_pct").cast("decimal(6,4)"))
    with pytest.raises(Exception, match="(?i)overflow|cannot be represented|NUMERIC_VALUE_OUT_OF_RANGE"):
        category_performance(orders, products).collect()
