"""Physical-plan assertions (SURVEY §5 (5)): the shapes the design relies on."""

import re
import pytest

from testkit import SF_SMALL
from tallyhouse.plans.audit import data_quality_issues
from tallyhouse.plans.cohort import cohort_retention
from tallyhouse.plans.marts import category_performance, category_totals, monthly_revenue_by_country, user_segments
from tallyhouse.plans.staging import stg_orders, stg_products, stg_users
from tallyhouse.sources.tables import raw_sources


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def chain(spark):
    raw = raw_sources(spark, SF_SMALL)
    so, sp, su = stg_orders(raw["raw_orders"]), stg_products(raw["raw_products"]), stg_users(raw["raw_users"])
    return raw, so, sp, su


def test_dedup_uses_partial_window_group_limit(chain):
    _, so, sp, su = chain
    for df in (so, sp, su):
        p = plan(df)
        assert "WindowGroupLimit" in p and "Partial" in p, p


def test_no_python_udfs_no_cartesian(spark, chain):
    raw, so, sp, su = chain
    us = user_segments(su, so)
    frames = [so, sp, su, monthly_revenue_by_country(so, su), category_performance(so, sp), us,
              cohort_retention(us, so),
              data_quality_issues(spark, raw["raw_orders"], raw["raw_products"], raw["raw_users"])]
    for df in frames:
        p = plan(df)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                    "BroadcastNestedLoopJoin"):
            assert bad not in p, (bad, p)


def test_orphans_join_preaggregated_keys(spark):
    from tallyhouse.operators.profile import orphans
    left = spark.range(100).selectExpr("CAST(id % 7 AS STRING) AS k")
    right = spark.range(3).selectExpr("CAST(id AS STRING) AS k")
    p = plan(orphans(left, right, "k"))
    # the join's left input is the per-key count, not the raw rows
    join_at = p.index("Join")
    assert "partial_count" in p[join_at:] and "LeftAnti" not in p
    assert orphans(left, right, "k").first()[0] == 100 - 15 - 15 - 14


def test_as_of_is_a_scalar_subquery(chain):
    _, so, _, su = chain
    p = plan(user_segments(su, so))
    assert "Subquery" in p


def test_scan_prunes_columns(spark):
    raw = raw_sources(spark, SF_SMALL)
    p = plan(stg_users(raw["raw_users"]))
    # the users view reads customer: c_name and c_acctbal are never read
    assert "c_custkey" in p and "c_mktsegment" in p
    assert "c_name" not in p and "c_acctbal" not in p


def _join_inputs_are_aggregated(p: str) -> bool:
    """Every join in the plan reads, on its fact side, an aggregate: the text
    between a join and the next FileScan below it contains an aggregate."""
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "Join" in line and "BroadcastExchange" not in line:
            below = "\n".join(lines[i + 1:i + 12])
            if "HashAggregate" not in below:
                return False
    return True


def test_marts_preaggregate_before_joining(spark, chain):
    from tallyhouse.session import shared_dir
    from tallyhouse.sources.sinks import write_table
    out = shared_dir(spark)
    so, sp, su = [spark.read.parquet(write_table(df, f"{out}/{i}")) for i, df in enumerate(chain[1:])]
    # category_performance stores its totals before it ranks them
    for df in (monthly_revenue_by_country(so, su), category_totals(so, sp), user_segments(su, so)):
        p = plan(df)
        assert "partial_sum" in p or "partial_count" in p
        assert _join_inputs_are_aggregated(p), p


def test_audit_reuses_dimension_key_counts(spark, chain):
    raw = chain[0]
    df = data_quality_issues(spark, raw["raw_orders"], raw["raw_products"], raw["raw_users"])
    executed = df._jdf.queryExecution().executedPlan()
    executed.execute().count()
    # products and users: one scan + shuffle serves both the duplicate count and the orphan check
    assert executed.toString().count("ReusedExchange") >= 2


def test_audit_scans_orders_twice(spark):
    from tallyhouse.plans.audit import issues_long
    from tallyhouse.plans.reference import ref_allowed_age_group, ref_allowed_status
    from tallyhouse.session import shared_dir
    from tallyhouse.sources.sinks import write_table
    raw, out = raw_sources(spark, SF_SMALL), shared_dir(spark)
    landed = {k: spark.read.parquet(write_table(df, f"{out}/{k}")) for k, df in raw.items()}
    p = plan(issues_long(landed["raw_orders"], landed["raw_products"], landed["raw_users"],
                         ref_allowed_status(spark), ref_allowed_age_group(spark)))
    scans = re.findall(r"FileScan parquet \[[^\]]*order_id#", p)
    assert len(scans) == 2, scans


def test_literal_reference_tables_broadcast_without_hints(spark):
    """The code lists and the catalog are VALUES tables with exact sizes, so the
    static plan already broadcasts them; no explicit hint is used."""
    from tallyhouse.plans.audit import order_findings
    from tallyhouse.plans.reference import ref_allowed_status
    big = spark.range(1000).selectExpr("CAST(id AS STRING) AS order_id", "'x' AS user_id", "'p' AS product_id",
                                       "'2024-01-01' AS order_date", "'1' AS quantity",
                                       "CASE WHEN id % 2 = 0 THEN 'completed' ELSE 'x' END AS status",
                                       "'1' AS revenue_czk", "'0.1' AS discount_pct")
    p = plan(order_findings(big, ref_allowed_status(spark)))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    import inspect
    import tallyhouse.plans.audit as audit_module
    assert "broadcast(" not in inspect.getsource(audit_module)
