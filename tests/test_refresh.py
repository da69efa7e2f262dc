"""The refresh job: every table written and re-readable; an audit failure is
reported while marts still run; a staging failure stops the job."""

import pytest

from testkit import SF_SMALL
from tallyhouse.plans import job as R
from tallyhouse.session import shared_dir
from tallyhouse.sources import read_table


def test_refresh_writes_everything(spark):
    res = R.refresh(spark, SF_SMALL, shared_dir(spark))
    assert not res.errors
    expected = set(R.STAGING) | set(R.REFERENCE) | set(R.MARTS) | {"data_quality_issues", "cohort_retention"}
    assert set(res.written) == expected
    for name in expected:
        assert res.table(spark, name).count() > 0, name
    cohort = res.table(spark, "cohort_retention")
    assert cohort.count() == cohort.select("cohort_month").distinct().count()
    issues = res.table(spark, "data_quality_issues")
    assert issues.filter("affected_rows <= 0").count() == 0
    assert "stg_orders" in res.register_views(spark)
    top = spark.sql("SELECT segment, count(*) AS n FROM user_segments GROUP BY segment").collect()
    assert sum(r.n for r in top) == res.table(spark, "stg_users").count()


def test_audit_failure_does_not_stop_marts(spark, monkeypatch):
    def broken(*a, **k):
        raise RuntimeError("audit exploded")
    monkeypatch.setattr(R, "data_quality_issues", broken)
    res = R.refresh(spark, SF_SMALL, shared_dir(spark))
    assert "audit" in res.errors and "exploded" in res.errors["audit"]
    assert "data_quality_issues" not in res.written
    assert res.table(spark, "cohort_retention").count() > 0


def test_staging_failure_stops(spark, monkeypatch):
    def broken(*a, **k):
        raise RuntimeError("staging exploded")
    monkeypatch.setattr(R, "stg_users", broken)
    with pytest.raises(RuntimeError, match="staging exploded"):
        R.refresh(spark, SF_SMALL, shared_dir(spark))


def test_resume_keeps_committed_tables(spark, monkeypatch):
    out = shared_dir(spark)
    first = R.refresh(spark, SF_SMALL, out)
    marker = f"{first.written['stg_orders']}/_SUCCESS"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(marker)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    before = fs.getFileStatus(path).getModificationTime()

    def broken(*a, **k):
        raise RuntimeError("staging should not be recomputed")
    monkeypatch.setattr(R, "write_files", broken)
    again = R.refresh(spark, SF_SMALL, out, resume=True)
    assert again.written == first.written and not again.errors
    assert fs.getFileStatus(path).getModificationTime() == before


def test_cli_runs_the_job(spark, capsys):
    out = shared_dir(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        R.main([SF_SMALL, out, "--resume"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    printed = capsys.readouterr().out
    assert "cohort_retention\t" in printed and "ERROR" not in printed
    assert read_table(spark, out, "cohort_retention").count() > 0


EXPECTED_TYPES = {
    "stg_orders": "order_id string, user_id string, product_id string, order_date date, quantity decimal(38,0), "
                  "status string, revenue_czk decimal(18,2), discount_pct decimal(6,4), is_revenue_suspicious int, "
                  "is_status_unknown int, is_quantity_invalid int, loaded_at timestamp, source_table string",
    "stg_products": "product_id string, product_name string, category string, price_czk decimal(18,2), "
                    "margin_pct decimal(6,4), is_active int, is_price_invalid int, is_margin_out_of_range int, "
                    "is_category_missing int, loaded_at timestamp, source_table string",
    "stg_users": "user_id string, country string, acquisition_channel string, registered_at date, age_group string, "
                 "is_age_group_unknown int, is_country_unknown int, is_channel_unknown int, "
                 "is_registered_at_invalid int, loaded_at timestamp, source_table string",
    "data_quality_issues": "table_name string, issue_type string, affected_rows bigint, description string, "
                           "recommended_fix string",
    "monthly_revenue_by_country": "month date, country string, revenue_czk decimal(18,2), "
                                  "prev_month_revenue_czk decimal(18,2), mom_growth_pct decimal(10,2)",
    "category_performance": "category string, total_revenue_czk decimal(18,2), avg_margin_pct decimal(5,4), "
                            "order_count bigint, avg_discount_pct decimal(5,4), revenue_rank bigint",
    "user_segments": "user_id string, country string, age_group string, registered_at date, last_order_date date, "
                     "order_count bigint, total_revenue_czk decimal(18,2), days_since_registered bigint, "
                     "days_since_last_order bigint, segment string",
    "cohort_retention": "cohort_month string, cohort_size bigint, month_0_users bigint, month_1_users bigint, "
                        "month_2_users bigint, month_3_users bigint, month_0_retention_pct double, "
                        "month_1_retention_pct double, month_2_retention_pct double, month_3_retention_pct double",
}


def test_published_schemas_match_the_contract(spark):
    res = R.refresh(spark, SF_SMALL, shared_dir(spark))
    for name, ddl in EXPECTED_TYPES.items():
        got = ", ".join(f"{c} {t}" for c, t in res.table(spark, name).dtypes)
        assert got == ddl, name
