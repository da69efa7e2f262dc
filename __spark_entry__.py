"""
(DuckDB) for every dataset and component operator of the refresh chain.

Every query reads the driver's tables under ``sf_dir`` in full — the raw_*
sources are deterministic rewrites of ``lineitem``/``orders``/``part``/
``customer`` (FIXTURES.md) — so the work grows with the scale factor.
"""

from __future__ import annotations

import logging
import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from duckdb_oracle import oracle_queries  # noqa: E402
from tallyhouse.operators.profile import duplicates, orphans  # noqa: E402
from tallyhouse.operators.dedup import keep_best  # noqa: E402
from tallyhouse.plans import audit, cohort, marts, staging  # noqa: E402
from tallyhouse.plans.job import STAGING, published_run, refresh  # noqa: E402
from tallyhouse.plans.reference import ref_allowed_age_group, ref_allowed_status  # noqa: E402
from tallyhouse.session import apply_conf, shared_dir  # noqa: E402
from tallyhouse.functions.exprs import (  # noqa: E402
    initcap_words,
    parse_bool,
    status_norm,
    try_date,
)
from tallyhouse.operators.cohort import cohort_sizes  # noqa: E402
from tallyhouse.operators.ranges import rank_by, row_numbers  # noqa: E402
from tallyhouse.operators.series import mom_growth  # noqa: E402
from tallyhouse.sources.sinks import csv_files, write_table, written_back  # noqa: E402
from tallyhouse.sources.tables import SOURCE_COLUMNS, raw_sources, read_csv_typed, read_table  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    apply_conf(spark)
    return raw_sources(spark, sf_dir)


def _staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = _raw(spark, sf_dir)
    return {
        "stg_orders": staging.stg_orders(raw["raw_orders"], with_loaded_at=False),
        "stg_products": staging.stg_products(raw["raw_products"], with_loaded_at=False),
        "stg_users": staging.stg_users(raw["raw_users"], with_loaded_at=False),
    }


# ------------------------------------------------------------------ datasets
def q_stg_orders(spark, sf_dir):
    return _staged(spark, sf_dir)["stg_orders"]


def q_stg_products(spark, sf_dir):
    return _staged(spark, sf_dir)["stg_products"]


def q_stg_users(spark, sf_dir):
    return _staged(spark, sf_dir)["stg_users"]


def q_data_quality_issues(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return audit.data_quality_issues(spark, raw["raw_orders"], raw["raw_products"], raw["raw_users"])


def q_monthly_revenue_by_country(spark, sf_dir):
    s = _staged(spark, sf_dir)
    return marts.monthly_revenue_by_country(s["stg_orders"], s["stg_users"])


def q_category_performance(spark, sf_dir):
    s = _staged(spark, sf_dir)
    return marts.category_performance(s["stg_orders"], s["stg_products"])


def q_user_segments(spark, sf_dir):
    s = _staged(spark, sf_dir)
    return marts.user_segments(s["stg_users"], s["stg_orders"])


def q_cohort_retention(spark, sf_dir):
    s = _staged(spark, sf_dir)
    return cohort.cohort_retention(marts.user_segments(s["stg_users"], s["stg_orders"]), s["stg_orders"])


# The money column of each table that has one.
_MONEY = {"stg_orders": "revenue_czk", "monthly_revenue_by_country": "revenue_czk",
          "category_performance": "total_revenue_czk", "user_segments": "total_revenue_czk"}


def q_refresh(spark, sf_dir):
    """The whole refresh written to a shared folder, each of the 11 tables read
    back as (table_name, n_rows, n_values, money): its rows, its values that are not
    NULL (without ``loaded_at``) and the sum of its money column."""
    apply_conf(spark)
    res = refresh(spark, sf_dir, shared_dir(spark))
    if res.errors:
        raise RuntimeError(f"refresh reported errors: {res.errors}")
    out = None
    for name in sorted(res.written):
        table = res.table(spark, name).drop("loaded_at")
        money = F.sum(_MONEY[name]) if name in _MONEY else F.lit(None)
        filled = reduce(Column.__add__, [F.count(c) for c in table.columns])
        part = table.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                         filled.alias("n_values"), money.cast("decimal(28,2)").alias("money"))
        out = part if out is None else out.unionByName(part)
    return out


def q_run_stamp(spark, sf_dir):
    """The refresh published and read back through its publication: per staged table
    its rows, the rows with a stamp, and whether that stamp is the one of the run."""
    apply_conf(spark)
    out = shared_dir(spark)
    res = refresh(spark, sf_dir, out, run_audit=False)
    assert published_run(spark, out).run == res.run
    parts = [read_table(spark, out, name).agg(
        F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.count("loaded_at").alias("n_stamped"),
        F.countDistinct("loaded_at").alias("n_stamps"), F.count_if(F.col("loaded_at") == F.lit(res.loaded_at)).alias("n_of_run"))
        for name in STAGING]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------ stored order
def q_monthly_revenue_ordered(spark, sf_dir):
    """O1: the mart with the position of every row in its stored order."""
    return row_numbers(q_monthly_revenue_by_country(spark, sf_dir), marts.mart_order("monthly_revenue_by_country"))


def q_category_performance_ordered(spark, sf_dir):
    return row_numbers(q_category_performance(spark, sf_dir), marts.mart_order("category_performance"))


def q_user_segments_ordered(spark, sf_dir):
    return row_numbers(q_user_segments(spark, sf_dir), marts.mart_order("user_segments"))


def q_cohort_retention_ordered(spark, sf_dir):
    """O2."""
    return row_numbers(q_cohort_retention(spark, sf_dir), [F.col("cohort_month").asc_nulls_first()])


def q_issues_ordered(spark, sf_dir):
    issues = q_data_quality_issues(spark, sf_dir).select("table_name", "issue_type", "affected_rows")
    return row_numbers(issues, [F.col("table_name").asc(), F.col("issue_type").asc()])


# ------------------------------------------------------- sources and sinks
def q_scan_eq(spark, sf_dir):
    """A mapped table with a value list and a column list, both left to the scan."""
    return read_table(spark, sf_dir, "orders", columns=["o_orderkey", "o_custkey", "o_orderstatus"],
                      where={"o_orderstatus": ["F", "P"], "o_orderpriority": ["1-URGENT", "2-HIGH"]})


def q_scan_ne(spark, sf_dir):
    return read_table(spark, sf_dir, "orders", columns=["o_orderkey", "o_custkey", "o_orderstatus"],
                      where={"o_orderstatus": ["F", "P"]}, where_operator="ne")


def q_csv_round_trip(spark, sf_dir):
    """The raw orders written as CSV by two producers, one with another column order
    and a column more, and read back by name. Both write from rows stored once."""
    orders, base = _raw(spark, sf_dir)["raw_orders"], f"{shared_dir(spark)}/landed"
    columns = SOURCE_COLUMNS["raw_orders"]
    completed = status_norm("status").eqNullSafe("completed")
    orders = written_back(orders.select(*columns, completed.alias("completed")), "raw-orders")
    csv_files(orders.where("completed").select(*columns), f"{base}/one")
    csv_files(orders.where("NOT completed").select(*reversed(columns), F.lit('two, "quoted"\nlines').alias("note")), f"{base}/two")
    return read_csv_typed(spark, base, columns)


def q_replaced_products(spark, sf_dir):
    """A table replaced whole under its declared key, read through its publication."""
    raw, out = _raw(spark, sf_dir)["raw_products"], shared_dir(spark)
    write_table(raw, f"{out}/products")
    write_table(staging.stg_products(raw, with_loaded_at=False), f"{out}/products", key="product_id")
    return read_table(spark, out, "products")


# ------------------------------------------------------------ components
def q_dedup_orders(spark, sf_dir):
    """keep_best on the raw orders: the raw row kept per order_id."""
    o = _raw(spark, sf_dir)["raw_orders"]
    cols = SOURCE_COLUMNS["raw_orders"]
    order = staging.order_preference(try_date("order_date"))
    return keep_best(o, "order_id", order).select(*cols)


def q_issues_long(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return audit.issues_long(raw["raw_orders"], raw["raw_products"], raw["raw_users"],
                             ref_allowed_status(spark), ref_allowed_age_group(spark))


def q_orders_profile(spark, sf_dir):
    return audit.order_findings(_raw(spark, sf_dir)["raw_orders"], ref_allowed_status(spark))


def q_products_profile(spark, sf_dir):
    return audit.product_findings(_raw(spark, sf_dir)["raw_products"])


def q_users_profile(spark, sf_dir):
    return audit.user_findings(_raw(spark, sf_dir)["raw_users"], ref_allowed_age_group(spark))


def _source_keys(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return {table: audit.source_keys(raw[f"raw_{table}"], table) for table in audit.KEYS}


def q_duplicate_keys(spark, sf_dir):
    out = None
    for table, keys in _source_keys(spark, sf_dir).items():
        part = duplicates(keys, audit.KEYS[table][0]).select(F.lit(table).alias("table_name"), "dup_rows")
        out = part if out is None else out.unionByName(part)
    return out


def q_orphan_users(spark, sf_dir):
    keys = _source_keys(spark, sf_dir)
    return orphans(keys["orders"], keys["users"], "user_id")


def q_orphan_products(spark, sf_dir):
    keys = _source_keys(spark, sf_dir)
    return orphans(keys["orders"], keys["products"], "product_id")


def q_status_normalized(spark, sf_dir):
    """status_norm + is_status_unknown truth table over every raw status value."""
    o = _raw(spark, sf_dir)["raw_orders"]
    return (o.groupBy(F.col("status").alias("raw_status"),
                      status_norm("status").alias("status"),
                      staging.status_unknown().alias("is_status_unknown"))
             .agg(F.count(F.lit(1)).alias("rows")))


def q_bool_parsed(spark, sf_dir):
    p = _raw(spark, sf_dir)["raw_products"]
    return (p.groupBy(F.col("is_active").alias("raw_is_active"), parse_bool("is_active").alias("is_active"))
             .agg(F.count(F.lit(1)).alias("rows")))


def q_initcap_values(spark, sf_dir):
    """INITCAP over texts full of delimiters: every page address and event payload."""
    texts = (spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("url").alias("raw"))
             .unionByName(spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("props").alias("raw"))))
    return (texts.groupBy("raw").agg(F.count(F.lit(1)).alias("rows"))
            .select("raw", initcap_words(F.lower(F.trim("raw"))).alias("capped"), "rows"))


#: What may stand around a date; the order key decides which (as in the raw views).
DATE_TAILS_SQL = """
SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN d WHEN 1 THEN d || ' 10:30:00' WHEN 2 THEN d || 'T07:30:00' WHEN 3 THEN d || ' n/a'
  WHEN 4 THEN d || 'Tfoo' WHEN 5 THEN ' ' || d || ' ' WHEN 6 THEN REPLACE(d, '-0', '-') WHEN 7 THEN d || ' 25:99:00' ELSE '  ' END AS raw
FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d FROM {orders}) t
"""


def q_dates_parsed(spark, sf_dir):
    """The date rule on dates with times, other tails, blanks and short months."""
    apply_conf(spark)
    raw = spark.sql(DATE_TAILS_SQL, orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))
    return raw.select("o_orderkey", "raw", try_date("raw").alias("parsed"))


def q_flag_counts(spark, sf_dir):
    """How many staged rows carry each of the 10 quality flags: (flag, rows)."""
    s = _staged(spark, sf_dir)
    flags = {"stg_orders": ("is_revenue_suspicious", "is_status_unknown", "is_quantity_invalid"),
             "stg_products": ("is_price_invalid", "is_margin_out_of_range", "is_category_missing"),
             "stg_users": ("is_age_group_unknown", "is_country_unknown", "is_channel_unknown",
                           "is_registered_at_invalid")}
    out = None
    for table, cols in flags.items():
        wide = s[table].agg(*[F.sum(c).cast("bigint").alias(c) for c in cols])
        long = wide.unpivot(ids=[], values=list(cols), variableColumnName="flag", valueColumnName="rows")
        out = long if out is None else out.unionByName(long)
    return out


def q_monthly_revenue(spark, sf_dir):
    s = _staged(spark, sf_dir)
    m = marts.monthly_revenue(s["stg_orders"], s["stg_users"])
    return m.select("month", "country", F.col("revenue_czk").cast("decimal(18,2)").alias("revenue_czk"))


def q_mom_growth(spark, sf_dir):
    """Previous row's revenue and month per country, and the growth."""
    s = _staged(spark, sf_dir)
    return mom_growth(marts.monthly_revenue(s["stg_orders"], s["stg_users"]), "country", "month",
                      "revenue_czk", prev_month_name="prev_month")


def q_category_rank(spark, sf_dir):
    """Rank of each category by revenue (ties share a rank, NULLs first)."""
    s = _staged(spark, sf_dir)
    totals = marts.category_totals(s["stg_orders"], s["stg_products"])
    return rank_by(totals.select("category", F.col("total_revenue_czk").cast("decimal(18,2)").alias("total_revenue_czk")),
                   "total_revenue_czk", "revenue_rank")


def q_user_metrics(spark, sf_dir):
    s = _staged(spark, sf_dir)
    m = marts.user_metrics(s["stg_users"], s["stg_orders"])
    return m.select("user_id", "country", "age_group", "registered_at",
                    F.col("order_count").cast("bigint").alias("order_count"),
                    F.col("total_revenue_czk").cast("decimal(18,2)").alias("total_revenue_czk"),
                    "last_order_date")


def q_segment_counts(spark, sf_dir):
    us = q_user_segments(spark, sf_dir)
    return us.groupBy("segment").agg(F.count(F.lit(1)).alias("users"),
                                     F.sum("total_revenue_czk").cast("decimal(18,2)").alias("total_revenue_czk"))


def q_cohort_size(spark, sf_dir):
    s = _staged(spark, sf_dir)
    sizes = cohort_sizes(marts.user_segments(s["stg_users"], s["stg_orders"]))
    return sizes.select(F.date_format("cohort_month", "yyyy-MM").alias("cohort_month"),
                        F.col("cohort_size").cast("bigint").alias("cohort_size"))


def q_cohort_activity_long(spark, sf_dir):
    s = _staged(spark, sf_dir)
    act = cohort.cohort_activity_long(marts.user_segments(s["stg_users"], s["stg_orders"]), s["stg_orders"])
    return act.select(F.date_format("cohort_month", "yyyy-MM").alias("cohort_month"), "offset",
                      F.col("users").cast("bigint").alias("users"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_orders": q_stg_orders,
    "stg_products": q_stg_products,
    "stg_users": q_stg_users,
    "data_quality_issues": q_data_quality_issues,
    "monthly_revenue_by_country": q_monthly_revenue_by_country,
    "category_performance": q_category_performance,
    "user_segments": q_user_segments,
    "cohort_retention": q_cohort_retention,
    "refresh": q_refresh,
    "run_stamp": q_run_stamp,
    "monthly_revenue_ordered": q_monthly_revenue_ordered,
    "category_performance_ordered": q_category_performance_ordered,
    "user_segments_ordered": q_user_segments_ordered,
    "cohort_retention_ordered": q_cohort_retention_ordered,
    "issues_ordered": q_issues_ordered,
    "scan_eq": q_scan_eq,
    "scan_ne": q_scan_ne,
    "csv_round_trip": q_csv_round_trip,
    "replaced_products": q_replaced_products,
    "dedup_orders": q_dedup_orders,
    "issues_long": q_issues_long,
    "orders_profile": q_orders_profile,
    "products_profile": q_products_profile,
    "users_profile": q_users_profile,
    "duplicate_keys": q_duplicate_keys,
    "orphan_users": q_orphan_users,
    "orphan_products": q_orphan_products,
    "status_normalized": q_status_normalized,
    "bool_parsed": q_bool_parsed,
    "initcap_values": q_initcap_values,
    "dates_parsed": q_dates_parsed,
    "flag_counts": q_flag_counts,
    "monthly_revenue": q_monthly_revenue,
    "mom_growth": q_mom_growth,
    "category_rank": q_category_rank,
    "user_metrics": q_user_metrics,
    "segment_counts": q_segment_counts,
    "cohort_size": q_cohort_size,
    "cohort_activity_long": q_cohort_activity_long,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: monthly revenue by country with MoM growth, at sf0.001."""
    return q_monthly_revenue_by_country(spark, SMOKE_DIR)


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators, where that folder exists."""
    try:
        import corpus_pipeline
        from tallyhouse.llm.queries import ORACLES, QUERIES
    except ImportError as error:  # the folder, or something it needs, is absent: the rest stays
        logging.getLogger(__name__).warning("training-data queries are not registered: %s", error)
        return {}, {}
    sql = ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return QUERIES | {"pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    sql = oracle_queries()
    return {name: sql[name] for name in _QUERIES if name in sql} | _training_data()[1]
