"""Faults that the shared fixture does not reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.exprs import try_date
from tallyhouse.operators.cohort import cohort_activity, cohort_sizes, pivot_cohort
from tallyhouse.plans import job
from tallyhouse.session import partition_bytes, shared_dir
from tallyhouse.sources.tables import SOURCE_COLUMNS, raw_sources, read_csv_typed

from testkit import strings


def test_text_after_a_date_is_no_date(spark):
    rows = [("2024-01-05",), ("2024-1-5 7:30",), ("2024-01-05T07:30:00.5Z",), ("2024-01-05 n/a",), ("2024-01-05Tfoo",), ("2024-01-05 25:99",)]
    got = [r[0] for r in strings(spark, ["d"], rows).select(try_date("d")).collect()]
    assert got == [dt.date(2024, 1, 5)] * 3 + [None] * 3


def test_cohort_counts_a_user_once_and_blank_ids_never(spark):
    day = dt.date(2024, 1, 3)
    users = spark.createDataFrame([("a", day), ("a", day), ("b", day), ("", day), (" ", day), (None, day)], "user_id string, registered_at date")
    events = spark.createDataFrame([("a", day), ("b", day), ("", day), ("a", day)], "user_id string, order_date date")
    row = pivot_cohort(cohort_sizes(users), cohort_activity(users, events)).first()
    assert (row["cohort_size"], row["month_0_users"], row["month_0_retention_pct"]) == (2, 2, 100.0)


def _write(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_csv_keeps_quoted_line_breaks(spark, tmp_path):
    got = read_csv_typed(spark, _write(tmp_path, a='id,country\n1,"C\nZ"\n2,"say ""x"""\n')).collect()
    assert sorted(map(tuple, got)) == [("1", "C\nZ"), ("2", 'say "x"')]


def test_csv_with_other_columns_fails(spark, tmp_path):
    with pytest.raises(Exception):
        read_csv_typed(spark, _write(tmp_path, a="id,country\n1,CZ,extra\n"), ["id"]).collect()


def test_a_folder_without_one_source_fails_with_its_name(spark):
    out = shared_dir(spark)
    for name in ("raw_orders", "raw_products"):
        strings(spark, SOURCE_COLUMNS[name], []).write.parquet(f"{out}/{name}")
    with pytest.raises(FileNotFoundError, match="raw_users"):
        raw_sources(spark, out)


def test_partition_bytes_grow_with_the_input():
    mb, tb = 1 << 20, 1 << 40
    assert partition_bytes(1 << 30) == partition_bytes(tb) == 128 * mb
    assert partition_bytes(16 * tb) == 512 * mb and partition_bytes(100 * tb) == 1024 * mb


def _land(spark, revenue):
    out = shared_dir(spark)
    rows = {"raw_orders": [("o1", "u1", "p1", "2024-01-05", "1", "completed", revenue, "0")],
            "raw_products": [("p1", "Name", "Cat", "5", "0.2", "1")], "raw_users": [("u1", "CZ", "direct", "2024-01-01", "18-24")]}
    for name, r in rows.items():
        strings(spark, SOURCE_COLUMNS[name], r).write.parquet(f"{out}/{name}")
    return out


def test_resume_never_joins_two_generations(spark, monkeypatch):
    out, real = shared_dir(spark), job.write_files
    job.refresh(spark, _land(spark, "10"), out, run_audit=False)
    second = _land(spark, "999")

    def dies(df, path, **more):
        if path.endswith("stg_products"):
            raise RuntimeError("lost")
        return real(df, path, **more)

    monkeypatch.setattr(job, "write_files", dies)
    with pytest.raises(RuntimeError):
        job.refresh(spark, second, out, run_audit=False)
    monkeypatch.setattr(job, "write_files", real)
    got = job.refresh(spark, second, out, run_audit=False, resume=True)
    assert str(got.table(spark, "monthly_revenue_by_country").agg(F.sum("revenue_czk")).first()[0]) == "999.00"


def test_no_cohort_after_a_failed_mart(spark, monkeypatch):
    out, real, written = shared_dir(spark), job.write_files, []

    def fails(df, path, **more):
        if path.endswith("monthly_revenue_by_country"):
            raise RuntimeError("mart")
        written.append(path)
        return real(df, path, **more)

    monkeypatch.setattr(job, "write_files", fails)
    with pytest.raises(RuntimeError):
        job.refresh(spark, _land(spark, "10"), out, run_audit=False)
    assert not any(p.endswith("cohort_retention") for p in written)
