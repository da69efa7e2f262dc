"""Publishing whole: tables replaced and runs switched without a gap, declared keys, one stamp."""

import threading

import pytest
from pyspark.sql import functions as F

from testkit import strings
from tallyhouse.plans import job
from tallyhouse.session import shared_dir
from tallyhouse.sources import DuplicateKey, read_csv_typed, read_table, write_csv, write_table
from tallyhouse.sources.published import LOG, Files, Log
from tallyhouse.sources.tables import SOURCE_COLUMNS

ALL = {*job.STAGING, *job.REFERENCE, *job.MARTS, "data_quality_issues", "cohort_retention"}


def land(spark, revenue, products=(("p1", "Name", "Cat", "5", "0.2", "1"),)):
    out = shared_dir(spark)
    rows = {"raw_orders": [("o1", "u1", "p1", "2024-01-05", "1", "completed", revenue, "0")],
            "raw_products": list(products), "raw_users": [("u1", "CZ", "direct", "2024-01-01", "18-24")]}
    for name, r in rows.items():
        strings(spark, SOURCE_COLUMNS[name], r).write.parquet(f"{out}/{name}")
    return out


def revenue(spark, out):
    return str(read_table(spark, out, "monthly_revenue_by_country").agg(F.sum("revenue_czk")).first()[0])


def test_the_newest_whole_entry_counts(spark):
    log = Log(spark, shared_dir(spark))
    assert log.current() is None and log.entries() == []
    assert [log.publish({"data": d}) for d in "abc"] == [1, 2, 3]
    log.files.create(f"{log.folder}/{LOG}/{4:012d}.json", '{"data": "d')  # a writer that died, or is still at it
    assert log.current() == {"data": "c"}
    assert log.publish({"data": "e"}) == 5 and log.current() == {"data": "e"}
    assert log.forget(2) == [{"data": "b"}, {"data": "a"}] and [e["data"] for e in log.entries()] == ["e", "c"]


def test_two_writers_of_one_number_both_publish(spark):
    log = Log(spark, shared_dir(spark))
    log.publish({"data": "a"})
    assert not log.files.create(f"{log.folder}/{LOG}/{1:012d}.json", "x")
    assert log.current() == {"data": "a"}


def test_a_reader_sees_old_or_new_rows_never_none(spark):
    base = shared_dir(spark)
    write_table(spark.range(500).withColumn("v", F.lit(0)), f"{base}/t")
    seen, stop, failed = set(), threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                seen.add(tuple(read_table(spark, base, "t").agg(F.count("id"), F.min("v"), F.max("v")).first()))
            except Exception as exc:
                failed.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 6):
        write_table(spark.range(500).withColumn("v", F.lit(v)), f"{base}/t", keep=6)
    stop.set()
    reader.join()
    assert not failed and seen <= {(500, v, v) for v in range(6)} and len(seen) > 1
    assert read_table(spark, base, "t").first()["v"] == 5


def test_old_versions_go_and_a_failed_write_changes_nothing(spark):
    path = f"{shared_dir(spark)}/t"
    for v in range(4):
        write_table(spark.range(2).withColumn("v", F.lit(v)), path, keep=2)
    bad = spark.range(3).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        write_table(bad, path)
    with pytest.raises(DuplicateKey, match="t: 1 value"):
        write_table(spark.range(2).selectExpr("id", "7 AS v"), path, key="v")
    base, name = path.rsplit("/", 1)
    assert {r["v"] for r in read_table(spark, base, name).collect()} == {3}
    assert len([n for n in Files(spark, path).names(path) if n.startswith("data-")]) == 2


def test_csv_primary_key_is_unique_and_not_null(spark):
    path = f"{shared_dir(spark)}/cohort"
    write_csv(spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "cohort_month string, n int"), path, key="cohort_month")
    for rows in ([("2024-01", 1), ("2024-01", 2)], [(None, 1)]):
        with pytest.raises(DuplicateKey, match="cohort_month"):
            write_csv(spark.createDataFrame(rows, "cohort_month string, n int"), path, key="cohort_month")
    assert read_csv_typed(spark, path).count() == 2


def test_readers_keep_the_last_whole_run(spark, monkeypatch):
    out, real = shared_dir(spark), job.write_files
    with pytest.raises(FileNotFoundError):
        job.published_run(spark, out)
    first = job.refresh(spark, land(spark, "10"), out)
    assert first.published and set(job.published_run(spark, out).written) == ALL
    seen = []

    def watching(df, path, **more):
        now = job.published_run(spark, out)
        seen.append((now.run, set(now.written), revenue(spark, out)))
        if path.endswith("user_segments"):
            raise RuntimeError("mart")
        return real(df, path, **more)

    second = land(spark, "999")
    monkeypatch.setattr(job, "write_files", watching)
    with pytest.raises(RuntimeError, match="mart"):
        job.refresh(spark, second, out)
    assert len(seen) >= 8 and all(s == (first.run, ALL, "10.00") for s in seen)
    assert job.published_run(spark, out).run == first.run
    monkeypatch.setattr(job, "write_files", real)
    third = job.refresh(spark, second, out, resume=True)
    now = job.published_run(spark, out)
    assert now.run == third.run != first.run and set(now.written) == ALL and revenue(spark, out) == "999.00"
    assert {p.split("/runs/")[1].split("/")[0] for p in now.written.values()} == {third.run}


def test_a_run_without_its_audit_is_published_only_when_accepted(spark, monkeypatch):
    out = shared_dir(spark)
    job.refresh(spark, land(spark, "10"), out)

    def broken(*a, **k):
        raise RuntimeError("audit exploded")

    monkeypatch.setattr(job, "data_quality_issues", broken)
    second = land(spark, "20")
    res = job.refresh(spark, second, out)
    assert "audit" in res.errors and not res.published and revenue(spark, out) == "10.00"
    assert str(res.table(spark, "monthly_revenue_by_country").first()["revenue_czk"]) == "20.00"
    assert job.refresh(spark, second, out, resume=True, accept_audit_failure=True).published
    now = job.published_run(spark, out)
    assert revenue(spark, out) == "20.00" and "data_quality_issues" not in now.written and "exploded" in now.errors["audit"]


def test_runs_that_newer_ones_followed_go(spark):
    out = shared_dir(spark)
    runs = [job.refresh(spark, land(spark, str(v)), out, run_audit=False, keep=2).run for v in (1, 2, 3)]
    assert sorted(Files(spark, out).names(f"{out}/{job.RUNS}")) == sorted(runs[1:]) and revenue(spark, out) == "3.00"


def test_a_doubled_key_stops_the_refresh_with_its_name(spark, monkeypatch):
    out, whole = shared_dir(spark), job.stg_products
    job.refresh(spark, land(spark, "10"), out, run_audit=False)
    monkeypatch.setattr(job, "stg_products", lambda raw, **more: whole(raw, **more).unionByName(whole(raw, **more)))
    with pytest.raises(DuplicateKey, match="stg_products.*product_id='p1'"):
        job.refresh(spark, land(spark, "20"), out, run_audit=False)
    assert revenue(spark, out) == "10.00"


def test_one_stamp_per_run_also_after_a_resume(spark, monkeypatch):
    out, source, real = shared_dir(spark), land(spark, "10"), job.write_files

    def dies(df, path, **more):
        if path.endswith("stg_users"):
            raise RuntimeError("lost")
        return real(df, path, **more)

    monkeypatch.setattr(job, "write_files", dies)
    with pytest.raises(RuntimeError):
        job.refresh(spark, source, out, run_audit=False)
    monkeypatch.setattr(job, "write_files", real)
    res = job.refresh(spark, source, out, run_audit=False, resume=True)
    stamps = {r[0] for t in job.STAGING for r in res.table(spark, t).select(F.unix_micros("loaded_at")).collect()}
    assert stamps == {round(res.loaded_at.timestamp() * 1e6)}
