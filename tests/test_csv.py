"""CSV bound by name: other column orders, split files, quoted line breaks, rows that do not fit; scans with filters."""

import gzip

import pytest

import __spark_entry__ as E
from testkit import SF_SMALL
from tallyhouse.session import shared_dir
from tallyhouse.sources import read_csv_typed, read_table
from tallyhouse.sources.sinks import csv_files


def folder(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(tmp_path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_columns_are_bound_by_name(spark, tmp_path):
    base = folder(tmp_path, a="id,country\n1,CZ\n", b="country,id\nSK,2\n", c="id,extra,country\n3,x,PL\n")
    assert rows(read_csv_typed(spark, base, ["id", "country"])) == [("1", "CZ"), ("2", "SK"), ("3", "PL")]
    assert rows(read_csv_typed(spark, base, ["country"])) == [("CZ",), ("PL",), ("SK",)]
    with pytest.raises(ValueError, match="extra"):
        read_csv_typed(spark, base)
    with pytest.raises(ValueError, match="'extra'"):
        read_csv_typed(spark, base, ["extra"])


def test_odd_headers(spark, tmp_path):
    base = folder(tmp_path, a='"i\nd","cou.ntry"\n1,CZ\n', b='cou.ntry,"i\nd"\nSK,2\n', c="")
    (tmp_path / "d.csv.gz").write_bytes(gzip.compress(b"i\x00d,x\n"))
    with pytest.raises(ValueError):
        read_csv_typed(spark, base)
    (tmp_path / "d.csv.gz").write_bytes(gzip.compress('"i\nd",cou.ntry\n3,PL\n'.encode()))
    assert rows(read_csv_typed(spark, base)) == [("1", "CZ"), ("2", "SK"), ("3", "PL")]
    with pytest.raises(ValueError, match="twice"):
        read_csv_typed(spark, folder(tmp_path / "..", **{"dup": "a,a\n1,2\n"}) + "/dup.csv")


def test_a_large_file_is_several_tasks_unless_lines_are_quoted(spark, tmp_path):
    base = folder(tmp_path, a="id,note\n" + "".join(f'{i},"plain, {i}"\n' for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
        got = read_csv_typed(spark, base)
        assert got.rdd.getNumPartitions() >= 5 and got.count() == 20_000
        folder(tmp_path, b='id,note\n1,"two\nlines"\n')
        both = read_csv_typed(spark, base)
        assert both.count() == 20_001 and both.rdd.getNumPartitions() >= 6
        assert [r["note"] for r in both.where("note LIKE 'two%'").collect()] == ["two\nlines"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rows_that_do_not_fit_fail_with_their_count(spark, tmp_path):
    base = folder(tmp_path, a="id,country\n1,CZ,extra\n2\n3,SK\n", b='id,country\n4,"a\nb"\n5,x,y\n')
    with pytest.raises(ValueError, match=r"3 row\(s\) in 2 file\(s\).*a\.csv \(2\).*b\.csv \(1\)"):
        read_csv_typed(spark, base, ["id"])
    with pytest.raises(Exception):
        read_csv_typed(spark, base, ["id"], check=False).collect()


def test_every_value_comes_back(spark):
    values = [None, "", " a ", '"', 'say "x", y', "two\nlines", "\\", "\\\"", "é漢🙂", ",", "NULL", "\t"]
    table = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, v string")
    assert rows(read_csv_typed(spark, csv_files(table, f"{shared_dir(spark)}/values"))) == sorted(((str(i), v) for i, v in enumerate(values)), key=str)


def test_rows_of_both_producers_are_computed_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(E, "csv_files", lambda df, path: written.append(df._jdf.queryExecution().executedPlan().toString()) or csv_files(df, path))
    E.queries()["csv_round_trip"](spark, SF_SMALL)
    assert len(written) == 2 and not any("Join" in plan for plan in written)


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv_typed(spark, str(tmp_path))


def test_scan_queries_leave_filter_and_columns_to_the_scan(spark):
    """Read from the plan that ran."""
    for name, filters in (("scan_eq", ("In(o_orderstatus, [F,P])", "In(o_orderpriority, [1-URGENT,2-HIGH])")),
                          ("scan_ne", ("Not(In(o_orderstatus, [F,P]))",))):
        got = E.queries()[name](spark, SF_SMALL)
        assert got.count() > 0
        plan = got._jdf.queryExecution().executedPlan().toString()
        pushed = plan.split("PushedFilters: [")[1].split("], ReadSchema")[0]
        assert all(f in pushed for f in filters), pushed
        schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
        assert {c.split(":")[0] for c in schema.split(",")} <= {"o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"}
    one = read_table(spark, SF_SMALL, "orders", columns=["o_orderkey"], where={"o_orderstatus": ["F"]})
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "Exchange" not in plan
