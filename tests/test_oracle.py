"""DuckDB oracle parity for every registered query (the driver's gate),
run here at sf0.001; ``tools/compare_oracle.py`` runs it at sf0.01."""

import os
import sys

import duckdb
import pytest

from testkit import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import compare_oracle as C  # noqa: E402

import __spark_entry__ as E  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in C.DUCK_TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    """Those of the training-data folder are tested there."""
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = df.collect()
    scols = [(f.name, C.spark_type(f.dataType)) for f in df.schema.fields]
    rel = duck.sql(E.oracle_sql()[name])
    dcols = list(zip(rel.columns, [str(t).upper() for t in rel.types]))
    drows = rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    order = sorted(c for c, _ in scols)
    si = [[c for c, _ in scols].index(c) for c in order]
    di = [[c for c, _ in dcols].index(c) for c in order]
    sv = sorted(tuple(C.norm(r[i]) for i in si) for r in srows)
    dv = sorted(tuple(C.norm(r[i]) for i in di) for r in drows)
    assert sv == dv


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["month", "country", "revenue_czk", "prev_month_revenue_czk", "mom_growth_pct"]
