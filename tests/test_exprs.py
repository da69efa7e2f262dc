"""Truth tables for the scalar helpers (SURVEY §5 (1))."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from testkit import strings
from tallyhouse.functions import exprs as X


def one_col(spark, values):
    return strings(spark, ["v"], [(v,) for v in values])


def evaluate(spark, values, expr):
    df = one_col(spark, values).select("v", expr.alias("out"))
    return {r.v: r.out for r in df.collect()}


def test_blank(spark):
    got = evaluate(spark, [None, "", "   ", " a ", "\ta"], X.blank("v"))
    assert got == {None: None, "": None, "   ": None, " a ": "a", "\ta": "\ta"}


def test_try_num_bare_number_rounds(spark):
    got = evaluate(spark, [None, "", "0", "0.4", "0.5", "-0.4", "free", "1.005", " 12 "], X.try_num("v"))
    assert got == {None: None, "": None, "0": Decimal(0), "0.4": Decimal(0), "0.5": Decimal(1),
                   "-0.4": Decimal(0), "free": None, "1.005": Decimal(1), " 12 ": Decimal(12)}


def test_try_num_scale_and_overflow(spark):
    got = evaluate(spark, ["100", "1.0001", "0.12345", "-0.01", "1"], X.try_num("v", 6, 4))
    assert got == {"100": None, "1.0001": Decimal("1.0001"), "0.12345": Decimal("0.1235"),
                   "-0.01": Decimal("-0.0100"), "1": Decimal("1.0000")}


def test_try_date_requires_full_date(spark):
    vals = ["2024-01-05", "2024-1-5", "2024", "2024-01", "05.01.2024", "2024-02-30",
            "2024-01-05 10:00:00", "", None, "n/a"]
    got = evaluate(spark, vals, X.try_date("v"))
    d = dt.date(2024, 1, 5)
    assert got == {"2024-01-05": d, "2024-1-5": d, "2024": None, "2024-01": None, "05.01.2024": None,
                   "2024-02-30": None, "2024-01-05 10:00:00": d, "": None, None: None, "n/a": None}


def test_status_norm(spark):
    vals = [None, "", " Completed ", "kompletní", "KOMPLETNÍ", "shipped", "CANCELLED", "returned"]
    got = evaluate(spark, vals, X.status_norm("v"))
    assert got == {None: None, "": None, " Completed ": "completed", "kompletní": "completed",
                   "KOMPLETNÍ": "completed", "shipped": None, "CANCELLED": "cancelled", "returned": "returned"}


def test_parse_bool(spark):
    vals = ["1", "ANO", " t ", "ne", "N", "maybe", None, "Yes", "false"]
    got = evaluate(spark, vals, X.parse_bool("v"))
    assert got == {"1": 1, "ANO": 1, " t ": 1, "ne": 0, "N": 0, "maybe": None, None: None, "Yes": 1, "false": 0}


def test_flag_null_is_zero(spark):
    df = one_col(spark, ["a", None]).select("v", X.flag(F.col("v") == "a").alias("f"))
    assert {r.v: r.f for r in df.collect()} == {"a": 1, None: 0}


def test_code_or(spark):
    got = evaluate(spark, [" cz", "DE", None, "sk "], X.code_or("v", ("CZ", "SK"), case="upper"))
    assert got == {" cz": "CZ", "DE": None, None: None, "sk ": "SK"}
    got = evaluate(spark, [" 55+ ", "55 plus", None], X.code_or("v", ("55+",), default="unknown"))
    assert got == {" 55+ ": "55+", "55 plus": "unknown", None: "unknown"}


def test_initcap_words_splits_on_punctuation(spark):
    vals = ["home & garden/toys-kids", "standard anodized tin", "", None, "a.b,c(d)e", "x  y", "o'neil"]
    got = evaluate(spark, vals, X.initcap_words(F.lower(F.trim("v"))))
    assert got == {"home & garden/toys-kids": "Home & Garden/Toys-Kids",
                   "standard anodized tin": "Standard Anodized Tin", "": "", None: None,
                   "a.b,c(d)e": "A.B,C(D)E", "x  y": "X  Y", "o'neil": "O'neil"}


def test_retention_pct_matches_pandas_round(spark):
    pairs = [(1, 800), (1, 3), (2, 3), (7, 9), (1, 8), (5, 16), (0, 5), (3, 0), (33, 97), (1, 7)]
    df = spark.createDataFrame(pairs, "u long, s long").select("u", "s", X.retention_pct("u", "s").alias("p"))
    got = {(r.u, r.s): r.p for r in df.collect()}
    for u, s in pairs:
        if s == 0:
            assert got[(u, s)] is None
            continue
        expected = float((pd.Series([u]) / pd.Series([s]) * 100).round(2)[0])
        assert got[(u, s)] == expected, (u, s, got[(u, s)], expected)
    assert got[(1, 800)] == 0.12  # half-to-even on 0.125
    assert np.isclose(got[(1, 3)], 33.33)


def test_month_helpers(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31), dt.date(2024, 1, 1))], "a date, b date")
    r = df.select(X.month_of("a").alias("m"), (X.month_index("b") - X.month_index("a")).alias("off")).first()
    assert r.m == dt.date(2023, 12, 1) and r.off == 1
