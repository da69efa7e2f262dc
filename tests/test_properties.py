"""Property tests: the operators against brute force in plain Python on
small random inputs (hypothesis)."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import keep_best, tie_breakers
from tallyhouse.operators.profile import duplicates, orphans

KEYS = st.sampled_from([None, "", "a", " a", "b", "c"])
VALS = st.one_of(st.none(), st.sampled_from(["x", "y", "z", "", "Y"]))
NUMS = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))
ROWS = st.lists(st.tuples(KEYS, NUMS, VALS, VALS), min_size=0, max_size=25)

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def _nulls_last_asc(v):
    return (v is None, v if v is not None else "")


@SETTINGS
@given(rows=ROWS)
def test_keep_best_matches_sorting(spark, rows):
    df = spark.createDataFrame(rows, "k string, n int, a string, b string")
    got = keep_best(df, "k", [F.col("n").desc_nulls_last(), *tie_breakers(["a", "b"])]).collect()
    expected = {}
    for k, n, a, b in rows:
        rank = ((n is None, -(n or 0)), _nulls_last_asc(a), _nulls_last_asc(b))
        if k not in expected or rank < expected[k][0]:
            expected[k] = (rank, (k, n, a, b))
    assert sorted(map(tuple, got), key=repr) == sorted((v for _, v in expected.values()), key=repr)


@SETTINGS
@given(rows=st.lists(KEYS, max_size=30), other=st.lists(KEYS, max_size=10))
def test_duplicates_and_orphans_match_counting(spark, rows, other):
    left = spark.createDataFrame([(k,) for k in rows], "k string")
    right = spark.createDataFrame([(k,) for k in other], "k string")
    counts = Counter(k for k in rows if k is not None)
    assert duplicates(left, "k").first()[0] == sum(c for c in counts.values() if c > 1)
    present = {k for k in other if k is not None}
    assert orphans(left, right, "k").first()[0] == sum(c for k, c in counts.items() if k not in present)


@SETTINGS
@given(rows=st.lists(st.tuples(KEYS, KEYS), max_size=30), ua=st.lists(KEYS, max_size=8), pa=st.lists(KEYS, max_size=8))
def test_key_report_matches_single_key_counting(spark, rows, ua, pa):
    from tallyhouse.operators.profile import key_report
    left = spark.createDataFrame(rows, "u string, p string")
    users = spark.createDataFrame([(k,) for k in ua], "u string")
    products = spark.createDataFrame([(k,) for k in pa], "p string")
    got = key_report(left, {"u": (users, "fk_u"), "p": (products, "fk_p")}, {"u": "twice_u"}).first().asDict()
    present_u = {k for k in ua if k is not None}
    present_p = {k for k in pa if k is not None}
    assert got == {"fk_u": sum(1 for u, _ in rows if u is not None and u not in present_u),
                   "fk_p": sum(1 for _, p in rows if p is not None and p not in present_p),
                   "twice_u": sum(1 for u, _ in rows if u is not None and [r[0] for r in rows].count(u) > 1)}
