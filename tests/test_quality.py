"""Each check kind reports a seeded bad row; the gate stops on failure."""

import datetime as dt

import pytest

from cohortkit.operators import quality as Q


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, "a", 3.0, dt.date(2020, 1, 1), "Positive"),
         (2, "b", 9.0, dt.date(1999, 1, 1), "Angry"),
         (2, None, None, None, "Angry"),
         (3, "c", 1.0, dt.date(2030, 1, 1), None)],
        "k int, name string, stars double, d date, sentiment string")


def _one(res):
    rows = res.collect()
    assert len(rows) == 1
    return rows[0]


def test_not_null(df):
    r = _one(Q.dq_not_null(df, "m", ["name"]))
    assert (r.failing_rows, r.passed) == (1, False)


def test_unique(df):
    assert _one(Q.dq_unique(df, "m", ["k"])).failing_rows == 1
    assert _one(Q.dq_unique(df, "m", ["name"])).passed


def test_accepted_values_counts_distinct_bad_values(df):
    r = _one(Q.dq_accepted_values(df, "m", "sentiment", ["Positive", "Neutral", "Negative"]))
    assert r.failing_rows == 1 and not r.passed


def test_between_numbers_and_dates(df):
    assert _one(Q.dq_between(df, "m", "stars", 1, 5)).failing_rows == 1
    assert _one(Q.dq_between(df, "m", "d", dt.date(2000, 1, 1), dt.date(2030, 1, 1))).failing_rows == 1


def test_row_count(df):
    assert _one(Q.dq_row_count(df, "m", 0, 3)).failing_rows == 1
    assert _one(Q.dq_row_count(df, "m", 0, 10)).passed


def test_columns(df):
    assert _one(Q.dq_columns(df, "m", ["k", "name", "stars", "d", "sentiment"])).passed
    assert not _one(Q.dq_columns(df, "m", ["name", "k", "stars", "d", "sentiment"])).passed


def test_suite_has_35_checks():
    assert len(Q.SUITE) == 35
    assert {m: sum(c.model == m for c in Q.SUITE) for m in ("stg_launches", "stg_reviews", "stg_users")} == {
        "stg_launches": 9, "stg_reviews": 15, "stg_users": 11}


def test_gate(spark, df):
    report = Q.run_checks(df, [Q.Check("m", "not_null", "k"), Q.Check("m", "unique", "k")])
    with pytest.raises(Q.QualityGateError):
        Q.gate(report)
    Q.gate(Q.run_checks(df, [Q.Check("m", "not_null", "k")]))


def test_relationships(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z"), (5, "z")], "k int, u string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "u string")
    r = _one(Q.dq_relationships(child, "c", "u", parent, "p", "u"))
    assert (r.failing_rows, r.passed) == (2, False)
