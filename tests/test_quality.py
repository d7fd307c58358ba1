"""Data-quality checks and monitors."""

from datetime import datetime, timedelta

import pytest

from conftest import D
from stratus import schemas as S
from stratus.operators import quality

AS_OF = datetime(2024, 1, 30, 12)


def readings(spark, rows):
    return spark.createDataFrame(
        [(c, ts, D(t), None, None, None, None, None) for c, ts, t in rows], S.READINGS)


def test_dq_report_counts_and_does_not_raise(spark):
    recent = AS_OF - timedelta(minutes=30)
    rows = ([(i, recent, 15.0) for i in range(44)] + [(44, recent, None), (45, recent, 22.5),
            (46, recent, 61.0), (47, AS_OF - timedelta(hours=2), None),
            (48, AS_OF + timedelta(hours=3), 20.0)])          # future rows count
    rep = {r.check_name: (r.observed, r.passed, r.message)
           for r in quality.dq_report(readings(spark, rows), AS_OF).collect()}
    assert rep["coverage"] == (48, True, None)
    assert rep["null_temperatures"][:2] == (1, False)
    assert rep["extreme_values"][:2] == (1, False)


def test_coverage_threshold(spark):
    recent = AS_OF - timedelta(minutes=5)
    for n, ok in [(50, True), (45, True), (44, False), (0, False)]:
        rows = [(i, recent, 10.0) for i in range(n)] or [(1, AS_OF - timedelta(days=1), 10.0)]
        got = quality.check_coverage(readings(spark, rows), AS_OF).first()
        assert got.passed is ok


def test_freshness_raises_without_recent_rows(spark):
    stale = readings(spark, [(1, AS_OF - timedelta(minutes=11), 1.0)])
    with pytest.raises(ValueError):
        quality.check_freshness(stale, AS_OF)
    fresh = readings(spark, [(1, AS_OF - timedelta(minutes=9), 1.0),
                             (2, AS_OF - timedelta(minutes=1), 1.0)])
    got = quality.check_freshness(fresh, AS_OF)
    assert got["recent_count"] == 2 and got["city_count"] == 2


def test_column_tests_and_key_checks(spark):
    df = spark.createDataFrame([(1, "Rain"), (1, "Hail"), (None, None)], "id int, c string")
    out = {(r.column_name, r.test): r.failures for r in quality.column_tests(
        "m", df, [("id", "not_null", None), ("id", "unique", None),
                  ("c", "accepted", ["Rain"])]).collect()}
    assert out == {("id", "not_null"): 1, ("id", "unique"): 1, ("c", "accepted"): 1}
    r = readings(spark, [(1, AS_OF, 1.0), (1, AS_OF, 2.0), (9, AS_OF, 1.0)])
    cities = spark.createDataFrame([(1,)], "id int")
    runs = spark.createDataFrame([(1, "bogus"), (1, "success")], "id int, status string")
    got = dict((x.check_name, x.violations) for x in quality.key_checks(r, cities, runs).collect())
    assert got == {"readings_duplicate_keys": 1, "readings_orphan_city": 1,
                   "runs_bad_status": 1, "runs_duplicate_id": 1}


def test_single_checks_match_report(spark):
    recent = AS_OF - timedelta(minutes=30)
    r = readings(spark, [(1, recent, None), (2, recent, 95.0), (3, recent, 20.0)])
    n = quality.check_nulls(r, AS_OF).first()
    x = quality.check_range(r, AS_OF).first()
    assert (n.observed, n.passed) == (1, False) and n.message.startswith("NULL TEMPERATURES: 1")
    assert (x.observed, x.passed) == (1, False) and x.message.startswith("EXTREME VALUES: 1")


def test_coverage_passes_and_names_its_window(spark):
    r = readings(spark, [(c, AS_OF - timedelta(minutes=30), 20.0) for c in range(45)])
    row = quality.check_coverage(r, AS_OF).first()
    assert (row.observed, row.passed, row.message) == (45, True, None)
    low = quality.check_coverage(r, AS_OF, 46, "3 hours").first()
    assert low.message == "LOW COVERAGE: only 45/50 cities in last 3 hours"
    assert [x.passed for x in quality.dq_report(r, AS_OF).collect()] == [True, True, True]
