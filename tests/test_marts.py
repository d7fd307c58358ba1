"""Marts on hand-built inputs: rolling window, baselines, NULL paths, grouping."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from conftest import D
from stratus.plans import marts, staging
from stratus import schemas as S

AS_OF = datetime(2024, 2, 10)


def cities(spark, rows=None):
    rows = rows or [(1, "Alpha", "A", "AA", "Europe", D("1.0"), D("2.0"), "UTC", None),
                    (2, "Beta", "B", "BB", "Asia", D("3.0"), D("4.0"), "UTC", None),
                    (3, "Gamma", "C", "CC", "Middle East", D("5.0"), D("6.0"), "UTC", None)]
    return staging.stg_cities(spark.createDataFrame(rows, S.CITIES))


def readings(spark, rows):
    return spark.createDataFrame(
        [(c, ts, D(t), D(t), D(p), D(w), h, code) for c, ts, t, p, w, h, code in rows],
        S.READINGS)


def test_rolling_seven_rows_with_gap(spark):
    day0 = datetime(2024, 1, 1, 12)
    days = [0, 1, 2, 3, 4, 5, 6, 10, 11, 12]  # a 3-day gap after day 6
    rows = [(1, day0 + timedelta(days=d), float(d), 0, 0, 50, 0) for d in days]
    rows.append((2, day0, 5.0, 0, 0, 50, 0))  # one-day history
    stg = staging.stg_readings(readings(spark, rows))
    out = {(r.city_id, r.day.day): float(r.temp_7day_rolling_avg)
           for r in marts.weekly_trends(stg, cities(spark)).collect()}
    assert out[(1, 1)] == 0.0 and out[(1, 7)] == 3.0
    # day 11 (index 7) averages days 1..6 and 10 (rows, not days)
    assert out[(1, 11)] == round((1 + 2 + 3 + 4 + 5 + 6 + 10) / 7, 2)
    assert out[(2, 1)] == 5.0


def test_daily_summary_groups_and_mode(spark):
    ts = datetime(2024, 1, 5, 1)
    rows = [(1, ts, 1.23, 1, 5, 50, 61), (1, ts + timedelta(hours=1), 1.24, 2, 5, 51, 61),
            (1, ts + timedelta(hours=2), None, None, 5, 52, 45),
            (1, ts + timedelta(hours=3), 2.0, 0, 5, 53, 45),
            (1, ts + timedelta(hours=4), 70.0, 0, 5, 53, 95)]   # suspicious -> dropped
    stg = staging.stg_readings(readings(spark, rows))
    r = marts.daily_summary(stg, cities(spark)).collect()
    assert len(r) == 1
    r = r[0]
    assert r.reading_count == 4 and r.avg_temp_c == D("1.49") and r.min_temp_c == D("1.23")
    assert r.total_precip_mm == D("3.00") and r.avg_humidity_pct == D("51.5")
    assert r.dominant_condition == "Fog" and r.region == "EMEA"


def _baseline_rows(city, n, start, temps):
    return [(city, start + timedelta(hours=i), temps[i % len(temps)], 0, 0, 50, 0)
            for i in range(n)]


def test_anomalies_min_samples_constant_city_and_old_readings(spark):
    start = datetime(2024, 1, 20)
    rows = (_baseline_rows(1, 24, start, [10.0, 12.0, 14.0])      # 24 rows: scored
            + _baseline_rows(2, 23, start, [10.0, 20.0])          # 23 rows: no baseline
            + _baseline_rows(3, 30, start, [7.5])                 # constant: z NULL
            + [(1, datetime(2023, 6, 1), 40.0, 0, 0, 50, 0)])     # older than the window
    stg = staging.stg_readings(readings(spark, rows))
    out = marts.temperature_anomalies(stg, cities(spark), AS_OF).collect()
    by_city = {}
    for r in out:
        by_city.setdefault(r.city_id, []).append(r)
    assert set(by_city) == {1, 3}
    assert len(by_city[1]) == 25            # old reading scored against the fixed baseline
    old = [r for r in by_city[1] if r.reading_at.year == 2023][0]
    assert old.is_anomaly is True and old.anomaly_severity == "extreme"
    assert by_city[1][0].sample_size == 24
    for r in by_city[3]:
        assert r.z_score is None and r.is_anomaly is None and r.anomaly_severity == "normal"
        assert r.robust_z_score is None


def test_iqr_zero_with_positive_stddev(spark):
    start = datetime(2024, 1, 20)
    temps = [10.0] * 22 + [30.0, -10.0]
    rows = _baseline_rows(1, 24, start, temps)
    stg = staging.stg_readings(readings(spark, rows))
    out = marts.temperature_anomalies(stg, cities(spark), AS_OF).collect()
    assert all(r.robust_z_score is None for r in out)
    assert any(r.z_score is not None for r in out)


def test_extreme_weather_labels(spark):
    ts = datetime(2024, 1, 5)
    rows = [(1, ts, 36.0, 0, 0, 50, 95), (1, ts + timedelta(hours=1), 36.0, 0, 70, 50, 0),
            (1, ts + timedelta(hours=2), 35.0, 10, 60, 50, 0)]
    stg = staging.stg_readings(readings(spark, rows))
    out = sorted((r.reading_at, r.event_type) for r in
                 marts.extreme_weather(stg, cities(spark)).collect())
    assert [e for _, e in out] == ["Thunderstorm", "Heatwave"]


def test_staging_drops_null_keys_and_suspicious(spark):
    ts = datetime(2024, 1, 5)
    rows = [(1, ts, 10.0, 0, -1, 50, 0), (1, ts + timedelta(hours=1), None, -2, 0, 150, 0),
            (1, ts + timedelta(hours=2), None, 0, 0, None, 42)]
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in S.READINGS])
    df = readings(spark, rows).union(
        spark.createDataFrame([(None, ts, None, None, None, None, None, None)], nullable))
    out = staging.stg_readings(df).orderBy("reading_at").collect()
    assert len(out) == 2
    assert out[0].windspeed_kmh is None and out[0].temperature_c == D("10.00")
    assert out[1].weather_condition == "Unknown" and out[1].temperature_c is None


def test_percentiles_interpolate_without_float_noise(spark):
    vals = ["-26.79", "-26.78", "-26.78", "-26.79", "-26.77", "14.22", "14.23"]
    stg = spark.createDataFrame([(1, datetime(2024, 1, 1), D(v)) for v in vals] + [(2, datetime(2024, 1, 1), D("1.00"))],
                                "city_id int, reading_at timestamp_ntz, temperature_c decimal(5,2)")
    got = {r.city_id: r for r in marts.robust_stats(stg, datetime(2024, 1, 2), min_samples=1).collect()}
    assert (got[1].p25, got[1].p75) == (-26.785, -6.275)     # positions 1.5 and 4.5 of 7 sorted values
    assert (got[2].p25, got[2].p75, got[2].mean_temp, got[2].stddev_temp) == (1.0, 1.0, 1.0, None)
    # by hand: sum -105.46 of 7; squares about the mean
    mean = -105.46 / 7
    var = sum((float(v) - mean) ** 2 for v in vals) / 6
    assert abs(got[1].mean_temp - mean) < 1e-12 and abs(got[1].stddev_temp - var ** 0.5) < 1e-9


@pytest.mark.parametrize("values,expected", [
    (["0.01", "0.06"], "0.04"),                  # 0.035 rounds away from zero
    (["-0.01", "-0.06"], "-0.04"), (["1.00", "1.01"], "1.01"), (["2.00", "2.00", "2.01"], "2.00")])
def test_rolling_mean_is_decimal(spark, values, expected):
    rows = [(1, datetime(2024, 1, 1 + i), D(v)) for i, v in enumerate(values)]
    stg = spark.createDataFrame(rows, "city_id int, reading_at timestamp_ntz, temperature_c decimal(5,2)")
    last = marts.weekly_trends(stg, cities(spark)).orderBy("day").collect()[-1]
    assert str(last.temp_7day_rolling_avg) == expected


def test_rolling_mean_averages_unrounded_days(spark):
    # day 1: 0.01, 0.02, 0.02 -> 0.01666..; day 2: 0.02 -> mean 0.018333.. -> 0.02
    rows = [(1, datetime(2024, 1, 1, h), D(v)) for h, v in enumerate(["0.01", "0.02", "0.02"])]
    rows += [(1, datetime(2024, 1, 2), D("0.02")), (1, datetime(2024, 1, 20), D("0.00"))]
    stg = spark.createDataFrame(rows, "city_id int, reading_at timestamp_ntz, temperature_c decimal(5,2)")
    got = [str(r.temp_7day_rolling_avg) for r in marts.weekly_trends(stg, cities(spark)).orderBy("day").collect()]
    assert got == ["0.02", "0.02", "0.01"]       # the third: 0.03666.. / 3, seven rows not seven days


def test_dominant_condition_ties_take_the_first_label(spark):
    ts = datetime(2024, 1, 5)
    rows = [(1, ts + timedelta(hours=h), 1.0, 0, 0, 50, code) for h, code in enumerate([61, 61, 0, 0, 95])]
    out = marts.daily_summary(staging.stg_readings(readings(spark, rows)), cities(spark)).first()
    assert (out.dominant_condition, out.reading_count) == ("Clear sky", 5)


def _ordered(spark):
    ts = datetime(2024, 1, 5)
    rows = [(c, ts + timedelta(days=d, hours=h), t, 0, 70, 50, 0)
            for c in (1, 2) for d in range(3) for h, t in enumerate([1.0 + c, None if c == 2 else 5.0])]
    return staging.stg_readings(readings(spark, rows)), spark.createDataFrame(
        [(1, "B", "X", "Europe", "EMEA", D("1"), D("1")), (2, "A", "X", "Europe", "EMEA", D("2"), D("2"))],
        "id int, name string, country string, continent string, region string, latitude decimal(8,5), "
        "longitude decimal(8,5)")


def test_mart_orders(spark):
    stg, dim = _ordered(spark)
    daily = [(r.date.day, r.city_name) for r in marts.daily_summary(stg, dim, ordered=True).collect()]
    assert daily == [(7, "A"), (7, "B"), (6, "A"), (6, "B"), (5, "A"), (5, "B")]
    weekly = [(r.city_name, r.day.day) for r in marts.weekly_trends(stg, dim, ordered=True).collect()]
    assert weekly == [("A", 7), ("A", 6), ("A", 5), ("B", 7), ("B", 6), ("B", 5)]
    assert [r.city_name for r in marts.city_comparisons(stg, dim, ordered=True).collect()] == ["B", "A"]
    z = [r.z_score for r in marts.temperature_anomalies(stg.union(stg).union(stg).union(stg).union(stg).union(stg)
                                                        .union(stg).union(stg).union(stg), dim,
                                                        datetime(2024, 1, 8), ordered=True).collect()]
    known = [abs(x) for x in z if x is not None]
    assert known and known == sorted(known, reverse=True) and all(x is None for x in z[len(known):])
    events = [r.reading_at for r in marts.extreme_weather(stg, dim, ordered=True).collect()]
    assert events == sorted(events, reverse=True) and len(events) == 12


def test_null_orders(spark):
    from stratus.operators import ordering
    df = spark.createDataFrame([(2,), (None,), (1,), (3,)], "x int")
    first = [r.x for r in df.orderBy(ordering.desc_nulls_first("x")).collect()]
    last = [r.x for r in df.orderBy(ordering.asc_nulls_last("x")).collect()]
    assert first == [None, 3, 2, 1] and last == [1, 2, 3, None]
