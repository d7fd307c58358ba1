"""Scale properties of the physical plans (guards against silent regressions)."""

import contextlib
import io
import os

import pytest

import sys

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))
from plan_notes import summarise  # noqa: E402

SF = "/root/testdata/sf0.01"


def plan(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("driver test tables not present")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()[name](spark, SF).explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["m3_daily_summary", "m4_weekly_trends", "m5_city_comparisons",
                                  "m6_temperature_anomalies", "m7_extreme_weather"])
def test_marts_broadcast_dimension_and_never_sort_merge(spark, name):
    p = plan(spark, name)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double" in p
    assert "event_type" not in p.split("ReadSchema")[1].split("\n")[0]  # column pruning


@pytest.mark.parametrize("name,shuffles", [("m3_daily_summary", 2), ("m5_city_comparisons", 1)])
def test_aggregates_are_two_phase(spark, name, shuffles):
    p = plan(spark, name)
    s = summarise(p)
    assert "partial_" in p and s["shuffles"] == shuffles and s["smj"] == 0


@pytest.mark.parametrize("name", ["m3_daily_summary", "m6_temperature_anomalies", "a16_robust_stats"])
def test_readings_are_hash_aggregated(spark, name):
    assert "ObjectHashAggregate" not in plan(spark, name)


def scans(p):
    """(location, partition filters, pushed filters) of the file scans of a formatted plan."""
    out = []
    for part in p.split("\n\n"):
        if "Location:" in part:
            lines = {x.split(":", 1)[0]: x.split(":", 1)[1] for x in part.split("\n") if ":" in x}
            out.append((lines["Location"], lines.get("PartitionFilters", ""), lines.get("PushedFilters", "")))
    return out


@pytest.mark.parametrize("name, table", [("a15_raw_baseline", "moments"), ("a16_robust_stats", "temperatures")])
def test_baselines_merge_the_daily_state_and_read_no_readings(spark, name, table):
    found = scans(plan(spark, name))
    state = [s for s in found if "/state/" in s[0]]
    assert len(state) == 1 and f"/state/{table}" in state[0][0] and "reading_date" in state[0][1]
    assert not [s for s in found if "events" in s[0]]


def test_anomalies_scan_the_readings_once(spark):
    found = scans(plan(spark, "m6_temperature_anomalies"))
    assert len([s for s in found if "events" in s[0]]) == 1 and len([s for s in found if "/state/" in s[0]]) == 1


def test_a_window_within_a_day_reads_that_day(spark):
    found = [s for s in scans(plan(spark, "a15_raw_baseline_midday")) if "events" in s[0]]
    assert found and all("GreaterThanOrEqual(ts,2024-01-10T13:37)" in s[2] and "LessThan(ts,2024-01-11T00:00)" in s[2]
                         for s in found)


def test_recency_predicates_reach_parquet(spark):
    assert "GreaterThan(reading_at,2024-01-29T12:00)" in plan(spark, "d09_anomalies_24h")
    assert "GreaterThan(ts,2024-01-30T10:00)" in plan(spark, "q04_dq_report")


@pytest.mark.parametrize("name", ["d01_city_map", "d13_top_anomalies", "d16_city_series", "q07_column_tests",
                                  "q08_mart_invariants"])
def test_panels_and_tests_read_stored_marts(spark, name):
    p = plan(spark, name)
    assert "Scan ExistingRDD" not in p and "/marts/" in p


@pytest.mark.parametrize("name", ["d09_anomalies_24h", "d10_max_abs_z", "d11_extremes_24h", "d12_cities_flagged"])
def test_panels_of_a_day_list_two_days(spark, name):
    (where, days, _), = scans(plan(spark, name))
    assert "temperature_anomalies" in where and "reading_date" in days and "2024-01-29" in days
    from stratus.plans import catalog
    mart = catalog.built(spark, SF, "m6")
    recent = mart.where("reading_date >= date'2024-01-29'").selectExpr("input_file_name() f").distinct().count()
    whole = mart.selectExpr("input_file_name() f").distinct().count()
    assert recent <= 2 < whole


@pytest.mark.parametrize("name", ["d16_city_series", "d17_city_rain", "d18_city_condition", "d19_city_humidity",
                                  "d20_city_temp", "d21_city_wind"])
def test_panels_of_a_city_open_one_bucket_a_month(spark, name):
    (where, buckets, _), = scans(plan(spark, name))
    assert "daily_summary" in where and "city_bucket" in buckets
    from stratus.plans import catalog, panels
    mart = catalog.built(spark, SF, "m3")
    own = panels._city(mart, "NATION_7").selectExpr("input_file_name() f", "month").distinct()
    assert own.count() == own.select("month").distinct().count()


def test_stored_marts_follow_rewritten_tables(spark, tmp_path):
    """D1-D22, Q7 and Q8 read what the tables hold now, also under a path that was read before."""
    import shutil
    from pyspark.sql import functions as F
    for t in ("events", "nation", "region"):
        shutil.copy(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    at = f"file:{tmp_path}"

    def answers():
        return {n: sorted(map(str, E.queries()[n](spark, at).collect()))
                for n in ("d01_city_map", "d09_anomalies_24h", "d16_city_series", "q08_mart_invariants")}

    first = answers()
    assert answers() == first
    warmer = spark.read.parquet(f"{SF}/events.parquet").withColumn("value", F.col("value") + 1).toPandas()
    os.remove(tmp_path / "events.parquet")
    warmer.to_parquet(tmp_path / "events.parquet", coerce_timestamps="us")
    spark.catalog.refreshByPath(at)
    second = answers()
    assert second["d01_city_map"] != first["d01_city_map"] and second["d16_city_series"] != first["d16_city_series"]


def test_recency_prunes_the_partitions_of_a_written_table(spark):
    from datetime import datetime, timedelta
    from stratus import schemas as S
    from stratus.operators import quality, sinks
    from stratus.plans import marts, panels, staging
    from stratus.session import scratch_dir
    from stratus.streaming import jobs
    t0 = datetime(2024, 1, 1)
    rows = [(1, t0 + timedelta(hours=h), None, None, None, None, None, None, t0, h) for h in range(24 * 40)]
    updates = spark.createDataFrame(rows, "city_id int, timestamp timestamp, temperature decimal(5,2), "
                                    "feels_like decimal(5,2), precipitation decimal(6,2), windspeed decimal(5,2), "
                                    "humidity smallint, weather_code smallint, run_ts timestamp, pos int")
    path = scratch_dir(spark, "t-pruned")
    sinks.upsert(spark, path, updates)
    table, as_of = spark.read.parquet(path), t0 + timedelta(days=39, hours=12)
    for df in (panels.active_cities(table, as_of), quality.dq_report(table, as_of), quality.freshness(table, as_of),
               quality.check_nulls(table, as_of), jobs.raw_baseline(table, as_of),
               marts.robust_stats(staging.stg_readings(table), as_of)):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        filters = [x for x in buf.getvalue().split("\n") if "PartitionFilters" in x]
        assert filters and all("reading_date" in x and ">=" in x for x in filters)
    assert panels.active_cities(table, as_of).first()[0] == 1
    assert len({r.f for r in table.selectExpr("input_file_name() f").distinct().collect()}) <= 45


def test_top_k_is_take_ordered(spark):
    p = plan(spark, "d13_top_anomalies")
    assert "TakeOrderedAndProject" in p and "SortMergeJoin" not in p
