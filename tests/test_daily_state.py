"""The daily state equals the aggregates over the readings bit for bit, whatever the days touched."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import types as T

from conftest import D
from stratus import schemas as S
from stratus.operators import sinks
from stratus.operators.publish import _numbers, version
from stratus.plans import daily_state, marts, staging, warehouse
from stratus.session import scratch_dir
from stratus.streaming import jobs

START = datetime(2024, 1, 1)


def some_readings(rng, n, days=40, cities=4):
    seen, rows = set(), []
    while len(rows) < n:
        key = (rng.randrange(1, cities + 1), START + timedelta(minutes=rng.randrange(days * 1440)))
        if key in seen:
            continue
        seen.add(key)
        rows.append((*key, rng.choice([None, D("99.5"), *[D(round(rng.uniform(-30, 45), 2)) for _ in range(9)]]), None,
                     rng.choice([None, D("-1"), D("3.25")]), rng.choice([None, D("12.5"), D("70")]),
                     rng.choice([None, 40, 55, 140]), rng.choice([0, 3, 61, 95, 42])))
    return rows


def stored(spark, rows):
    path = scratch_dir(spark, "t-state-readings")
    load(spark, path, rows)
    return path


UPDATES = T.StructType([*S.READINGS.fields, T.StructField("run_ts", T.TimestampType()),
                        T.StructField("pos", T.IntegerType())])


def load(spark, path, rows, run=0):
    return sinks.upsert(spark, path, spark.createDataFrame(
        [(*r, START + timedelta(hours=run), i) for i, r in enumerate(rows)], UPDATES))


def cities(spark):
    return staging.stg_cities(spark.createDataFrame(
        [(i, "Same" if i < 3 else f"City {i}", "C", "CC", "Asia", D("1"), D("2"), "UTC", None) for i in range(1, 5)],
        S.CITIES))


def same(a, b):
    return sorted(map(repr, a.select(sorted(a.columns)).collect())) == sorted(
        map(repr, b.select(sorted(b.columns)).collect()))


def all_equal(spark, table, base, dims, as_of):
    raw = spark.read.parquet(table)
    stg, state = staging.stg_readings(raw), warehouse.state(spark, base)
    assert same(daily_state.raw_baseline(state, as_of, readings=raw), jobs.raw_baseline(raw, as_of))
    assert same(marts.robust_stats_of(daily_state.staged_counts(state, as_of, raw)), marts.robust_stats(stg, as_of))
    extra = {"daily_summary": [warehouse.MONTH, "city_bucket"], "temperature_anomalies": ["reading_date"],
             "extreme_weather": ["reading_date"]}
    for name in warehouse.MARTS:
        model = getattr(marts, name)
        full = model(stg, dims, as_of) if name == "temperature_anomalies" else model(stg, dims)
        assert same(warehouse.mart(spark, base, name).drop(*extra.get(name, [])), full), name


def test_rebuild_by_touched_days_equals_the_full_build(spark):
    rng = random.Random(3)
    rows, dims, as_of = some_readings(rng, 700), cities(spark), START + timedelta(days=35, hours=7, minutes=20)
    table, base = stored(spark, rows), scratch_dir(spark, "t-state-base")
    warehouse.refresh(spark, base, spark.read.parquet(table), dims, as_of)
    all_equal(spark, table, base, dims, as_of)
    before = {n: version(spark, warehouse.mart_path(base, n)).folders for n in ("daily_summary", "extreme_weather")}
    state_before = version(spark, f"{warehouse.state_path(base)}/moments").folders
    reader = warehouse.mart(spark, base, "temperature_anomalies")
    rows_then = reader.count()
    # a later load changes one day and adds one; all readings of that day turn suspicious for one city
    changed = [(r[0], r[1], D("99.9") if r[0] == 4 else D("1.11"), *r[3:]) for r in rows if r[1].date() == date(2024, 1, 9)]
    added = [(2, datetime(2024, 2, 20, 5), D("50.5"), None, D("0"), D("0"), 50, 95)]
    touched = load(spark, table, changed + added, run=1)
    assert touched == [date(2024, 1, 9), date(2024, 2, 20)]
    for _ in range(2):                                       # a repeated refresh changes nothing
        warehouse.refresh(spark, base, spark.read.parquet(table), dims, as_of, touched)
        all_equal(spark, table, base, dims, as_of)
    # a reader that began before the rebuilds still has its files, until there have been enough of them
    assert reader.count() == rows_then
    warehouse.refresh(spark, base, spark.read.parquet(table), dims, as_of, touched, keep=1)
    assert len(_numbers(spark, warehouse.mart_path(base, "daily_summary"))) == 1
    all_equal(spark, table, base, dims, as_of)
    months = version(spark, f"{warehouse.state_path(base)}/months").folders
    assert set(months) == {"month=2024-01", "month=2024-02"}
    assert same(marts.city_comparisons_of(warehouse.state(spark, base)["conditions"], dims),
                marts.city_comparisons_of(warehouse.state(spark, base)["months"], dims))
    state_after = version(spark, f"{warehouse.state_path(base)}/moments").folders
    assert {k for k in state_after if state_after[k] != state_before.get(k)} == {
        "reading_date=2024-01-09", "reading_date=2024-02-20"}
    events = version(spark, warehouse.mart_path(base, "extreme_weather")).folders
    assert {k for k in events if events[k] != before["extreme_weather"].get(k)} <= {
        "reading_date=2024-01-09", "reading_date=2024-02-20"}
    summary = version(spark, warehouse.mart_path(base, "daily_summary")).folders
    assert set(summary) == {"month=2024-01", "month=2024-02"}


def test_a_changed_dimension_rebuilds_every_day(spark):
    """A city is renamed: a load that touches one day leaves no row with the old name."""
    rows, dims, as_of = some_readings(random.Random(6), 200, days=70), cities(spark), START + timedelta(days=60)
    table, base = stored(spark, rows), scratch_dir(spark, "t-state-dims")
    warehouse.refresh(spark, base, spark.read.parquet(table), dims, as_of)
    renamed = dims.replace({"City 3": "Renamed"}, subset=["name"])
    touched = load(spark, table, [(3, START + timedelta(days=2, hours=5), D("40"), None, None, None, None, 0)], run=1)
    warehouse.refresh(spark, base, spark.read.parquet(table), renamed, as_of, touched)
    all_equal(spark, table, base, renamed, as_of)
    assert "Renamed" in {r.city_name for r in warehouse.mart(spark, base, "daily_summary").collect()}


def test_only_the_days_of_a_window_are_listed(spark):
    root = scratch_dir(spark, "t-state-listed")
    daily_state.refresh(spark, spark.createDataFrame(some_readings(random.Random(7), 400, days=90), S.READINGS), root)
    as_of = START + timedelta(days=80)
    near = daily_state.read_state(spark, root, daily_state.window_start(as_of))
    whole = daily_state.read_state(spark, root)
    days = {f.split("reading_date=")[1][:10] for f in near["moments"].inputFiles()}
    assert min(days) >= "2024-02-20" and len(days) <= 41 < len(whole["moments"].inputFiles())
    assert same(daily_state.raw_baseline(near, as_of), daily_state.raw_baseline(whole, as_of))
    some = daily_state.read_state(spark, root, date(2024, 1, 5), date(2024, 1, 7))["conditions"]
    assert {r.reading_date for r in some.collect()} <= {date(2024, 1, d) for d in (5, 6, 7)}


@pytest.mark.parametrize("as_of", [START + timedelta(days=30), START + timedelta(days=33, hours=1, seconds=1),
                                   START + timedelta(days=400), START - timedelta(days=3)])
def test_any_window(spark, as_of):
    rng = random.Random(4)
    raw = spark.createDataFrame(some_readings(rng, 300), S.READINGS)
    root = scratch_dir(spark, "t-state-window")
    daily_state.refresh(spark, raw, root)
    state = daily_state.read_state(spark, root)
    assert same(daily_state.raw_baseline(state, as_of, readings=raw), jobs.raw_baseline(raw, as_of))
    assert same(marts.robust_stats_of(daily_state.staged_counts(state, as_of, raw)),
                marts.robust_stats(staging.stg_readings(raw), as_of))


def test_a_window_within_a_day_needs_its_readings(spark):
    root = scratch_dir(spark, "t-state-partial")
    daily_state.refresh(spark, spark.createDataFrame(some_readings(random.Random(5), 30), S.READINGS), root)
    with pytest.raises(ValueError):
        daily_state.raw_baseline(daily_state.read_state(spark, root), START + timedelta(days=31, hours=1))


def test_empty_readings(spark):
    base, dims = scratch_dir(spark, "t-state-empty"), cities(spark)
    empty = spark.createDataFrame([], S.READINGS)
    warehouse.refresh(spark, base, empty, dims, START)
    assert all(warehouse.mart(spark, base, n).count() == 0 for n in warehouse.MARTS)
    assert daily_state.raw_baseline(warehouse.state(spark, base), START).count() == 0
