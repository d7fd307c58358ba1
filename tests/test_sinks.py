"""Upsert (last write wins) and insert-if-absent (first write wins) on Parquet tables."""

from datetime import datetime


from conftest import D
from stratus.operators import sinks
from stratus.session import scratch_dir

TS = datetime(2024, 1, 5, 1)


def updates(spark, rows):
    return spark.createDataFrame(
        [(c, ts, D(t), None, None, None, None, None, run, pos) for c, ts, t, run, pos in rows],
        "city_id int, timestamp timestamp, temperature decimal(5,2), feels_like decimal(5,2), "
        "precipitation decimal(6,2), windspeed decimal(5,2), humidity smallint, "
        "weather_code smallint, run_ts timestamp, pos int")


def table(spark, path):
    return sorted((r.city_id, r.timestamp, r.temperature)
                  for r in spark.read.parquet(path).collect())


def test_upsert_last_write_wins_and_idempotent(spark):
    path = scratch_dir(spark, "t-upsert")
    r1, r2 = datetime(2024, 1, 5), datetime(2024, 1, 5, 1)
    sinks.upsert(spark, path, updates(spark, [(1, TS, 1.0, r1, 0), (2, TS, 2.0, r1, 0)]))
    batch = updates(spark, [(1, TS, 5.0, r1, 0), (1, TS, 6.0, r2, 0), (3, TS, 3.0, r2, 1)])
    sinks.upsert(spark, path, batch)
    once = table(spark, path)
    assert once == [(1, TS, D("6.00")), (2, TS, D("2.00")), (3, TS, D("3.00"))]
    sinks.upsert(spark, path, batch)
    assert table(spark, path) == once


def test_insert_absent_first_write_wins_and_replay(spark):
    path = scratch_dir(spark, "t-insert")
    b1 = spark.createDataFrame([(1, TS, D(1), None, None, 0, 5), (1, TS, D(9), None, None, 0, 2)],
                               "city_id int, timestamp timestamp, temperature decimal(5,2), "
                               "windspeed decimal(5,2), weather_code smallint, partition int, "
                               "offset bigint")
    sinks.insert_absent(spark, path, b1, order=["partition", "offset"])
    assert table(spark, path) == [(1, TS, D("9.00"))]
    b2 = spark.createDataFrame([(1, TS, D(4), None, None, 0, 7), (2, TS, D(2), None, None, 1, 1)],
                               b1.schema)
    sinks.insert_absent(spark, path, b2, order=["partition", "offset"])
    sinks.insert_absent(spark, path, b2, order=["partition", "offset"])   # replay
    assert table(spark, path) == [(1, TS, D("9.00")), (2, TS, D("2.00"))]


def test_run_log_status(spark):
    path = scratch_dir(spark, "t-runs")
    sinks.log_run(spark, path, "a", 10, 0, datetime(2024, 1, 1))
    sinks.log_run(spark, path, "b", 10, 2)
    rows = sorted(tuple(r) for r in spark.read.parquet(path)
                  .select("id", "run_id", "rows_fetched", "rows_loaded", "status").collect())
    assert rows == [(1, "a", 10, 10, "success"), (2, "b", 12, 10, "partial")]


def test_ids_are_claimed_without_reading_the_log(spark):
    """Loads at the same time get distinct ids; a log from before there were claims goes on."""
    from concurrent.futures import ThreadPoolExecutor
    path = scratch_dir(spark, "t-claims")
    with ThreadPoolExecutor(8) as pool:
        ids = list(pool.map(lambda i: sinks.claim_id(spark, path, f"run-{i}"), range(24)))
    assert sorted(ids) == list(range(1, 25))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: sinks.log_run(spark, path, f"r{i}", i, 0), range(4)))
    rows = spark.read.parquet(path).collect()
    assert sorted(r.id for r in rows) == [25, 26, 27, 28] and {r.run_id for r in rows} == {"r0", "r1", "r2", "r3"}
    old = scratch_dir(spark, "t-old-log")
    spark.read.parquet(path).write.parquet(old)
    assert sinks.claim_id(spark, old, "next") == 29 and sinks.claim_id(spark, old, "then") == 30


def test_upsert_returns_the_touched_dates_and_keeps_the_others(spark):
    import os
    path = scratch_dir(spark, "t-touched")
    days = [datetime(2024, 1, d, 3) for d in (1, 2, 3)]
    assert sinks.upsert(spark, path, updates(spark, [(1, d, 1.0, TS, 0) for d in days])) == [d.date() for d in days]
    folder = f"{path.removeprefix('file:')}/reading_date="

    def files(d):
        return sorted(f for f in os.listdir(f"{folder}{d.date()}") if f.endswith(".parquet"))

    before = [files(d) for d in days]
    assert sinks.upsert(spark, path, updates(spark, [(1, days[1], 2.0, TS, 0), (2, days[1], None, TS, 1)])) == [
        days[1].date()]
    after = [files(d) for d in days]
    assert before[0] == after[0] and before[2] == after[2] and before[1] != after[1]
    assert table(spark, path) == [(1, days[0], D("1.00")), (1, days[1], D("2.00")), (1, days[2], D("1.00")),
                                  (2, days[1], None)]


def test_crowded_days_from_listings(spark):
    path = scratch_dir(spark, "t-crowded")
    days = [datetime(2024, 1, 1, 3), datetime(2024, 1, 2, 3)]
    for i in range(5):
        batch = updates(spark, [(i, days[0], 1.0, TS, 0)] + [(i, days[1], 1.0, TS, 0)] * (i < 2)).withColumnRenamed(
            "pos", "offset").drop("run_ts")
        sinks.insert_absent(spark, path, batch)
    dates = [d.date() for d in days] + [datetime(2030, 1, 1).date()]
    assert sinks.crowded(spark, path, dates, max_files=4) == [days[0].date()]
    assert sinks.crowded(spark, path, dates, max_files=4, small_bytes=10) == []
    before = table(spark, path)
    sinks.compact(spark, path, [days[0].date()])
    assert sinks.crowded(spark, path, dates, max_files=1) == [days[1].date()] and table(spark, path) == before


def test_upsert_removes_its_stage_and_sizes_files_by_date(spark):
    import os
    from stratus.session import ensure_checkpoint_dir
    path = scratch_dir(spark, "t-files")
    rows = [(c, datetime(2024, 1, 1 + d, h), 1.0, TS, 0) for c in range(20) for d in range(5) for h in range(24)]
    sinks.upsert(spark, path, updates(spark, rows).repartition(8))
    folder = path.removeprefix("file:")
    files = [f for d in os.listdir(folder) if d.startswith("reading_date=")
             for f in os.listdir(os.path.join(folder, d)) if f.endswith(".parquet")]
    assert len(files) <= 8
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert not [n for n in os.listdir(f"{base}/stratus") if n.startswith("updates-")]
    before = table(spark, path)
    sinks.compact(spark, path, [datetime(2024, 1, 2).date(), datetime(2030, 1, 1).date()])
    assert table(spark, path) == before


def test_views_and_declared_tables(spark, tmp_path):
    from stratus import schemas as S
    from stratus.sources import tables
    sinks.stage_view(spark.range(3), "staged_view")
    assert spark.table("staged_view").count() == 3
    with open(tmp_path / "cities.csv", "w") as f:
        f.write("id,name,country,country_code,continent,latitude,longitude,timezone,population\n"
                "2,São Paulo,Brazil,BR,South America,-23.55,-46.63,America/Sao_Paulo,12300000\n"
                "1,Oslo,Norway,NO,Europe,59.91,10.75,Europe/Oslo,\n")
    found = tables.read_cities(spark, f"file:{tmp_path}/cities.csv", "csv")
    assert found.schema["latitude"].dataType == S.CITIES["latitude"].dataType
    assert [(r.id, r.population) for r in tables.cities_in_order(found).collect()] == [(1, None), (2, 12300000)]
    assert tables.read_cities(spark, f"file:{tmp_path}/cities.csv", "csv", ["id"]).columns == ["id"]
    runs = scratch_dir(spark, "t-runs-read")
    sinks.log_run(spark, runs, "a", 1, 0)
    assert tables.read_runs(spark, runs).count() == 1
    path = scratch_dir(spark, "t-readings-read")
    sinks.upsert(spark, path, updates(spark, [(1, TS, 1.0, TS, 0)]))
    assert tables.read_readings(spark, path).first().reading_date == TS.date()
