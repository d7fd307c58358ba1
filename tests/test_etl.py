"""Batch ETL: landed runs -> readings table + run log, with missing-city errors."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from stratus import schemas as S
from stratus.plans import etl
from stratus.session import scratch_dir
from stratus.sources import landing


def test_load_runs_upserts_and_logs(spark):
    t0 = datetime(2024, 1, 1, 3)
    rows = [(1, t0 + timedelta(hours=h), Decimal(h), None, None, None, None, 3)
            for h in range(4)]
    readings = spark.createDataFrame(rows, S.READINGS)
    cities = spark.createDataFrame(
        [(1, "New York", "US", "US", "North America", Decimal(1), Decimal(1), "UTC", None),
         (2, "Oslo", "NO", "NO", "Europe", Decimal(1), Decimal(1), "UTC", None)], S.CITIES)
    base1, base2 = scratch_dir(spark, "t-l1"), scratch_dir(spark, "t-l2")
    day = F.date_trunc("day", "timestamp")
    landing.write_landing(landing.landing_docs(readings, cities, day), base1)
    landing.write_landing(landing.landing_docs(readings.where(F.hour("timestamp") >= 5), cities,
                                               day + F.expr("INTERVAL 1 HOUR"), 10), base2)
    table, runs, rejects = (scratch_dir(spark, f"t-{n}") for n in ("tab", "runs", "rejects"))
    r1 = etl.load_runs(spark, [(base1, None)], table, runs, cities, "r1", rejects, as_of=t0)
    assert (r1.rows_loaded, r1.errors, r1.rejected) == (4, 1, 0)   # Oslo has no landing
    assert [(x.check_name, x.passed) for x in r1.report][0] == ("coverage", False)
    r2 = etl.load_runs(spark, [(base2, None)], table, runs, cities, "r2", rejects, as_of=t0)
    assert r2.rows_loaded == 2 and r2.touched == [t0.date()]
    assert r2.counters == {"read": 2, "stored": 2, "rejected": 0, "cities_in_error": 1}
    got = sorted((r.timestamp.hour, float(r.temperature))
                 for r in spark.read.parquet(table).collect())
    assert got == [(3, 0.0), (4, 1.0), (5, 12.0), (6, 13.0)]
    log = sorted((r.id, r.run_id, r.rows_fetched, r.rows_loaded, r.status)
                 for r in spark.read.parquet(runs).collect())
    assert log == [(1, "r1", 5, 4, "partial"), (2, "r2", 3, 2, "partial")]


def test_faults_are_kept_counted_by_city_and_make_the_run_partial(spark):
    import json
    import os
    base = scratch_dir(spark, "t-faults")
    docs = {"oslo": json.dumps({"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"],
                                           "temperature_2m": [1.5, 12345.0]}}),
            "rome": '{"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [1',
            "lima": json.dumps({"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [2.5]}}),
            "atlantis": json.dumps({"hourly": {"time": ["2024-01-01T00:00"]}})}
    for city, text in docs.items():
        d = os.path.join(base.removeprefix("file:"), f"city={city}/year=2024/month=01/day=01/hour=00")
        os.makedirs(d)
        with open(os.path.join(d, "data.json"), "w") as f:
            f.write(text)
    cities = spark.createDataFrame([(1, "Oslo"), (2, "Rome"), (3, "Lima"), (4, "Bonn")], "id int, name string")
    table, runs, rejects = (scratch_dir(spark, f"t-f-{n}") for n in ("tab", "runs", "rejects"))
    for _ in range(2):                                     # the second time replaces the run's rejects
        r = etl.load_runs(spark, [(base, None)], table, runs, cities, "r", rejects)
    assert (r.rows_loaded, r.errors, r.rejected) == (2, 4, 3)   # Oslo, Rome, Atlantis, Bonn; Lima is fine
    assert sorted((x.city_id, str(x.temperature)) for x in spark.read.parquet(table).collect()) == [
        (1, "1.50"), (3, "2.50")]
    kept = {x.city: (x.reason, x.original) for x in spark.read.parquet(rejects).collect()}
    assert kept["rome"] == ("unreadable document", docs["rome"])
    assert kept["oslo"][0] == "row out of range" and "12345.0" in kept["oslo"][1]
    assert kept["atlantis"][0] == "unknown city" and len(kept) == 3
    assert {x.status for x in spark.read.parquet(runs).collect()} == {"partial"}
    assert r.counters == {"read": 5, "stored": 2, "rejected": 3, "cities_in_error": 4}
    # the run is repeated without its faults: its rejects go
    for city in ("oslo", "rome", "atlantis"):
        with open(os.path.join(base.removeprefix("file:"), f"city={city}/year=2024/month=01/day=01/hour=00/data.json"), "w") as f:
            f.write(docs["lima"])
    other = cities.unionByName(spark.createDataFrame([(9, "Atlantis")], cities.schema))
    r = etl.load_runs(spark, [(base, None)], table, runs, other, "r", rejects)
    assert (r.rows_loaded, r.errors, r.rejected) == (4, 1, 0)
    assert "run_id=r" not in os.listdir(rejects.removeprefix("file:"))


def test_a_load_without_errors_succeeds(spark):
    t0 = datetime(2024, 1, 1, 3)
    readings = spark.createDataFrame([(1, t0, Decimal(1), None, None, None, None, 3)], S.READINGS)
    cities = spark.createDataFrame([(1, "Oslo")], "id int, name string")
    base, table, runs, rejects = (scratch_dir(spark, f"t-ok-{n}") for n in ("l", "tab", "runs", "rejects"))
    landing.write_landing(landing.landing_docs(readings, cities, F.date_trunc("day", "timestamp")), base)
    r = etl.load_runs(spark, [(base, None)], table, runs, cities, "r", rejects)
    assert (r.rows_loaded, r.errors, r.rejected) == (1, 0, 0)
    assert spark.read.parquet(runs).first().status == "success"
