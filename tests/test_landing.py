"""Landed parallel-array documents: explode, safe index, missing objects, partitions."""

import json
import os

from stratus.sources import landing
from stratus.session import scratch_dir


def write_docs(spark, docs):
    base = scratch_dir(spark, "t-landing")
    for rel, doc in docs:
        d = os.path.join(base.removeprefix("file:"), rel)
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "data.json"), "w") as f:
            f.write(json.dumps(doc))
    return base


def test_explode_short_long_missing_and_empty(spark):
    base = write_docs(spark, [
        ("city=new_york/year=2026/month=04/day=06/hour=14",
         {"hourly": {"time": ["2026-04-06T00:00", "2026-04-06T01:00"],
                     "temperature_2m": [12.5, 13.1], "apparent_temperature": [10.2],
                     "precipitation": [0.0, 0.2, 9.9], "windspeed_10m": [15.3, 18.7],
                     "relative_humidity_2m": [72, 75], "weathercode": [3, 61]}}),
        ("city=são_paulo/year=2026/month=04/day=06/hour=14", {"other": 1}),
        ("city=oslo/year=2026/month=04/day=06/hour=14", {"hourly": {"time": []}}),
    ])
    docs = landing.read_landing(spark, base)
    rows = sorted(landing.explode_hourly(docs).collect(), key=lambda r: r.pos)
    assert len(rows) == 2
    assert rows[0].temperature_2m == 12.5 and rows[1].weathercode == 61
    assert rows[1].apparent_temperature is None          # short array -> NULL
    assert rows[1].precipitation == 0.2                  # extra element ignored
    assert (rows[0].city, rows[0].month, rows[0].hour) == ("new_york", "04", "14")


def test_typed_readings_and_city_resolution(spark):
    base = write_docs(spark, [
        ("city=new_york/year=2026/month=04/day=06/hour=14",
         {"hourly": {"time": ["2026-04-06T00:00", "bad", "2026-04-06T02:00"],
                     "temperature_2m": [12.5, 1.0, 12345.0], "weathercode": [3, 3, 3]}})])
    cities = spark.createDataFrame([(7, "New York"), (8, "Oslo")], "id int, name string")
    present, missing = landing.resolve_cities(landing.read_landing(spark, base), cities)
    good, bad = landing.typed_readings(landing.explode_hourly(present))
    g = good.collect()
    assert len(g) == 1 and g[0].city_id == 7 and str(g[0].temperature) == "12.50"
    assert bad.count() == 2                              # unparsable time, overflowing value
    assert [r.name for r in missing.collect()] == ["Oslo"]


def test_a_document_holds_one_hour_at_any_size(spark):
    from datetime import datetime, timedelta
    from decimal import Decimal
    from pyspark.sql import functions as F
    from stratus import schemas as S
    t0 = datetime(2024, 1, 1)
    rows = [(1, t0 + timedelta(seconds=40 * i), Decimal("1.00"), None, None, None, None, None)
            for i in range(270)]
    readings = spark.createDataFrame(rows, S.READINGS)
    cities = spark.createDataFrame([(1, "Oslo")], "id int, name string")
    docs = landing.landing_docs(readings, cities, F.date_trunc("day", "timestamp"))
    assert [r[0] for r in docs.select(F.size("hourly.time")).collect()] == [90, 90, 90]
    base = scratch_dir(spark, "t-hours")
    landing.write_landing(docs, base)
    found = landing.explode_hourly(landing.read_landing(spark, base)).collect()
    assert len(found) == 270 and max(r.pos for r in found) == 89


def test_relanding_a_run_replaces_only_that_run(spark):
    from datetime import datetime, timedelta
    from decimal import Decimal
    from pyspark.sql import functions as F
    from stratus import schemas as S
    t0 = datetime(2024, 1, 1, 5)
    rows = [(1, t0 + timedelta(days=d), Decimal("1.00"), None, None, None, None, None)
            for d in range(3)]
    readings = spark.createDataFrame(rows, S.READINGS)
    cities = spark.createDataFrame([(1, "New York")], "id int, name string")
    base = scratch_dir(spark, "t-reland")
    run = F.date_trunc("day", "timestamp")
    landing.write_landing(landing.landing_docs(readings, cities, run), base)
    # re-land day 2 only, with revised values
    landing.write_landing(landing.landing_docs(readings.where(F.dayofmonth("timestamp") == 2),
                                               cities, run, measure_shift=5), base)
    got = sorted((r.day, r.temperature_2m) for r in
                 landing.explode_hourly(landing.read_landing(spark, base)).collect())
    assert got == [("01", 1.0), ("02", 6.0), ("03", 1.0)]
    assert {r.city for r in landing.read_landing(spark, base).collect()} == {"new_york"}
