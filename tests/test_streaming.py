"""Streaming jobs on a file source: decode, quarantine, first-write-wins, replay, alerts."""

import json
import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from stratus.session import scratch_dir
from stratus.streaming import jobs


def msg(city, ts, temp, code=0):
    return json.dumps({"city_id": city, "city_name": "X", "country": "C", "continent": "Asia",
                       "timestamp": ts, "temperature": temp, "windspeed": 1.0,
                       "weather_code": code, "schema_version": "1.0"})


def write_batch(base, name, rows):
    with open(os.path.join(base.removeprefix("file:"), name), "w") as f:
        for i, (key, value, offset) in enumerate(rows):
            f.write(json.dumps({"key": key, "value": value, "partition": 0,
                                "offset": offset}) + "\n")


def run_sink(spark, src):
    table = scratch_dir(spark, "t-stream-table")
    quarantine = scratch_dir(spark, "t-stream-q")
    q = jobs.run_readings_sink(jobs.file_source(spark, src), table,
                               scratch_dir(spark, "t-ckpt"), quarantine, available_now=True)
    q.awaitTermination()
    return table, quarantine


def test_sink_dedupes_quarantines_and_replays(spark):
    src = scratch_dir(spark, "t-stream-src", create=True)
    t1 = "2024-01-05T01:00:00.000000Z"
    write_batch(src, "b1.json", [("1", msg(1, t1, 10.0), 1), ("1", msg(1, t1, 99.0), 2),
                                 ("2", '{"city_id": 2, "tempera', 3),
                                 ("3", msg(None, t1, 1.0), 4),
                                 ("4", msg(4, "2020-01-01T00:00:00.000000Z", None), 5),
                                 ("6", msg(6, t1, 12345.0), 8), ("7", msg(7, t1, 1.0, 99999), 9)])
    write_batch(src, "b2.json", [("1", msg(1, t1, 55.0), 6), ("5", msg(5, t1, 5.0), 7)])
    table, quarantine = run_sink(spark, src)
    rows = sorted((r.city_id, r.temperature) for r in spark.read.parquet(table).collect())
    # first write wins, late (2020) reading accepted, NULL temperature kept
    assert [(c, None if t is None else float(t)) for c, t in rows] == [
        (1, 10.0), (4, None), (5, 5.0)]
    # malformed JSON, NULL key, two overflows: each with its text
    kept = {r.key: r.value for r in spark.read.parquet(quarantine).collect()}
    assert kept == {"2": '{"city_id": 2, "tempera', "3": msg(None, t1, 1.0), "6": msg(6, t1, 12345.0),
                    "7": msg(7, t1, 1.0, 99999)}
    # replaying the same files with a fresh checkpoint into the same table adds nothing
    q = jobs.run_readings_sink(jobs.file_source(spark, src), table,
                               scratch_dir(spark, "t-ckpt2"), quarantine, available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(table).count() == 3
    assert spark.read.parquet(quarantine).count() == 4


def test_alerts_guards(spark):
    src = scratch_dir(spark, "t-alert-src", create=True)
    t1 = "2024-01-05T01:00:00.000000Z"
    write_batch(src, "b1.json", [("1", msg(1, t1, 30.0), 1), ("1", msg(1, t1, 11.0), 2),
                                 ("2", msg(2, t1, 99.0), 3), ("3", msg(3, t1, 99.0), 4),
                                 ("1", msg(1, t1, None), 5)])
    baselines = spark.createDataFrame([(1, 10.0, 10.0, 5.0), (3, 7.0, 7.0, 0.0)],
                                      "city_id int, mean_temp double, mean_temp_2dp double, "
                                      "stddev_temp double")
    out = scratch_dir(spark, "t-alerts")
    q = jobs.run_alerts(jobs.file_source(spark, src), lambda: baselines, jobs.parquet_sink(out),
                        scratch_dir(spark, "t-ckpt3"), available_now=True)
    q.awaitTermination()
    rows = [(r.city_id, r.z_score, r.severity, r.alert_type)
            for r in spark.read.parquet(out).collect()]
    assert rows == [(1, 4.0, "extreme", "temperature_anomaly")]


def test_decode_splits_malformed(spark):
    df = spark.createDataFrame([("1", msg(1, "2024-01-05T01:00:00Z", 1.5)), ("2", "{oops")],
                               "key string, value string")
    good, bad = jobs.decode(df)
    g = good.collect()
    assert len(g) == 1 and g[0].temperature == 1.5
    assert g[0].timestamp == datetime(2024, 1, 5, 1)
    assert [r.key for r in bad.collect()] == ["2"]


def test_messages_keep_null_fields_and_key_by_city(spark):
    from decimal import Decimal
    from stratus import schemas as S
    readings = spark.createDataFrame(
        [(3, datetime(2024, 1, 5, 1, 2, 3, 456789), None, None, None, Decimal("4.50"), None, 61)],
        S.READINGS)
    cities = spark.createDataFrame([(3, "Oslo", "NO", "Europe")],
                                   "id int, name string, country string, continent string")
    began = datetime.now(timezone.utc).replace(tzinfo=None)
    m = jobs.to_messages(readings, cities).first()
    body = json.loads(m.value)
    assert m.key == "3" and body["temperature"] is None and body["windspeed"] == 4.5
    assert body["reading_time"] == "2024-01-05T01:02:03.456789Z" and body["schema_version"] == "1.0"
    # event time is the moment of ingest, by the clock unless the source brings its own
    assert abs((datetime.fromisoformat(body["timestamp"].rstrip("Z")) - began).total_seconds()) < 600
    assert list(body) == ["city_id", "city_name", "country", "continent", "timestamp",
                          "temperature", "windspeed", "weather_code", "schema_version", "reading_time"]
    own = jobs.to_messages(readings, cities, F.col("timestamp") + F.expr("INTERVAL 7 MINUTES")).first()
    assert json.loads(own.value)["timestamp"] == "2024-01-05T01:09:03.456789Z"
    assert own.timestamp == datetime(2024, 1, 5, 1, 9, 3, 456789)


def test_current_weather_defaults(spark):
    df = spark.createDataFrame([((21.5, 3.0),), (None,)],
                               "current_weather struct<temperature:double, windspeed:double>")
    got = [tuple(r) for r in jobs.current_weather(df)
           .select("temperature", "windspeed", "weather_code").collect()]
    assert got == [(21.5, 3.0, None), (None, None, None)]


def test_a_baseline_that_fails_while_running_is_logged_and_the_query_goes_on(spark, caplog):
    src = scratch_dir(spark, "t-fail-src", create=True)
    t1 = "2024-01-05T01:00:00.000000Z"
    write_batch(src, "b1.json", [("1", msg(1, t1, 30.0), 1)])
    good = spark.createDataFrame([(1, 10.0, 10.0, 5.0)], "city_id int, mean_temp double, "
                                 "mean_temp_2dp double, stddev_temp double")
    calls = []

    def baselines():
        calls.append(1)
        return good.where(F.raise_error(F.lit("no table")).isNull()) if len(calls) == 1 else good

    out = scratch_dir(spark, "t-fail-alerts")
    with caplog.at_level("WARNING"):
        q = jobs.run_alerts(jobs.file_source(spark, src), baselines, jobs.parquet_sink(out),
                            scratch_dir(spark, "t-fail-ckpt"), available_now=True)
        q.awaitTermination()
    assert len(calls) == 1 and "passes without alerts" in caplog.text
    write_batch(src, "b2.json", [("1", msg(1, t1, 40.0), 2)])
    q = jobs.run_alerts(jobs.file_source(spark, src), baselines, jobs.parquet_sink(out),
                        scratch_dir(spark, "t-fail-ckpt2"), available_now=True)
    q.awaitTermination()
    assert sorted(r.z_score for r in spark.read.parquet(out).collect()) == [4.0, 6.0]


def test_replayed_alert_batch_replaces_its_own(spark):
    out = scratch_dir(spark, "t-replay-alerts")
    alerts = spark.createDataFrame([(1, 2.5)], "city_id int, z_score double")
    for _ in range(2):
        jobs.parquet_sink(out)(alerts, 7)
    jobs.parquet_sink(out)(alerts, 8)
    assert spark.read.parquet(out).count() == 2


def test_alert_messages_keep_the_field_order(spark):
    from stratus import schemas as S
    row = (3, "Oslo", "NO", "Europe", datetime(2024, 1, 5, 1), 40.5, 1.0, 3, "1.0", datetime(2024, 1, 5),
           "temperature_anomaly", 2.5, 10.0, 4.0, "significant")
    fields = [f.name for f in S.READING_MESSAGE.fields] + S.ALERT_FIELDS
    types = [f.dataType.simpleString() for f in S.READING_MESSAGE.fields] + [
        "string", "double", "double", "double", "string"]
    alerts = spark.createDataFrame([row], ", ".join(f"{n} {t}" for n, t in zip(fields, types)))
    m = jobs.to_alert_messages(alerts).first()
    body = json.loads(m.value)
    assert m.key == "3" and list(body) == fields and body["timestamp"] == "2024-01-05T01:00:00.000000Z"
    assert body["reading_time"] == "2024-01-05T00:00:00.000000Z"
    assert (body["z_score"], body["severity"]) == (2.5, "significant")


def baseline(spark):
    return spark.createDataFrame([(1, 10.0, 10.0, 5.0)], "city_id int, mean_temp double, "
                                 "mean_temp_2dp double, stddev_temp double")


def test_a_redelivered_message_raises_one_alert(spark):
    src, out, cp = scratch_dir(spark, "t-once-src", create=True), scratch_dir(spark, "t-once"), scratch_dir(spark, "t-once-cp")
    t1, t2 = "2024-01-05T01:00:00.000000Z", "2024-01-05T02:00:00.000000Z"

    def run():
        q = jobs.run_alerts(jobs.file_source(spark, src), lambda: baseline(spark), jobs.parquet_sink(out), cp,
                            available_now=True, once_within="1 day")
        q.awaitTermination()
        return sorted((r.timestamp.hour, r.z_score) for r in spark.read.parquet(out).collect())

    # within a batch, in the next batch, and after a restart from the checkpoint
    write_batch(src, "b1.json", [("1", msg(1, t1, 30.0), 1), ("1", msg(1, t1, 30.0), 2), ("", msg(None, t1, 30.0), 3)])
    write_batch(src, "b2.json", [("1", msg(1, t1, 30.0), 4), ("1", msg(1, t2, 25.0), 5)])
    assert run() == [(1, 4.0), (2, 3.0)]
    write_batch(src, "b3.json", [("1", msg(1, t1, 35.0), 6), ("1", msg(1, t2, 25.0), 7)])
    assert run() == [(1, 4.0), (2, 3.0)]


def test_without_a_watermark_a_redelivery_is_scored_again(spark):
    src, out = scratch_dir(spark, "t-twice-src", create=True), scratch_dir(spark, "t-twice")
    t1 = "2024-01-05T01:00:00.000000Z"
    write_batch(src, "b1.json", [("1", msg(1, t1, 30.0), 1), ("1", msg(1, t1, 30.0), 2)])
    jobs.run_alerts(jobs.file_source(spark, src), lambda: baseline(spark), jobs.parquet_sink(out),
                    scratch_dir(spark, "t-twice-cp"), available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_late_messages_reach_the_table_but_are_not_scored_behind_the_watermark(spark):
    src, out, table = (scratch_dir(spark, f"t-late-{n}", create=n == "src") for n in ("src", "out", "table"))
    write_batch(src, "b1.json", [("1", msg(1, "2024-01-05T01:00:00.000000Z", 30.0), 1)])
    write_batch(src, "b2.json", [("1", msg(1, "2024-01-05T02:00:00.000000Z", 30.0), 2)])
    write_batch(src, "b3.json", [("1", msg(1, "2024-01-01T00:00:00.000000Z", 30.0), 3)])
    for i in (1, 2, 3):        # the file source takes files by their times
        os.utime(f"{src.removeprefix('file:')}/b{i}.json", (1_700_000_000 + i,) * 2)
    source = jobs.file_source(spark, src)
    jobs.run_alerts(source, lambda: baseline(spark), jobs.parquet_sink(out), scratch_dir(spark, "t-late-cp"),
                    available_now=True, once_within="1 day").awaitTermination()
    jobs.run_readings_sink(source, table, scratch_dir(spark, "t-late-cp2"), scratch_dir(spark, "t-late-q"),
                           available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == 2 and spark.read.parquet(table).count() == 3


def test_files_of_a_day_stay_bounded_over_many_batches(spark):
    """100 micro-batches on one day and some on another: no day keeps more than the bound and one batch's files."""
    src, table = scratch_dir(spark, "t-many-src", create=True), scratch_dir(spark, "t-many")
    for i in range(100):
        at = datetime(2024, 1, 5) + timedelta(minutes=i)
        rows = [("1", msg(c, f"{at:%Y-%m-%dT%H:%M:%S}.000000Z", float(i)), 10 * i + c) for c in range(3)]
        if i % 10 == 0:
            rows.append(("1", msg(1, f"2024-01-06T00:{i // 10:02d}:00.000000Z", 1.0), 10 * i + 9))
        write_batch(src, f"b{i:03d}.json", rows)
    most = []

    class Sizes:
        def __call__(self, name, batch_id, counters):
            most.append((name, batch_id, counters))

    listener = jobs.BatchMetrics(Sizes())
    spark.streams.addListener(listener)
    try:
        q = jobs.run_readings_sink(jobs.file_source(spark, src), table, scratch_dir(spark, "t-many-cp"),
                                   scratch_dir(spark, "t-many-q"), available_now=True, max_files=6)
        q.awaitTermination()
        spark._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    rows = spark.read.parquet(table)
    assert rows.count() == 310 and rows.select("city_id", "timestamp").distinct().count() == 310
    folder = table.removeprefix("file:")
    for day in ("2024-01-05", "2024-01-06"):
        files = [f for f in os.listdir(f"{folder}/reading_date={day}") if f.endswith(".parquet")]
        assert len(files) <= 7
    # Every micro-batch reports its own counters, each row counted once
    own = [c for n, _, c in most if n == jobs.SINK_METRICS]
    assert len({b for n, b, _ in most if n == jobs.SINK_METRICS}) == 100
    assert sum(c["read"] for c in own) == sum(c["stored"] for c in own) == 310


def test_cadence_and_batch_bound(spark):
    """A fixed cadence takes at most the bound of files each time, until all have been read."""
    src, table = scratch_dir(spark, "t-cadence-src", create=True), scratch_dir(spark, "t-cadence")
    for i in range(4):
        write_batch(src, f"b{i}.json", [("1", msg(1, f"2024-01-05T0{i}:00:00.000000Z", 1.0), i)])
    q = jobs.run_readings_sink(jobs.file_source(spark, src, files_per_trigger=2), table, scratch_dir(spark, "t-cadence-cp"),
                               scratch_dir(spark, "t-cadence-q"), cadence="1 second")
    try:
        q.processAllAvailable()
        taken = [p.numInputRows for p in q.recentProgress if p.numInputRows]
    finally:
        q.stop()
    assert taken == [2, 2] and spark.read.parquet(table).count() == 4
