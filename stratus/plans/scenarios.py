"""End-to-end job runs over the bound tables, used by the registered queries.

Each scenario derives its inputs from the whole ``readings`` table (so its
work grows with the data), runs the real jobs into fresh folders under the
shared checkpoint dir, and returns what those jobs wrote.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus import schemas as S
from stratus.functions import exprs as X
from stratus.plans import daily_state, etl
from stratus.session import scratch_dir  # noqa: F401 — re-exported for catalog
from stratus.sources import bindings, landing
from stratus.streaming import jobs

# A revision of every reading from this instant on is landed (and streamed) again.
REVISION_FROM = datetime(2024, 1, 16)
# Provisional landings report temperatures 1 degree too high.
PROVISIONAL_SHIFT = 1
LOAD_TIME = datetime(2024, 2, 1)


def _revision_pred(col: str = "timestamp"):
    return F.col(col) >= X.ts_literal(REVISION_FROM)


# Faults planted in the provisional run: city 7's readings with this code carry a temperature that
# fits no column, city 11's documents of one hour are cut short.
OVERFLOW_CITY, OVERFLOW_CODE, OVERFLOW_VALUE = 7, 42, 12345
CUT_CITY, CUT_HOUR, CUT_CHARS = 11, 3, 7


def land_provisional(spark: SparkSession, sf_dir: str, faults: bool = False) -> str:
    """Land every reading provisionally, one run per day and city, starting at the day's 00:00."""
    raw = bindings.readings(spark, sf_dir)
    if faults:
        wild = (F.col("city_id") == OVERFLOW_CITY) & (F.col("weather_code") == OVERFLOW_CODE)
        raw = raw.withColumn("temperature", F.when(wild, F.lit(OVERFLOW_VALUE).cast("decimal(7,2)"))
                             .otherwise(F.col("temperature")))
    cities = bindings.cities(spark, sf_dir)
    base = scratch_dir(spark, "landing-provisional")
    docs = landing.landing_docs(raw, cities, F.date_trunc("day", "timestamp"), PROVISIONAL_SHIFT)
    if not faults:
        landing.write_landing(docs, base)
        return base
    city = cities.where(F.col("id") == CUT_CITY).select(X.slug("name").alias("city"))
    hour = F.hour(X.parse_hour(F.get("hourly.time", F.lit(0))))
    landing.write_landing(docs.join(city, "city", "left_anti").unionByName(
        docs.join(city, "city", "left_semi").where(hour != CUT_HOUR)), base)
    text = F.to_json(F.struct("hourly"))
    (docs.join(city, "city", "left_semi").where(hour == CUT_HOUR)
         .select(F.substring(text, F.lit(1), F.length(text) - CUT_CHARS).alias("value"), *S.LANDING_PARTITIONS)
         .write.mode("append").partitionBy(*S.LANDING_PARTITIONS).text(base))
    return base


def land_revised(spark: SparkSession, sf_dir: str) -> str:
    """Land the readings from the revision day on again, by runs one hour later."""
    raw = bindings.readings(spark, sf_dir).where(_revision_pred())
    base = scratch_dir(spark, "landing-revised")
    day = F.date_trunc("day", "timestamp")
    landing.write_landing(landing.landing_docs(raw, bindings.cities(spark, sf_dir),
                                               day + F.expr("INTERVAL 1 HOUR")), base)
    return base


def two_loads(spark: SparkSession, sf_dir: str, base: str | None = None,
              marts: tuple[str, ...] = ()) -> tuple[str, str, str]:
    """Load 1: all provisional runs, faults among them. Load 2: provisional runs from the revision
    day (re-delivered) together with all revised runs; the later run wins per key.

    Returns ``(readings_table, run_log, quarantine)`` paths. With ``base``, both loads bring the
    daily state and the ``marts`` there up to date.
    """
    base_a = land_provisional(spark, sf_dir, faults=True)
    base_b = land_revised(spark, sf_dir)
    cities = bindings.cities(spark, sf_dir)
    table, runs, rejects = (scratch_dir(spark, n) for n in ("readings", "pipeline-runs", "rejects"))
    run_day = F.concat_ws("-", "year", "month", "day")
    for run_id, sources in (
            ("load-1", [(base_a, None)]),
            ("load-2", [(base_a, run_day >= REVISION_FROM.strftime("%Y-%m-%d")), (base_b, None)])):
        etl.load_runs(spark, sources, table, runs, cities, run_id, rejects,
                      created_at=LOAD_TIME, as_of=LOAD_TIME, base=base, marts=marts)
    return table, runs, rejects


# Faults planted in the first delivery: readings with code 42 arrive cut short; of those with code
# 45, city 7's carry a temperature that fits no column and city 8's have no city id.
BROKEN_CODE, UNFIT_CODE, NO_ID_CITY = 42, 45, 8


def _first_delivery(spark: SparkSession, sf_dir: str, unfit: bool) -> DataFrame:
    raw, cities, value = bindings.readings(spark, sf_dir), bindings.cities(spark, sf_dir), F.col("value")

    def code(n):
        return value.contains(f'"weather_code":{n},')

    sent = F.when(code(BROKEN_CODE), F.substring(value, F.lit(1), F.length(value) - 5))
    if unfit:
        sent = (sent.when(code(UNFIT_CODE) & (F.col("key") == str(OVERFLOW_CITY)), F.regexp_replace(
                    value, '"temperature":[^,]*', f'"temperature":{OVERFLOW_VALUE}.0'))
                    .when(code(UNFIT_CODE) & (F.col("key") == str(NO_ID_CITY)), F.regexp_replace(
                        value, '"city_id":[^,]*', '"city_id":null')))
    return jobs.to_messages(raw, cities, F.col("timestamp")).withColumn("value", sent.otherwise(value))


def _second_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = bindings.readings(spark, sf_dir).where(_revision_pred()).withColumn(
        "temperature", F.col("temperature") + F.lit(PROVISIONAL_SHIFT))
    return jobs.to_messages(shifted, bindings.cities(spark, sf_dir), F.col("timestamp"))


def _deliver(messages: DataFrame, path: str, later: int = 0) -> None:
    (messages.select("key", "value", (F.col("key").cast("int") % 3).alias("partition"),
                     (F.unix_micros(F.col("timestamp")) + F.lit(later)).alias("offset"))
             .write.mode("append").json(path))


def message_files(spark: SparkSession, sf_dir: str, unfit: bool = False) -> str:
    """Write the reading stream as two deliveries of JSON message files.

    Delivery 1: one message per reading, malformed for the broken code and
    (with ``unfit``) not storable for two cities. Delivery 2 (an at-least-once
    redelivery) re-sends every reading from the revision day on, intact but
    with the provisional temperature. Offsets order delivery 2 after 1.
    """
    path = scratch_dir(spark, "messages")
    _deliver(_first_delivery(spark, sf_dir, unfit), path)
    _deliver(_second_delivery(spark, sf_dir), path, 10 ** 17)
    return path


def stream_at_cadence(spark: SparkSession, sf_dir: str) -> str:
    """The readings sink triggered every second, two files at most each time; the table's path."""
    path, table, checkpoint, quarantine = (scratch_dir(spark, n) for n in (
        "messages", "streaming-readings", "ckpt-cadence", "quarantine"))
    _deliver(_first_delivery(spark, sf_dir, False), path)
    query = jobs.run_readings_sink(jobs.file_source(spark, path, files_per_trigger=2), table, checkpoint, quarantine,
                                   cadence="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return table


def stream_late(spark: SparkSession, sf_dir: str) -> str:
    """The revised second half of the month arrives first, everything else later; the table's path."""
    path, table, checkpoint, quarantine = (scratch_dir(spark, n) for n in (
        "messages", "streaming-readings", "ckpt-late", "quarantine"))
    for messages in (_second_delivery(spark, sf_dir), _first_delivery(spark, sf_dir, False)):
        _deliver(messages, path)
        jobs.run_readings_sink(jobs.file_source(spark, path, files_per_trigger=8), table, checkpoint, quarantine,
                               available_now=True).awaitTermination()
    return table


def stream_to_table(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Run the readings sink job over the message files; return ``(table, quarantine)``."""
    src_path = message_files(spark, sf_dir, unfit=True)
    table = scratch_dir(spark, "streaming-readings")
    quarantine = scratch_dir(spark, "quarantine")
    q = jobs.run_readings_sink(jobs.file_source(spark, src_path, files_per_trigger=4), table,
                               scratch_dir(spark, "ckpt-readings"), quarantine,
                               available_now=True)
    q.awaitTermination()
    return table, quarantine


def stream_alerts(spark: SparkSession, sf_dir: str, as_of: datetime) -> str:
    """Run the alert job over the message files against baselines merged from the daily state."""
    out = scratch_dir(spark, "alerts")
    _alerts(spark, sf_dir, message_files(spark, sf_dir), as_of, out, scratch_dir(spark, "ckpt-alerts"), None)
    return out


# Longer than the stream's span, so that no message of either delivery comes behind the watermark.
ONCE_WITHIN = "60 days"


def stream_alerts_once(spark: SparkSession, sf_dir: str, as_of: datetime) -> str:
    """The same with each reading scored once: delivery 1, a restart, then delivery 2."""
    path, out, checkpoint = (scratch_dir(spark, n) for n in ("messages", "alerts", "ckpt-alerts"))
    for messages in (_first_delivery(spark, sf_dir, False), _second_delivery(spark, sf_dir)):
        _deliver(messages, path)
        _alerts(spark, sf_dir, path, as_of, out, checkpoint, ONCE_WITHIN)
    return out


def _alerts(spark, sf_dir, path, as_of, out, checkpoint, once_within) -> None:
    state = scratch_dir(spark, "state")
    daily_state.refresh(spark, bindings.readings(spark, sf_dir), state)
    cities = bindings.cities(spark, sf_dir)
    jobs.run_alerts(jobs.file_source(spark, path, files_per_trigger=4),
                    lambda: daily_state.raw_baseline(daily_state.read_state(
                        spark, state, daily_state.window_start(as_of)), as_of, cities),
                    jobs.parquet_sink(out), checkpoint, available_now=True,
                    once_within=once_within).awaitTermination()
