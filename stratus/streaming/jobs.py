"""Structured Streaming jobs: readings sink (T1) and temperature alerts.

One message source feeds two independent queries, each with its own
checkpoint (offsets + commit log), so either can restart after an executor or
driver loss and resume from its last committed micro-batch.

Sources are injectable: :func:`kafka_source` on a cluster, or
:func:`file_source` (JSON files of the same ``key, value, partition, offset``
shape) in tests.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from stratus import schemas as S
from stratus.functions import exprs as X
from stratus.operators import joins, sinks

log = logging.getLogger(__name__)

# Fixed values of the reference's stream.
READINGS_TOPIC = "weather.readings.raw"
ALERTS_TOPIC = "weather.alerts"
SCHEMA_VERSION = "1.0"
ALERT_TYPE = "temperature_anomaly"
POLL_INTERVAL = "300 seconds"    # cadence of the producer and of baseline refreshes (T5)
BASELINE_WINDOW = f"{X.BASELINE_DAYS} days"

SOURCE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])


# ------------------------------------------------------------- sources ---

def kafka_source(spark: SparkSession, bootstrap: str, topic: str = READINGS_TOPIC,
                 max_offsets: int | None = None, **options) -> DataFrame:
    """Subscribe to the readings topic; ``earliest`` on first start.

    A micro-batch takes all that has arrived unless ``max_offsets`` bounds it
    (T2), so the sink never falls behind by its own setting.

    Offsets live in the query checkpoint (committed after each micro-batch),
    which replaces the consumer group's manual commits.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", "earliest"))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", max_offsets)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"),
                           "partition", "offset")


def file_source(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Test stand-in for S4: JSON files of ``key, value, partition, offset``."""
    return (spark.readStream.schema(SOURCE_SCHEMA)
            .option("maxFilesPerTrigger", files_per_trigger).json(path))


# ------------------------------------------------------ encode / decode ---

def to_messages(readings: DataFrame, cities: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Reading messages keyed by city id, enriched with the city.

    ``value`` is the JSON object of the reference's 9 fields; NULL measures are
    kept as ``null`` (``ignoreNullFields=false``). The message's ``timestamp``
    is its event time, the moment of ingest: ``ingested_at``, by default the
    clock. The reading's own hour goes along as ``reading_time``.
    """
    clock = F.current_timestamp() if ingested_at is None else ingested_at
    readings, now = readings.withColumn("ingested_at", clock).withColumnRenamed("timestamp", "reading_time"), F.col(
        "ingested_at")
    r = joins.with_city(readings, cities, [F.col("name").alias("city_name"), "country",
                                           "continent"])
    body = F.struct(
        "city_id", "city_name", "country", "continent",
        X.iso_utc(now).alias("timestamp"),
        F.col("temperature").cast("double").alias("temperature"),
        F.col("windspeed").cast("double").alias("windspeed"),
        F.col("weather_code").cast("int").alias("weather_code"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        X.iso_utc("reading_time").alias("reading_time"))
    return r.select(F.col("city_id").cast("string").alias("key"),
                    F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
                    now.alias("timestamp"))


def current_weather(df: DataFrame, col: str = "current_weather") -> DataFrame:
    """``temperature``, ``windspeed`` and ``weather_code`` of a nested API struct.

    Missing fields (or a missing struct) give NULL rather than an error.
    """
    fields = set(df.schema[col].dataType.fieldNames()) if col in df.columns else set()

    def get(name, typ):
        return (F.col(f"{col}.{name}") if name in fields else F.lit(None)).cast(typ)
    return df.select("*", get("temperature", "double").alias("temperature"),
                     get("windspeed", "double").alias("windspeed"),
                     get("weathercode", "int").alias("weather_code"))


def write_kafka(messages: DataFrame, bootstrap: str, topic: str = READINGS_TOPIC) -> None:
    """K5: publish ``key, value`` rows to a topic (batch)."""
    (messages.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())


def decode(messages: DataFrame, keep_bad: bool = False) -> tuple[DataFrame, DataFrame]:
    """Parse message JSON; return ``(good, bad)``.

    Parsing is PERMISSIVE with a corrupt-record column, so a malformed message
    becomes a ``bad`` row (to quarantine) instead of failing the batch. With
    ``keep_bad`` the first frame has all messages, with a ``malformed`` flag.
    """
    schema = T.StructType(S.READING_MESSAGE.fields + [T.StructField("_corrupt", T.StringType())])
    parsed = messages.withColumn("m", F.from_json(
        "value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    bad_cond = F.col("m").isNull() | F.col("m._corrupt").isNotNull()
    fields = [F.col(f"m.{f.name}").alias(f.name) for f in S.READING_MESSAGE.fields]
    bad = parsed.where(bad_cond).select(*messages.columns)
    if keep_bad:
        return parsed.select(*messages.columns, *fields, bad_cond.alias("malformed")), bad
    return parsed.where(~bad_cond).select(*messages.columns, *fields), bad


MALFORMED, UNFIT = "malformed", "unfit"


def judged(messages: DataFrame) -> DataFrame:
    """Messages with their ``streaming_readings`` columns and why they cannot be stored, parsed once.

    ``reason`` is null for a row to be stored, else ``malformed`` (not the
    JSON of a reading) or ``unfit``: a key column is NULL or a present measure
    does not fit its column (the batch load's rule).
    """
    good, _ = decode(messages, keep_bad=True)
    typed = {"temperature": "decimal(5,2)", "windspeed": "decimal(5,2)", "weather_code": "smallint"}
    unfit = (F.col("city_id").isNull() | F.col("timestamp").isNull()
             | X.overflowed([(F.col(c), F.col(c).try_cast(t)) for c, t in typed.items()]))
    return good.select(*messages.columns, "city_id", "timestamp",
                       *[F.col(c).try_cast(t).alias(c) for c, t in typed.items()],
                       F.when(F.col("malformed"), MALFORMED).when(unfit, UNFIT).alias("reason"))


# ------------------------------------------------------------ baselines ---

def raw_baseline(readings: DataFrame, as_of: datetime, cities: DataFrame | None = None
                 ) -> DataFrame:
    """Per-city mean and sample stddev of raw temperatures over the trailing 30 days.

    ``mean_temp_2dp`` is the mean rounded to 2 places exactly (from the integer
    sum), which is what alerts report.

    Unvalidated rows count (unlike the mart's staged baseline); at least 24
    readings are required. With ``cities`` given, the result is restricted to
    known cities, which bounds it by the (size-checked) dimension.
    """
    t = F.col("temperature")
    out = (X.recent(readings, "timestamp", as_of, BASELINE_WINDOW, inclusive=True)
           .where(t.isNotNull())
           .groupBy("city_id")
           .agg(X.exact_mean(t).alias("mean_temp"),
                X.exact_avg(t, 2, 7).cast("double").alias("mean_temp_2dp"),
                X.exact_stddev_samp(t).alias("stddev_temp"),
                F.count(F.lit(1)).alias("n"))
           .where(F.col("n") >= X.MIN_BASELINE_SAMPLES)
           .drop("n"))
    if cities is not None:
        ids = joins.bounded(cities.select(F.col("id").alias("city_id")))
        out = out.join(ids, "city_id")
    return out


def score_alerts(readings: DataFrame, baselines: DataFrame) -> DataFrame:
    """Alerts for readings more than 2 sigma from their city's baseline.

    No alert when the city has no baseline (inner join), the temperature is
    NULL, or the baseline stddev is 0. ``baselines`` is broadcast if it passes
    the size check.
    """
    j = joins.join_dimension(readings, baselines, "city_id")
    z = X.z_score("temperature", "mean_temp", "stddev_temp")
    ok = F.col("temperature").isNotNull() & (F.col("stddev_temp") > 0)
    scored = j.where(ok).withColumn("__z", z).where(F.abs("__z") > X.SIGNIFICANT_Z)
    return scored.select(
        *[c for c in readings.columns],
        F.lit(ALERT_TYPE).alias("alert_type"),
        F.round("__z", 3).alias("z_score"),
        F.col("mean_temp_2dp").alias("baseline_mean"),
        F.round("stddev_temp", 2).alias("baseline_stddev"),
        X.alert_severity("__z").alias("severity"))


def to_alert_messages(alerts: DataFrame) -> DataFrame:
    """K6: alert messages keyed like readings, for the alerts topic."""
    fields = [f.name for f in S.READING_MESSAGE.fields] + S.ALERT_FIELDS
    body = F.struct(*[X.iso_utc(f).alias(f) if f in ("timestamp", "reading_time") else F.col(f) for f in fields])
    return alerts.select(F.col("city_id").cast("string").alias("key"),
                         F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


# ----------------------------------------------------------------- jobs ---

def _start(writer, available_now: bool, cadence: str | None = None):
    """Start a query: at ``cadence`` (or as data arrives), or drain what is there and stop (tests)."""
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif cadence:
        writer = writer.trigger(processingTime=cadence)
    return writer.start()


SINK_METRICS = "readings_sink"


class BatchMetrics(StreamingQueryListener):
    """Hands the observed counters of every micro-batch to ``report(name, batch_id, counters)``.

    ``spark.streams.addListener(BatchMetrics(report))``; ``name`` is that of the
    observation (``readings_sink``: read, stored, malformed, unfit).
    """

    def __init__(self, report: Callable[[str, int, dict], None]):
        self.report = report

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        for name, row in event.progress.observedMetrics.items():
            self.report(name, event.progress.batchId, row.asDict())

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def run_readings_sink(source: DataFrame, table: str, checkpoint: str, quarantine: str,
                      available_now: bool = False, cadence: str | None = None,
                      max_files: int = sinks.MAX_FILES):
    """Messages -> ``streaming_readings`` with first-write-wins per key.

    Each micro-batch is parsed once: the earliest offset per key is kept, keys
    already stored are dropped, the rest is appended. What cannot be decoded or
    stored goes to ``quarantine`` with its text, as partition ``batch_id``. Both
    writes are idempotent, so replaying a batch after a failure adds nothing;
    no watermark, so late messages are accepted whatever their age. A day of
    the batch that has come to more than ``max_files`` small files is rewritten
    before the next batch, so the files of a day stay bounded. The batch's
    counters are observed as ``readings_sink`` (:class:`BatchMetrics`).
    """
    spark = source.sparkSession
    reason, kept = F.col("reason"), F.col("reason").isNull()
    counted = judged(source).observe(
        SINK_METRICS, F.count(F.lit(1)).alias("read"), F.count_if(kept).alias("stored"),
        F.count_if(reason == MALFORMED).alias("malformed"), F.count_if(reason == UNFIT).alias("unfit"))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # the micro-batch feeds several actions (its days and rejects, quarantine, append)
        batch = batch.persist()
        try:
            days, rejected = batch.agg(F.collect_set(F.when(kept, F.to_date("timestamp"))),
                                       F.count_if(~kept)).first()
            sinks.append_once(batch.where(~kept).select("key", "value", "partition", "offset"),
                              quarantine, "batch_id", batch_id, any_rows=rejected > 0)
            if days:
                rows = batch.where(kept).drop("key", "value", "reason")
                sinks.insert_absent(spark, table, rows, order=["partition", "offset"], dates=sorted(days))
                sinks.compact(spark, table, sinks.crowded(spark, table, sorted(days), max_files))
        finally:
            batch.unpersist()

    return _start(counted.writeStream.foreachBatch(per_batch)
                  .option("checkpointLocation", checkpoint), available_now, cadence)


def run_alerts(source: DataFrame, baseline_fn: Callable[[], DataFrame], sink: Callable,
               checkpoint: str, available_now: bool = False, cadence: str | None = POLL_INTERVAL,
               once_within: str | None = None):
    """Score every decoded reading against baselines refreshed once per micro-batch.

    ``baseline_fn`` is evaluated and its (bounded) result computed before
    anything is scored. If that fails, while planning or while running, the
    cause is logged as a warning and the batch passes without alerts — it is
    not retried, as readings must not wait for baselines. ``sink(alerts_df,
    batch_id)`` writes the alerts — e.g. ``to_alert_messages`` to Kafka
    (at-least-once, like the reference's alert producer), or Parquet.

    ``baseline_fn`` should merge the daily state (``daily_state.raw_baseline``),
    which reads a row a city and day; ``raw_baseline`` here reads 30 days of
    readings. With ``once_within`` (an interval) a reading that is delivered
    again within that time of its event time is scored once: the keys seen are
    kept as state until the watermark passes them, and messages that come later
    than the watermark are not scored. They still reach the table, whose job
    has no watermark. Messages without a key are not scored then.
    """
    messages, _ = decode(source)
    messages = messages.drop("key", "value", "partition", "offset")
    if once_within:
        messages = (messages.where(F.col("city_id").isNotNull() & F.col("timestamp").isNotNull())
                            .withWatermark("timestamp", once_within)
                            .dropDuplicatesWithinWatermark(["city_id", "timestamp"]))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        try:
            baselines = baseline_fn().persist()
            baselines.count()
        except Exception:  # noqa: BLE001
            log.warning("batch %s passes without alerts: no baselines", batch_id, exc_info=True)
            return
        try:
            sink(score_alerts(batch, baselines), batch_id)
        finally:
            baselines.unpersist()

    return _start(messages.writeStream.foreachBatch(per_batch)
                  .option("checkpointLocation", checkpoint), available_now, cadence)


def kafka_sink(bootstrap: str, topic: str = ALERTS_TOPIC) -> Callable:
    """K6 sink for :func:`run_alerts`: alert messages to the alerts topic."""
    def write(alerts: DataFrame, batch_id: int) -> None:
        (to_alert_messages(alerts).write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())
    return write


def parquet_sink(path: str) -> Callable:
    """Alerts as Parquet partition ``batch_id``; a replayed batch replaces its own."""
    def write(alerts: DataFrame, batch_id: int) -> None:
        sinks.append_once(alerts, path, "batch_id", batch_id)
    return write
