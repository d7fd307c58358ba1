"""Published daily state and marts of a readings table, rebuilt by the days a load has touched.

Layout, chosen by who reads it:

* ``daily_summary``: by month and, inside, by a hash bucket of the city's
  name, sorted by city. One city's series opens one bucket a month; a touched
  day rewrites its month from the daily state.
* ``temperature_anomalies``, ``extreme_weather``: by ``reading_date``, sorted
  by city, so that the 24-hour panels list one or two days. Extreme events of
  touched days only are rebuilt. Anomalies are rebuilt whole, as each build
  scores all history against a new baseline.
* ``weekly_trends``, ``city_comparisons``: small, rebuilt whole from the daily
  state, the latter from a row a city and month.

Only the per-reading marts and the state of touched days read the readings.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators import sinks
from stratus.operators.publish import read_published, tidy, version
from stratus.operators.sinks import PARTITION_COL
from stratus.plans import daily_state, marts, staging
from stratus.plans.panels import CITY_BUCKET, city_bucket

MARTS = ("daily_summary", "weekly_trends", "city_comparisons", "temperature_anomalies", "extreme_weather")
MONTH = daily_state.MONTH
# Versions of a table that stay for readers that began before its last rebuilds.
KEPT_VERSIONS = 3


def state_path(base: str) -> str:
    return f"{base.rstrip('/')}/state"


def mart_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/marts/{name}"


def refresh(spark: SparkSession, base: str, readings: DataFrame, cities: DataFrame, as_of: datetime,
            days: list[date] | None = None, names: tuple[str, ...] | list[str] = MARTS,
            keep: int = KEPT_VERSIONS) -> None:
    """Bring the daily state and the marts ``names`` up to date and publish them.

    ``readings`` is the raw table and ``cities`` the staged dimension. ``days``
    are the days whose readings have changed (``sinks.upsert`` returns them);
    None rebuilds everything. A mart or state that was never built is built
    whole. Each table is published on its own, after the state it comes from;
    its versions before the newest ``keep`` are removed, so a reader has as
    many rebuilds' time to finish.
    """
    if days is None or version(spark, f"{state_path(base)}/moments") is None:
        days = None
    daily_state.refresh(spark, readings, state_path(base), days)
    for name in names:
        build(spark, base, name, readings, cities, as_of, days)
    for path in [f"{state_path(base)}/{t}" for t in daily_state.TABLES] + [mart_path(base, n) for n in names]:
        tidy(spark, path, keep)


def build(spark: SparkSession, base: str, name: str, readings: DataFrame, cities: DataFrame, as_of: datetime,
          days: list[date] | None = None) -> None:
    """K7: build one mart from the published state (and, where it is by reading, the readings).

    Built for ``days`` alone only on top of a mart of the same dimension.
    """
    path, note = mart_path(base, name), _dimension(cities)
    before = version(spark, path)
    if before is None or before.note != note:
        days = None                   # a changed dimension changes the rows of every day
    stg = staging.stg_readings(readings)

    def state(first: date | None = None, last: date | None = None) -> dict[str, DataFrame]:
        return daily_state.read_state(spark, state_path(base), first, last)
    if name == "daily_summary":
        months = daily_state.months_of(days)
        cells = daily_state.conditions_of(spark, state_path(base), months)
        out = marts.daily_summary_of(cells, cities).withColumns({
            MONTH: F.date_format("date", "yyyy-MM"), CITY_BUCKET: city_bucket(F.col("city_name"))})
        sinks.build_mart(_laid_out(out, [MONTH, CITY_BUCKET], ["city_name", "date"]), path,
                         [MONTH, CITY_BUCKET], months, note)
    elif name == "weekly_trends":
        sinks.build_mart(marts.weekly_trends_of(state()["conditions"], cities), path, note=note)
    elif name == "city_comparisons":
        sinks.build_mart(marts.city_comparisons_of(state()["months"], cities), path, note=note)
    elif name == "temperature_anomalies":
        stats = marts.robust_stats_of(daily_state.staged_counts(
            state(daily_state.window_start(as_of)), as_of, readings))
        sinks.build_mart(_by_day(marts.temperature_anomalies(stg, cities, as_of, stats=stats), readings), path,
                         [PARTITION_COL], note=note)
    elif name == "extreme_weather":
        if days is not None:
            day = F.col(PARTITION_COL) if PARTITION_COL in stg.columns else F.to_date("reading_at")
            stg = stg.where(day.isin(days))
        sinks.build_mart(_by_day(marts.extreme_weather(stg, cities), readings), path, [PARTITION_COL],
                         None if days is None else [d.isoformat() for d in days], note)
    else:
        raise ValueError(f"unknown mart {name}")


def _dimension(cities: DataFrame) -> str:
    """A fingerprint of the dimension, whatever the order of its rows (one small aggregate)."""
    rows, total = cities.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*cities.columns).cast("decimal(38,0)"))).first()
    return f"{rows}:{total}"


def _laid_out(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    return df.hint("rebalance", *by).sortWithinPartitions(*by, *order)


def _by_day(df: DataFrame, readings: DataFrame) -> DataFrame:
    """Rows by day, sorted by city. A table that is stored by day is scanned by day: no shuffle then."""
    df = df.withColumn(PARTITION_COL, F.to_date("reading_at"))
    if PARTITION_COL in readings.columns:
        return df.sortWithinPartitions(PARTITION_COL, "city_name", "reading_at")
    return _laid_out(df, [PARTITION_COL], ["city_name", "reading_at"])


def mart(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A published mart, as it stands now."""
    return read_published(spark, mart_path(base, name))


def state(spark: SparkSession, base: str, as_of: datetime | None = None) -> dict[str, DataFrame]:
    """The daily state; with ``as_of`` only the days of a baseline's window are listed."""
    return daily_state.read_state(spark, state_path(base), as_of and daily_state.window_start(as_of))
