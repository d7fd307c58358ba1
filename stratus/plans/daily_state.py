"""Daily state of the readings: partial aggregates by city and day that merge exactly.

Published tables, the first three partitioned by ``reading_date``:

* ``conditions``: staged readings by city, day and weather condition (sums in
  whole units, counts, least and greatest temperature). Summaries and trends are
  merged from it.
* ``temperatures``: readings by city, day and temperature, raw and staged. The
  quartiles come from it.
* ``moments``: count, sum and sum of squares of the raw temperatures by city
  and day, and the same of the staged ones.

* ``months``: the sums of ``conditions`` by city and month, partitioned by month.
  All-time comparisons merge a row a city and month.

A day's state is a function of the day's readings alone, so a load recomputes
the days it touched and a repeated load gives the same state. All numbers are
integers: what is merged from the state equals the aggregate over the readings
bit for bit.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions import exprs as X
from stratus.operators import joins
from stratus.operators.publish import publish, read_published, version
from stratus.operators.sinks import PARTITION_COL
from stratus.plans import staging

TABLES = ("conditions", "temperatures", "moments", "months")
MONTH = "month"


# -- partial aggregates --------------------------------------------------------

def by_condition(stg: DataFrame) -> DataFrame:
    """Staged readings by day, city and condition; hash aggregated, combined before the shuffle."""
    return (stg.groupBy(F.to_date("reading_at").alias(PARTITION_COL), "city_id", "weather_condition")
               .agg(*condition_sums()))


def condition_sums() -> list[Column]:
    return [F.sum(X.units_of("temperature_c", 2)).alias("t"), F.count("temperature_c").alias("tn"),
            F.min("temperature_c").alias("lo"), F.max("temperature_c").alias("hi"),
            F.sum(X.units_of("precipitation_mm", 2)).alias("p"),
            F.sum(X.units_of("windspeed_kmh", 2)).alias("w"), F.count("windspeed_kmh").alias("wn"),
            F.sum(X.units_of("humidity_pct", 1)).alias("h"), F.count("humidity_pct").alias("hn"),
            F.count(F.lit(1)).alias("n")]


def merged_sums() -> list[Column]:
    """The aggregates of :func:`condition_sums`, merged."""
    return [F.sum("t").alias("t"), F.sum("tn").alias("tn"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            F.sum("p").alias("p"), F.sum("w").alias("w"), F.sum("wn").alias("wn"),
            F.sum("h").alias("h"), F.sum("hn").alias("hn"), F.sum("n").alias("n")]


def by_temperature(readings: DataFrame) -> DataFrame:
    """Readings with a temperature by day, city and temperature: how many, and how many are staged."""
    t = F.col("temperature")
    keyed = readings.where(F.col("timestamp").isNotNull() & t.isNotNull())
    staged = F.col("city_id").isNotNull() & ~X.is_suspicious("temperature", "humidity")
    return (keyed.groupBy(F.to_date("timestamp").alias(PARTITION_COL), "city_id", X.units_of(t, 2).alias("u"))
                 .agg(F.count(F.lit(1)).alias("raw"), F.count_if(staged).alias("staged")))


def moments_of(temperatures: DataFrame) -> DataFrame:
    """Counts, sums and sums of squares by day and city from :func:`by_temperature`."""
    u = F.col("u")
    square = (u * u).cast("decimal(38,0)")
    return temperatures.groupBy(PARTITION_COL, "city_id").agg(
        *[x.alias(f"{kind}_{name}") for kind in ("raw", "staged") for name, x in (
            ("n", F.sum(kind)), ("s1", F.sum(u * F.col(kind))),
            ("s2", F.sum((square * F.col(kind)).cast("decimal(38,0)"))))])


def by_month(conditions: DataFrame) -> DataFrame:
    """The sums of :func:`by_condition` by month and city."""
    return conditions.groupBy(F.date_format(PARTITION_COL, "yyyy-MM").alias(MONTH), "city_id").agg(*merged_sums())


def month_span(months: list[str] | None) -> tuple[date | None, date | None]:
    """The first and the last day of ascending ``months``."""
    if not months:
        return None, None
    after = date.fromisoformat(f"{months[-1]}-01") + timedelta(days=31)
    return date.fromisoformat(f"{months[0]}-01"), after.replace(day=1) - timedelta(days=1)


def months_of(days: list[date] | None) -> list[str] | None:
    return None if days is None else sorted({f"{d:%Y-%m}" for d in days})


def conditions_of(spark: SparkSession, root: str, months: list[str] | None) -> DataFrame:
    """The stored conditions of ``months`` (default: all); only these days' folders are listed."""
    cells = read_state(spark, root, *month_span(months))["conditions"]
    return cells if months is None else cells.where(F.date_format(PARTITION_COL, "yyyy-MM").isin(months))


# -- the stored state ----------------------------------------------------------

def refresh(spark: SparkSession, readings: DataFrame, root: str, days: list[date] | None = None) -> None:
    """Build the state of ``days`` (default: all days) from the readings and publish it.

    Only the partitions of ``days`` are read, and only their state is written.
    """
    if days is not None:
        readings = readings.where(F.col(PARTITION_COL).isin(days) if PARTITION_COL in readings.columns
                                  else F.to_date("timestamp").isin(days))
    replaced = None if days is None else [d.isoformat() for d in days]
    _store(by_condition(staging.stg_readings(readings)), f"{root}/conditions", replaced)
    _store(by_temperature(readings), f"{root}/temperatures", replaced)
    # from the files just published: the readings are not read again
    cells = read_published(spark, f"{root}/temperatures", *((min(replaced), max(replaced)) if replaced else ()))
    if days is not None:
        cells = cells.where(F.col(PARTITION_COL).isin(days))
    _store(moments_of(cells), f"{root}/moments", replaced)
    months = months_of(days)
    sums = by_month(conditions_of(spark, root, months)).hint("rebalance", MONTH)
    publish(sums.sortWithinPartitions(MONTH, "city_id"), f"{root}/months", [MONTH], months)


def _store(rows: DataFrame, root: str, replaced: list[str] | None) -> None:
    publish(rows.hint("rebalance", PARTITION_COL).sortWithinPartitions(PARTITION_COL, "city_id"), root,
            [PARTITION_COL], replaced)


def read_state(spark: SparkSession, root: str, first: date | None = None,
               last: date | None = None) -> dict[str, DataFrame]:
    """The stored tables there are; with bounds only these days' (months') folders are listed."""
    bounds = [d and d.isoformat() for d in (first, last)]
    return {name: read_published(spark, f"{root}/{name}", *(b and b[:7] if name == "months" else b for b in bounds))
            for name in TABLES if version(spark, f"{root}/{name}")}


def window_start(as_of: datetime, days: int = X.BASELINE_DAYS) -> date:
    """The first day of a trailing window, as a bound for :func:`read_state`."""
    return (as_of - timedelta(days=days)).date()


# -- merging -------------------------------------------------------------------

def trailing(cells: DataFrame, of_readings: Callable[[DataFrame], DataFrame], readings: DataFrame | None,
             as_of: datetime, days: int = X.BASELINE_DAYS) -> DataFrame:
    """The state of the trailing ``days``: readings from ``as_of - days`` on, this instant included.

    Whole days come from the state. Where the window begins within a day, that
    one day comes from its ``readings``, reduced by ``of_readings``.
    """
    start = as_of - timedelta(days=days)
    first = start.date()
    if start == datetime.combine(first, datetime.min.time()):
        return cells.where(F.col(PARTITION_COL) >= F.lit(first))
    if readings is None:
        raise ValueError(f"the window begins within {first}: its readings are needed")
    rest = readings.where((F.col("timestamp") >= X.ts_literal(start))
                          & (F.col("timestamp") < X.ts_literal(datetime.combine(first, datetime.min.time())
                                                               + timedelta(days=1))))
    if PARTITION_COL in readings.columns:
        rest = rest.where(F.col(PARTITION_COL) == F.lit(first))
    return cells.where(F.col(PARTITION_COL) > F.lit(first)).unionByName(of_readings(rest))


def raw_baseline(state: dict[str, DataFrame], as_of: datetime, cities: DataFrame | None = None,
                 readings: DataFrame | None = None) -> DataFrame:
    """A15 from the state: mean and sample stddev of a city's raw temperatures of the trailing 30 days.

    Merges one row a city and day. The columns and values are those of
    :func:`stratus.streaming.jobs.raw_baseline` over the readings.
    """
    window = trailing(state["moments"], lambda r: moments_of(by_temperature(r)), readings, as_of)
    n = F.sum("raw_n")
    out = (window.where(F.col("raw_n") > 0).groupBy("city_id")
                 .agg(X.mean_of(F.sum("raw_s1"), n).alias("mean_temp"),
                      X.rounded_mean(F.sum("raw_s1"), n, 2, 7).cast("double").alias("mean_temp_2dp"),
                      X.stddev_of(F.sum("raw_s1"), F.sum("raw_s2"), n).alias("stddev_temp"), n.alias("n"))
                 .where(F.col("n") >= X.MIN_BASELINE_SAMPLES).drop("n"))
    if cities is not None:
        out = out.join(joins.bounded(cities.select(F.col("id").alias("city_id"))), "city_id")
    return out


def staged_counts(state: dict[str, DataFrame], as_of: datetime, readings: DataFrame | None = None) -> DataFrame:
    """Staged readings of the trailing 30 days by city and temperature (city_id, u, c)."""
    window = trailing(state["temperatures"], by_temperature, readings, as_of)
    return (window.where(F.col("staged") > 0).groupBy("city_id", "u")
                  .agg(F.sum("staged").alias("c")))
