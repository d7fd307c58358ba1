"""Marts M3-M7: each returns a lazy DataFrame over the staged readings.

Plan shape: the staged scan feeds a broadcast hash join against the (size
checked) city dimension, then a two-phase hash aggregate, so the only shuffle
carries per-partition partial aggregates, never raw readings. Marts are
unordered tables; ``ordered=True`` applies the model's ORDER BY for callers
that read them directly.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions import exprs as X
from stratus.operators import joins
from stratus.operators.ordering import asc_nulls_last, desc_nulls_first
from stratus.plans import daily_state

# Readings a city needs before its baseline is trusted (A9), and the days it spans.
MIN_BASELINE_SAMPLES = X.MIN_BASELINE_SAMPLES
BASELINE_WINDOW = f"{X.BASELINE_DAYS} days"


def daily_summary(stg: DataFrame, cities: DataFrame, ordered: bool = False) -> DataFrame:
    """M3: one row per city name/country/continent/region and calendar day."""
    base = joins.with_city(
        stg.select("city_id", "reading_at", "temperature_c", "precipitation_mm",
                   "windspeed_kmh", "humidity_pct", "weather_condition"),
        cities,
        [F.col("name").alias("city_name"), "country", "continent", "region"])
    keys = ["city_name", "country", "continent", "region", "date"]
    # sums by condition first (hash aggregate over the readings), then the few conditions of a day
    sums = (base.groupBy(*keys[:4], F.to_date("reading_at").alias("date"), "weather_condition")
                .agg(*daily_state.condition_sums()))
    out = _summed_up(sums, keys)
    if ordered:
        out = out.orderBy(F.col("date").desc_nulls_first(), asc_nulls_last("city_name"))
    return out


def daily_summary_of(conditions: DataFrame, cities: DataFrame) -> DataFrame:
    """M3 merged from the daily state (``daily_state.by_condition``): no reading is read."""
    keys = ["city_name", "country", "continent", "region", "date"]
    base = joins.with_city(conditions.withColumnRenamed("reading_date", "date"), cities,
                           [F.col("name").alias("city_name"), "country", "continent", "region"])
    return _summed_up(base.groupBy(*keys, "weather_condition").agg(*daily_state.merged_sums()), keys)


def _summed_up(sums: DataFrame, keys: list[str]) -> DataFrame:
    """The finish of M3: the sums of a day's conditions, and its most frequent one."""
    most = F.min(F.when(F.col("weather_condition").isNotNull(),
                        F.struct((-F.col("n")).alias("n"), "weather_condition")))
    return (sums.groupBy(*keys)
           .agg(X.rounded_mean(F.sum("t"), F.sum("tn"), 2, 5).alias("avg_temp_c"),
                F.min("lo").alias("min_temp_c"),
                F.max("hi").alias("max_temp_c"),
                (F.sum("p").cast("decimal(38,0)") / F.lit(100)).cast("decimal(38,2)")
                .alias("total_precip_mm"),
                X.rounded_mean(F.sum("w"), F.sum("wn"), 2, 5).alias("avg_windspeed_kmh"),
                X.rounded_mean(F.sum("h"), F.sum("hn"), 1, 4).alias("avg_humidity_pct"),
                most["weather_condition"].alias("dominant_condition"),
                F.sum("n").alias("reading_count")))


def weekly_trends(stg: DataFrame, cities: DataFrame, ordered: bool = False) -> DataFrame:
    """M4: daily mean temperature per city and its 7-row trailing mean.

    The window runs over the daily aggregate (cities x days rows), never over
    raw readings, so a city holding a third of all readings still contributes
    only one row per day to its window partition.
    """
    base = joins.with_city(
        stg.where(F.col("temperature_c").isNotNull())
           .select("city_id", "reading_at", "temperature_c"),
        cities,
        [F.col("name").alias("city_name"), "continent", "region"])
    units, n = F.sum(X.units_of("temperature_c", 2)), F.count("temperature_c")
    daily = (base
             .groupBy("city_id", "city_name", "continent", "region",
                      F.date_trunc("day", "reading_at").alias("day"))
             .agg(X.rounded_mean(units, n, 2, 5).alias("daily_avg_temp_c"),
                  X.wide_mean(units, n).alias("__daily_mean")))
    out = _rolling_week(daily)
    if ordered:
        out = out.orderBy(asc_nulls_last("city_name"), F.col("day").desc_nulls_first())
    return out


def weekly_trends_of(conditions: DataFrame, cities: DataFrame) -> DataFrame:
    """M4 merged from the daily state."""
    days = (conditions.where(F.col("tn") > 0).groupBy("city_id", "reading_date")
                      .agg(F.sum("t").alias("t"), F.sum("tn").alias("tn")))
    base = joins.with_city(days, cities, [F.col("name").alias("city_name"), "continent", "region"])
    units, n = F.col("t"), F.col("tn")
    return _rolling_week(base.select(
        "city_id", "city_name", "continent", "region",
        F.date_trunc("day", F.col("reading_date").cast("timestamp_ntz")).alias("day"),
        X.rounded_mean(units, n, 2, 5).alias("daily_avg_temp_c"), X.wide_mean(units, n).alias("__daily_mean")))


def _rolling_week(daily: DataFrame) -> DataFrame:
    return rolling_mean(daily, "city_id", "day", "__daily_mean", rows=7,
                        alias="temp_7day_rolling_avg").drop("__daily_mean")


def rolling_mean(df: DataFrame, part: str, order: str, value: str, rows: int,
                 alias: str) -> DataFrame:
    """Mean over the current row and the ``rows - 1`` rows before it in ``order``, to 2 places.

    ``value`` is a whole number of 10^-16 (:func:`exprs.wide_mean`); the frame's
    sum is divided and rounded once, half away from zero, so ties come out as
    in decimal arithmetic. A ROWS frame: gaps in the ordering stretch the span;
    short histories use what exists, so the result is never NULL where
    ``value`` is not.
    """
    w = Window.partitionBy(part).orderBy(order).rowsBetween(-(rows - 1), Window.currentRow)
    out = (df.withColumn("__sum", F.sum(F.col(value).cast("decimal(28,0)")).over(w))
             .withColumn("__count", F.count(value).over(w)))
    return (out.withColumn(alias, X.rounded_mean(F.col("__sum"), F.col("__count"), 2, 7,
                                                 X.MEAN_DIGITS))
               .drop("__sum", "__count"))


def city_comparisons(stg: DataFrame, cities: DataFrame, ordered: bool = False) -> DataFrame:
    """M5: all-time statistics per city name/country/continent/region/coordinates."""
    base = joins.with_city(
        stg.select("city_id", "temperature_c", "windspeed_kmh", "humidity_pct",
                   "precipitation_mm"),
        cities,
        [F.col("name").alias("city_name"), "country", "continent", "region",
         "latitude", "longitude"])
    out = (base
           .groupBy("city_name", "country", "continent", "region", "latitude", "longitude")
           .agg(X.exact_avg("temperature_c", 2, 5).alias("avg_temp_c"),
                F.min("temperature_c").alias("min_temp_c"),
                F.max("temperature_c").alias("max_temp_c"),
                X.exact_avg("windspeed_kmh", 2, 5).alias("avg_windspeed_kmh"),
                X.exact_avg("humidity_pct", 1, 4).alias("avg_humidity_pct"),
                X.exact_sum("precipitation_mm", 2).alias("total_precip_mm"),
                F.count(F.lit(1)).alias("total_readings")))
    if ordered:
        out = out.orderBy(desc_nulls_first("avg_temp_c"))
    return out


def city_comparisons_of(sums: DataFrame, cities: DataFrame) -> DataFrame:
    """M5 merged from the daily state: its sums by day and condition, or those by month."""
    place = ["city_name", "country", "continent", "region", "latitude", "longitude"]
    totals = sums.groupBy("city_id").agg(*daily_state.merged_sums())
    base = joins.with_city(totals, cities, [F.col("name").alias("city_name"), *place[1:]])
    return base.groupBy(*place).agg(
        X.rounded_mean(F.sum("t"), F.sum("tn"), 2, 5).alias("avg_temp_c"),
        F.min("lo").alias("min_temp_c"), F.max("hi").alias("max_temp_c"),
        X.rounded_mean(F.sum("w"), F.sum("wn"), 2, 5).alias("avg_windspeed_kmh"),
        X.rounded_mean(F.sum("h"), F.sum("hn"), 1, 4).alias("avg_humidity_pct"),
        (F.sum("p").cast("decimal(38,0)") / F.lit(100)).cast("decimal(38,2)").alias("total_precip_mm"),
        F.sum("n").alias("total_readings"))


def robust_stats(stg: DataFrame, as_of: datetime,
                 min_samples: int = MIN_BASELINE_SAMPLES) -> DataFrame:
    """Per-city mean, sample stddev, p25, p75 and count over the trailing 30 days.

    Readings are counted by city and temperature first (a hash aggregate,
    combined map-side); moments and percentiles come from that table, at most
    15,001 rows per city (the staged range in steps of 0.01).
    """
    recent = X.recent(stg, "reading_at", as_of, BASELINE_WINDOW, inclusive=True, ntz=True)
    # one row per city and distinct temperature: a hot city is spread over its values
    counts = (recent.where(F.col("temperature_c").isNotNull())
                    .groupBy("city_id", X.units_of("temperature_c", 2).alias("u"))
                    .agg(F.count(F.lit(1)).alias("c")))
    return robust_stats_of(counts, min_samples)


def robust_stats_of(counts: DataFrame, min_samples: int = MIN_BASELINE_SAMPLES) -> DataFrame:
    """A16 from counts by city and temperature (city_id, u in hundredths, c)."""
    city = Window.partitionBy("city_id")
    upto = F.sum("c").over(city.orderBy("u").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("upto", upto).withColumn("n", F.sum("c").over(city))
    u, c = F.col("u"), F.col("c")
    return (ranked.groupBy("city_id")
                  .agg(X.mean_of(F.sum(u * c), F.first("n")).alias("mean_temp"),
                       X.stddev_of(F.sum(u * c), F.sum((u * u * c).cast("decimal(38,0)")),
                                   F.first("n")).alias("stddev_temp"),
                       ranked_percentile(0.25).alias("p25"),
                       ranked_percentile(0.75).alias("p75"),
                       F.first("n").alias("sample_size"))
                  .where(F.col("sample_size") >= min_samples))         # A9


def ranked_percentile(p: float, scale: int = 2):
    """``PERCENTILE_CONT(p)`` over counted values: columns u, upto (running count), n.

    Interpolates between the values at the positions around (n - 1) p, in
    whole units of 10^-scale: for quartiles the fraction is a multiple of 1/4,
    so the result is exact in double before the one division by 10^scale.
    """
    place = (F.col("n") - 1) * F.lit(p)
    low = F.min(F.when(F.col("upto") > F.floor(place), F.col("u")))
    high = F.min(F.when(F.col("upto") > F.ceil(place), F.col("u")))
    part = F.first(place - F.floor(place))
    return (low + part * (high - low)) / float(10 ** scale)


def temperature_anomalies(stg: DataFrame, cities: DataFrame, as_of: datetime,
                          ordered: bool = False, stats: DataFrame | None = None) -> DataFrame:
    """M6: every staged reading scored against its city's fixed 30-day baseline.

    J2: the per-city stats are joined to the dimension first; the result has at
    most one row per city, so it is broadcast into the (unshuffled) scan of
    all readings exactly when the dimension passes the size check. ``stats``
    are the cities' statistics, where the daily state has them already.
    """
    stats = robust_stats(stg, as_of) if stats is None else stats
    dim = cities.select(
        F.col("id").alias("__city_key"), F.col("name").alias("city_name"),
        "country", "continent", "region")
    small = joins.fits_broadcast(dim)
    dim = (F.broadcast(dim) if small else dim).join(
        stats, F.col("__city_key") == stats.city_id).drop("city_id")
    dim = F.broadcast(dim) if small else dim          # at most one row per city
    r = stg.where(F.col("temperature_c").isNotNull()).select(
        "city_id", "reading_at", "temperature_c", "weather_condition")
    j = r.join(dim, F.col("city_id") == F.col("__city_key"))
    z = X.z_score("temperature_c", "mean_temp", "stddev_temp")
    out = j.select(
        "city_id", "city_name", "country", "continent", "region", "reading_at",
        "temperature_c", "weather_condition", "mean_temp", "stddev_temp", "sample_size",
        F.round(z, 3).alias("z_score"),
        F.round(X.iqr_score("temperature_c", "mean_temp", "p25", "p75"), 3)
         .alias("robust_z_score"),
        X.severity(z).alias("anomaly_severity"),
        X.is_anomaly(z).alias("is_anomaly"))
    if ordered:
        out = out.orderBy(F.abs("z_score").desc_nulls_last())
    return out


def extreme_weather(stg: DataFrame, cities: DataFrame, ordered: bool = False) -> DataFrame:
    """M7: readings passing the extreme-event predicate (P10), labelled by priority.

    The predicate runs before the join, inside the scan stage.
    """
    ev = stg.where(X.is_extreme_event("temperature_c", "windspeed_kmh", "precipitation_mm",
                                      "weather_condition"))
    base = joins.with_city(
        ev.select("city_id", "reading_at", "temperature_c", "windspeed_kmh",
                  "precipitation_mm", "weather_condition"),
        cities, [F.col("name").alias("city_name"), "country", "continent"])
    out = base.select(
        "city_name", "country", "continent", "reading_at", "temperature_c", "windspeed_kmh",
        "precipitation_mm", "weather_condition",
        X.event_type("temperature_c", "windspeed_kmh", "precipitation_mm",
                     "weather_condition").alias("event_type"))
    if ordered:
        out = out.orderBy(F.col("reading_at").desc_nulls_first())
    return out
