"""Dashboard queries D1-D22 over the marts, the readings table and the run log.

Single-value panels are global aggregates (one partial aggregate per task,
one tiny final merge). "Latest"/top-k panels use ``orderBy().limit(k)``,
which Spark plans as TakeOrderedAndProject — per-partition top-k, no global
sort — with a total tie-break appended so the answer is deterministic.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import exprs as X
from stratus.operators.ordering import asc_nulls_last, desc_nulls_first, latest, top_k

# ----------------------------------------------------------- global view ---


def city_map(m5: DataFrame, ordered: bool = True) -> DataFrame:
    """City, coordinates and average temperature, by name."""
    out = m5.select("city_name", "latitude", "longitude", "avg_temp_c")
    return out.orderBy(asc_nulls_last("city_name")) if ordered else out


def city_ranking(m5: DataFrame, ordered: bool = True) -> DataFrame:
    """Cities ranked by average temperature (NULL averages first)."""
    out = m5.select("city_name", "country", "region", "avg_temp_c", "min_temp_c",
                    "max_temp_c", "avg_humidity_pct", "avg_windspeed_kmh")
    return out.orderBy(desc_nulls_first("avg_temp_c")) if ordered else out


def total_readings(readings: DataFrame) -> DataFrame:
    """Number of rows in the readings table."""
    return readings.agg(F.count(F.lit(1)).alias("total_readings"))


# ------------------------------------------------------ pipeline health ---


def last_run_rows(runs: DataFrame) -> DataFrame:
    """Rows loaded by the latest run (ties: highest id)."""
    return latest(runs, desc_nulls_first("created_at"), F.col("id").desc()).select(
        "rows_loaded")


def run_count(runs: DataFrame) -> DataFrame:
    """Number of runs."""
    return runs.agg(F.count(F.lit(1)).alias("total_runs"))


def active_cities(readings: DataFrame, as_of: datetime, window: str = "2 hours") -> DataFrame:
    """Distinct cities with a reading later than ``as_of - 2 hours``."""
    return (X.recent(readings, "timestamp", as_of, window)
                    .agg(F.count_distinct("city_id").alias("cities_active")))


def recent_runs(runs: DataFrame, k: int = 20) -> DataFrame:
    """The last ``k`` runs."""
    return top_k(runs, k, desc_nulls_first("created_at"), F.col("id").desc()).select(
        "run_id", "rows_fetched", "rows_loaded", "status", "created_at")


# ----------------------------------------------------- anomaly tracker ---


def _last_day(m6: DataFrame, as_of: datetime) -> DataFrame:
    return X.recent(m6, "reading_at", as_of, "24 hours", ntz=True)


def anomalies_24h(m6: DataFrame, as_of: datetime) -> DataFrame:
    """Anomalous readings in the last 24 hours."""
    return (_last_day(m6, as_of).where(F.col("is_anomaly"))
            .agg(F.count(F.lit(1)).alias("anomalies_24h")))


def max_abs_z(m6: DataFrame, as_of: datetime) -> DataFrame:
    """Largest |z| in the last 24 hours, rounded to 2 places.

    z is already rounded to 3 places, so the second rounding is done on the
    exact decimal (2.175 -> 2.18), not on its binary approximation.
    """
    return _last_day(m6, as_of).agg(
        F.round(F.max(F.abs("z_score")).cast("decimal(12,3)"), 2).alias("max_z_score"))


def extremes_24h(m6: DataFrame, as_of: datetime) -> DataFrame:
    """Extreme anomalies in the last 24 hours."""
    return (_last_day(m6, as_of).where(F.col("anomaly_severity") == "extreme")
            .agg(F.count(F.lit(1)).alias("extreme_count")))


def cities_flagged(m6: DataFrame, as_of: datetime) -> DataFrame:
    """Distinct cities with an anomaly in the last 24 hours."""
    return (_last_day(m6, as_of).where(F.col("is_anomaly"))
            .agg(F.count_distinct("city_name").alias("cities_flagged")))


def top_anomalies(m6: DataFrame, k: int = 25) -> DataFrame:
    """The ``k`` anomalies with the largest |z|."""
    a = m6.where(F.col("is_anomaly"))
    return top_k(a, k, F.abs("z_score").desc_nulls_first(), asc_nulls_last("city_name"),
                 asc_nulls_last("reading_at")).select(
        "city_name", "reading_at", "temperature_c", F.round("z_score", 3).alias("z_score"),
        "anomaly_severity")


def anomalous_cities(m6: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` cities with the most anomalies."""
    counts = (m6.where(F.col("is_anomaly")).groupBy("city_name")
                .agg(F.count(F.lit(1)).alias("anomaly_count")))
    return top_k(counts, k, desc_nulls_first("anomaly_count"), asc_nulls_last("city_name"))


def recent_events(m7: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most recent extreme-weather events."""
    return top_k(m7, k, desc_nulls_first("reading_at"), asc_nulls_last("city_name"),
                 asc_nulls_last("event_type")).select(
        "city_name", "country", "reading_at", "temperature_c", "windspeed_kmh",
        "precipitation_mm", "event_type")


# ------------------------------------------------------ city deep dive ---


# Buckets of a daily summary that is stored by city.
CITY_BUCKET, CITY_BUCKETS = "city_bucket", 16


def city_bucket(name: Column) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(CITY_BUCKETS)).cast("int")


def _city(m3: DataFrame, city: str) -> DataFrame:
    """Rows of one city (a bound parameter, never spliced into SQL text).

    On a summary stored by city buckets only the city's own bucket is read.
    """
    rows = m3.where(F.col("city_name") == F.lit(city))
    return rows.where(F.col(CITY_BUCKET) == city_bucket(F.lit(city))) if CITY_BUCKET in m3.columns else rows


def _latest_day(m3: DataFrame, city: str) -> DataFrame:
    return latest(_city(m3, city), desc_nulls_first("date"), asc_nulls_last("country"),
                  asc_nulls_last("continent"), asc_nulls_last("region"))


def city_series(m3: DataFrame, city: str, ordered: bool = True) -> DataFrame:
    """One city's daily min/avg/max series."""
    out = _city(m3, city).select(F.col("date").alias("time"), "avg_temp_c", "min_temp_c",
                                 "max_temp_c")
    return out.orderBy(asc_nulls_last("time")) if ordered else out


def city_rain(m3: DataFrame, city: str, k: int = 30) -> DataFrame:
    """One city's precipitation on its latest ``k`` days with data."""
    return top_k(_city(m3, city), k, desc_nulls_first("date"), asc_nulls_last("country"),
                 asc_nulls_last("continent"), asc_nulls_last("region")).select(
        F.col("date").cast("string").alias("date"), "total_precip_mm")


def city_condition(m3: DataFrame, city: str) -> DataFrame:
    """One city's latest dominant condition."""
    return _latest_day(m3, city).select("dominant_condition")


def city_humidity(m3: DataFrame, city: str) -> DataFrame:
    """One city's latest average humidity, rounded to 1 place."""
    return _latest_day(m3, city).select(F.round("avg_humidity_pct", 1).alias("humidity"))


def city_temp(m3: DataFrame, city: str) -> DataFrame:
    """One city's latest average temperature."""
    return _latest_day(m3, city).select("avg_temp_c")


def city_wind(m3: DataFrame, city: str) -> DataFrame:
    """One city's latest average wind speed."""
    return _latest_day(m3, city).select("avg_windspeed_kmh")


def city_names(m3: DataFrame, ordered: bool = True) -> DataFrame:
    """The city picker — distinct names (A14), sorted."""
    out = m3.select("city_name").distinct()
    return out.orderBy(asc_nulls_last("city_name")) if ordered else out
