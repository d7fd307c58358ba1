"""Staging models: typed, validated readings (M1) and the city dimension (M2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions import exprs as X


def cleaned_readings(readings: DataFrame) -> DataFrame:
    """Validated readings with the suspicious flag still present (before P8)."""
    r = readings.where(F.col("timestamp").isNotNull() & F.col("city_id").isNotNull())  # P7
    return r.select(
        "city_id",
        F.col("timestamp").cast("timestamp_ntz").alias("reading_at"),
        X.in_range_or_null("temperature", X.TEMP_MIN, X.TEMP_MAX)
         .cast("decimal(5,2)").alias("temperature_c"),
        X.in_range_or_null("feels_like", X.TEMP_MIN, X.TEMP_MAX)
         .cast("decimal(5,2)").alias("feels_like_c"),
        X.c_to_f("temperature").alias("temperature_f"),
        X.at_least_or_null("precipitation", 0).cast("decimal(6,2)").alias("precipitation_mm"),
        X.at_least_or_null("windspeed", 0).cast("decimal(5,2)").alias("windspeed_kmh"),
        X.in_range_or_null("humidity", X.HUMIDITY_MIN, X.HUMIDITY_MAX).alias("humidity_pct"),
        "weather_code",
        X.weather_label("weather_code").alias("weather_condition"),
        X.is_suspicious("temperature", "humidity").alias("is_suspicious"),
        *[c for c in ("reading_date",) if c in readings.columns],
    )


def stg_readings(readings: DataFrame) -> DataFrame:
    """M1: staged readings — P7 null keys out, P2-P6 validation, P8 suspicious rows out.

    A narrow projection over the raw table: Catalyst prunes the scan to the
    eight raw columns and pushes the key filter into the Parquet reader.
    """
    return cleaned_readings(readings).where(~F.col("is_suspicious"))


def stg_cities(cities: DataFrame) -> DataFrame:
    """M2: the city dimension plus its region."""
    return cities.withColumn("region", X.region_of("continent"))
