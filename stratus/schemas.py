"""Table and message schemas (Spark types for the reference's DDL and payloads)."""

from pyspark.sql import types as T

CITIES = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("country_code", T.StringType(), False),
    T.StructField("continent", T.StringType(), False),
    T.StructField("latitude", T.DecimalType(8, 5), False),
    T.StructField("longitude", T.DecimalType(8, 5), False),
    T.StructField("timezone", T.StringType(), False),
    T.StructField("population", T.IntegerType(), True),
])

READINGS = T.StructType([
    T.StructField("city_id", T.IntegerType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("temperature", T.DecimalType(5, 2), True),
    T.StructField("feels_like", T.DecimalType(5, 2), True),
    T.StructField("precipitation", T.DecimalType(6, 2), True),
    T.StructField("windspeed", T.DecimalType(5, 2), True),
    T.StructField("humidity", T.ShortType(), True),
    T.StructField("weather_code", T.ShortType(), True),
])
READING_KEY = ["city_id", "timestamp"]
READING_MEASURES = ["temperature", "feels_like", "precipitation", "windspeed",
                    "humidity", "weather_code"]

STREAMING_READINGS = T.StructType([
    T.StructField("city_id", T.IntegerType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("temperature", T.DecimalType(5, 2), True),
    T.StructField("windspeed", T.DecimalType(5, 2), True),
    T.StructField("weather_code", T.ShortType(), True),
])

PIPELINE_RUNS = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("run_id", T.StringType(), True),
    T.StructField("city_id", T.IntegerType(), True),
    T.StructField("rows_fetched", T.IntegerType(), True),
    T.StructField("rows_loaded", T.IntegerType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("duration_ms", T.IntegerType(), True),
    T.StructField("error_msg", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), True),
])
RUN_STATUSES = ["success", "partial", "failed"]

# Landed API document: a struct of parallel arrays, one element per hour.
HOURLY = T.StructType([
    T.StructField("time", T.ArrayType(T.StringType())),
    T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
    T.StructField("apparent_temperature", T.ArrayType(T.DoubleType())),
    T.StructField("precipitation", T.ArrayType(T.DoubleType())),
    T.StructField("windspeed_10m", T.ArrayType(T.DoubleType())),
    T.StructField("relative_humidity_2m", T.ArrayType(T.IntegerType())),
    T.StructField("weathercode", T.ArrayType(T.IntegerType())),
])
LANDING_PARTITIONS = ["city", "year", "month", "day", "hour"]
CORRUPT = "_corrupt"
LANDING = T.StructType(
    [T.StructField("hourly", HOURLY), T.StructField(CORRUPT, T.StringType())]
    + [T.StructField(p, T.StringType()) for p in LANDING_PARTITIONS])

# Stream message for one reading: the reference's 9 fields and the reading's time.
READING_MESSAGE = T.StructType([
    T.StructField("city_id", T.IntegerType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("continent", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("windspeed", T.DoubleType()),
    T.StructField("weather_code", T.IntegerType()),
    T.StructField("schema_version", T.StringType()),
    # the reading's own hour; ``timestamp`` is the moment of ingest
    T.StructField("reading_time", T.TimestampType()),
])
ALERT_FIELDS = ["alert_type", "z_score", "baseline_mean", "baseline_stddev", "severity"]
