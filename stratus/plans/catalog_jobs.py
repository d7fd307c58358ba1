"""Registered queries of the stored state, of rebuilds by touched days, of orders and of the smaller sources.

Registers into :data:`stratus.plans.catalog.REGISTRY`.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stratus import oracles as O
from stratus.functions import exprs as X
from stratus.operators import joins, ordering, quality, sinks
from stratus.plans import daily_state, scenarios, staging, warehouse
from stratus.plans.catalog import (_ALERTS, _BASELINE, _LOST, _RC, _REV, AS_OF_BASELINE, AS_OF_RECENT, M3_SPEC,
                                   M5_SPEC, M6_SPEC, M7_SPEC, MART_OF, edge, inputs, mart, register)
from stratus.sources import bindings, landing
from stratus.sources.tables import cities_in_order, read_cities
from stratus.streaming import jobs

# ------------------------------------------------------------ daily state ---

_U = "CAST({} * 100 AS HUGEINT)"


def _moments(kind: str, value: str, source: str, day: str) -> str:
    u = _U.format(value)
    return f"""
{kind} AS (SELECT CAST({day} AS DATE) AS reading_date, city_id, COUNT(*) AS n, SUM({u}) AS s1, SUM({u} * {u}) AS s2
FROM {source} WHERE {value} IS NOT NULL AND {day} IS NOT NULL GROUP BY ALL)"""


@register("w1_state_moments", O.with_models("""
SELECT a.reading_date, CAST(a.city_id AS BIGINT) AS city_id, a.n AS raw_n, CAST(a.s1 AS BIGINT) AS raw_s1,
       CAST(a.s2 AS DOUBLE) AS raw_s2, COALESCE(b.n, 0) AS staged_n, CAST(COALESCE(b.s1, 0) AS BIGINT) AS staged_s1,
       CAST(COALESCE(b.s2, 0) AS DOUBLE) AS staged_s2
FROM raw a LEFT JOIN valid b ON a.reading_date = b.reading_date AND a.city_id = b.city_id""",
    _moments("raw", "temperature", "readings", "timestamp"),
    _moments("valid", "temperature_c", "stg", "reading_at")))
def q_w1_moments(spark, sf_dir):
    root = scenarios.scratch_dir(spark, "state")
    daily_state.refresh(spark, bindings.readings(spark, sf_dir), root)
    return daily_state.read_state(spark, root)["moments"]


@register("w1_state_conditions", O.sql("""
SELECT CAST(reading_at AS DATE) AS reading_date, CAST(city_id AS BIGINT) AS city_id, weather_condition,
       CAST(SUM(CAST(temperature_c * 100 AS BIGINT)) AS BIGINT) AS t, COUNT(temperature_c) AS tn,
       CAST(MIN(temperature_c) AS DOUBLE) AS lo, CAST(MAX(temperature_c) AS DOUBLE) AS hi,
       CAST(SUM(CAST(precipitation_mm * 100 AS BIGINT)) AS BIGINT) AS p,
       CAST(SUM(CAST(windspeed_kmh * 100 AS BIGINT)) AS BIGINT) AS w, COUNT(windspeed_kmh) AS wn,
       CAST(SUM(humidity_pct * 10) AS BIGINT) AS h, COUNT(humidity_pct) AS hn, COUNT(*) AS n
FROM stg GROUP BY ALL"""))
def q_w1_conditions(spark, sf_dir):
    root = scenarios.scratch_dir(spark, "state")
    daily_state.refresh(spark, bindings.readings(spark, sf_dir), root)
    return daily_state.read_state(spark, root)["conditions"]


@register("k7_marts_build", O.sql(" UNION ALL ".join(
    f"SELECT '{name}' AS mart, COUNT(*) AS n FROM {model}" for model, name in MART_OF.items()), *MART_OF))
def q_k7_marts(spark, sf_dir):
    """The daily state and all five marts, built and published from scratch."""
    base = scenarios.scratch_dir(spark, "warehouse")
    raw, _, cities = inputs(spark, sf_dir)
    warehouse.refresh(spark, base, raw, cities, AS_OF_BASELINE)
    return quality.union_all([warehouse.mart(spark, base, name).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("mart"), "n") for name in warehouse.MARTS])


# ----------------------------------------------- rebuilds by touched days ---

# The readings table after both loads, as k2 states it.
_LOADED = ("loaded", f"""
SELECT r.city_id, r.timestamp,
       CASE WHEN r.timestamp >= {_REV} THEN r.temperature ELSE CAST(r.temperature + 1 AS DECIMAL(5,2)) END
         AS temperature, r.feels_like, r.precipitation, r.windspeed, r.humidity, r.weather_code
{_RC} WHERE r.timestamp >= {_REV} OR NOT {_LOST}""")
_LOADED_AS_OF = f"TIMESTAMP '{scenarios.LOAD_TIME:%Y-%m-%d %H:%M:%S}'"


def _after_two_loads(spark, sf_dir, name):
    base = scenarios.scratch_dir(spark, "warehouse")
    scenarios.two_loads(spark, sf_dir, base, (name,))
    return warehouse.mart(spark, base, name)


@register("k7_daily_summary_by_load", O.with_models(O.norm("m3", M3_SPEC), O.MODELS["m3"](), source=_LOADED))
def q_k7_summary(spark, sf_dir):
    return _after_two_loads(spark, sf_dir, "daily_summary").drop(warehouse.MONTH, warehouse.CITY_BUCKET)


@register("k7_comparisons_by_load", O.with_models(O.norm("m5", M5_SPEC), O.MODELS["m5"](), source=_LOADED))
def q_k7_comparisons(spark, sf_dir):
    return _after_two_loads(spark, sf_dir, "city_comparisons")


@register("k7_anomalies_by_load", O.with_models(O.norm("m6", M6_SPEC), O.MODELS["m6"](_LOADED_AS_OF), source=_LOADED))
def q_k7_anomalies(spark, sf_dir):
    return _after_two_loads(spark, sf_dir, "temperature_anomalies").drop("reading_date")


@register("k7_events_by_load", O.with_models(O.norm("m7", M7_SPEC), O.MODELS["m7"](), source=_LOADED))
def q_k7_events(spark, sf_dir):
    return _after_two_loads(spark, sf_dir, "extreme_weather").drop("reading_date")


# -------------------------------------------------------------- streaming ---

# Each reading once: the first delivery's, and of the second what arrived broken in the first.
_MSGS_ONCE = f"""
msgs AS (
  SELECT r.city_id, c.name AS city_name, c.country, c.continent, r.timestamp,
         CAST(CASE WHEN r.weather_code = {scenarios.BROKEN_CODE} THEN r.temperature + 1 ELSE r.temperature END
              AS DOUBLE) AS temperature,
         CAST(r.windspeed AS DOUBLE) AS windspeed, CAST(r.weather_code AS INTEGER) AS weather_code,
         '1.0' AS schema_version, r.timestamp AS reading_time
  {_RC} WHERE r.weather_code <> {scenarios.BROKEN_CODE} OR r.timestamp >= {_REV}
)"""


@register("t3_stream_alerts_once", O.with_models(_ALERTS, _BASELINE, _MSGS_ONCE))
def q_t3_once(spark, sf_dir):
    return spark.read.parquet(scenarios.stream_alerts_once(spark, sf_dir, AS_OF_BASELINE)).drop("batch_id")


@register("t5_cadence_stream", O.sql(f"""
SELECT CAST(r.city_id AS BIGINT) AS city_id, r.timestamp, CAST(r.temperature AS DOUBLE) AS temperature,
       CAST(r.windspeed AS DOUBLE) AS windspeed, CAST(r.weather_code AS BIGINT) AS weather_code,
       CAST(r.timestamp AS DATE) AS reading_date
{_RC} WHERE r.weather_code <> {scenarios.BROKEN_CODE}"""))
def q_t5(spark, sf_dir):
    """The first delivery at a fixed cadence, a bounded number of files each time."""
    return spark.read.parquet(scenarios.stream_at_cadence(spark, sf_dir))


@register("q05_freshness_check", O.sql(f"""
SELECT COUNT(*) AS recent_count, COUNT(DISTINCT city_id) AS city_count, MAX(timestamp) AS latest_timestamp
FROM readings WHERE timestamp > {O.AS_OF_RECENT} - INTERVAL '10 minutes'"""))
def q_q05_check(spark, sf_dir):
    """Q5: the monitor that raises where nothing has arrived; here its summary."""
    found = quality.check_freshness(bindings.streaming_readings(spark, sf_dir), AS_OF_RECENT)
    return spark.createDataFrame([tuple(found.values())],
                                 "recent_count long, city_count long, latest_timestamp timestamp")


@register("t8_late_stream", O.sql(f"""
SELECT CAST(r.city_id AS BIGINT) AS city_id, r.timestamp,
       CAST(CASE WHEN r.timestamp >= {_REV} THEN r.temperature + 1 ELSE r.temperature END AS DOUBLE) AS temperature,
       CAST(r.windspeed AS DOUBLE) AS windspeed, CAST(r.weather_code AS BIGINT) AS weather_code,
       CAST(r.timestamp AS DATE) AS reading_date
{_RC} WHERE r.timestamp >= {_REV} OR r.weather_code <> {scenarios.BROKEN_CODE}"""))
def q_t8(spark, sf_dir):
    return spark.read.parquet(scenarios.stream_late(spark, sf_dir))


# ----------------------------------------------------------------- orders ---

def _rank_sql(select: str, order: str, source: str) -> str:
    return f"SELECT {select}, row_number() OVER (ORDER BY {order}) AS rank FROM {source}"


_PLACE = "country NULLS LAST, continent NULLS LAST, region NULLS LAST"
_KEY = "city_id NULLS LAST, timestamp NULLS LAST"
_READ = "CAST(city_id AS BIGINT) AS city_id, timestamp, CAST(temperature AS DOUBLE) AS temperature"


def _key_order():
    return ordering.asc_nulls_last("city_id"), ordering.asc_nulls_last("timestamp")


def _reading_ranks(spark, sf_dir, spec):
    rows = bindings.readings(spark, sf_dir).select("city_id", "timestamp", "temperature")
    return ordering.ranked(rows, "rank", spec, *_key_order())


@register("o1_daily_summary_order", O.sql(_rank_sql(
    "date, city_name, country, continent, region", f"date DESC NULLS FIRST, city_name NULLS LAST, {_PLACE}", "m3"), "m3"))
def q_o1(spark, sf_dir):
    rows = mart(spark, sf_dir, "m3").select("date", "city_name", "country", "continent", "region")
    return ordering.ranked(rows, "rank", ordering.desc_nulls_first("date"), *[
        ordering.asc_nulls_last(c) for c in ("city_name", "country", "continent", "region")])


@register("o2_abs_order", O.sql(_rank_sql(_READ, f"ABS(temperature) DESC NULLS LAST, {_KEY}", "readings")))
def q_o2(spark, sf_dir):
    return _reading_ranks(spark, sf_dir, F.abs("temperature").desc_nulls_last())


@register("o3_desc_order", O.sql(_rank_sql(_READ, f"temperature DESC NULLS FIRST, {_KEY}", "readings")))
def q_o3(spark, sf_dir):
    return _reading_ranks(spark, sf_dir, ordering.desc_nulls_first("temperature"))


@register("o4_asc_order", O.sql(_rank_sql(_READ, f"temperature ASC NULLS LAST, {_KEY}", "readings")))
def q_o4(spark, sf_dir):
    return _reading_ranks(spark, sf_dir, ordering.asc_nulls_last("temperature"))


# ------------------------------------------- sources, views, landed arrays ---

@register("s2_city_dimension", O.sql(
    "SELECT CAST(id AS BIGINT) AS id, name, country, continent, CAST(latitude AS DOUBLE) AS latitude, "
    "CAST(longitude AS DOUBLE) AS longitude, row_number() OVER (ORDER BY id) AS rank FROM cities"))
def q_s2(spark, sf_dir):
    path = scenarios.scratch_dir(spark, "cities-csv")
    bindings.cities(spark, sf_dir).write.option("header", "true").csv(path)
    columns = ["id", "name", "country", "continent", "latitude", "longitude"]
    return ordering.ranked(cities_in_order(read_cities(spark, path, "csv", columns)), "rank",
                           ordering.asc_nulls_last("id"))


@register("k8_staged_view", O.sql(
    "SELECT weather_condition, COUNT(*) AS readings, CAST(MAX(temperature_c) AS DOUBLE) AS hottest "
    "FROM stg GROUP BY weather_condition"))
def q_k8(spark, sf_dir):
    sinks.stage_view(staging.stg_readings(bindings.readings(spark, sf_dir)), "stg_weather_readings")
    return edge(spark.sql("SELECT weather_condition, COUNT(*) AS readings, MAX(temperature_c) AS hottest "
                          "FROM stg_weather_readings GROUP BY weather_condition"))


@register("f11_landing_keys", O.sql(f"""
SELECT DISTINCT 'city=' || lower(replace(c.name, ' ', '_')) || strftime(r.timestamp,
       '/year=%Y/month=%m/day=%d/hour=%H/data.json') AS landing_key {_RC}"""))
def q_f11(spark, sf_dir):
    rows = joins.with_city(bindings.readings(spark, sf_dir).select("city_id", "timestamp"),
                           bindings.cities(spark, sf_dir), [F.col("name").alias("city_name")])
    return rows.select(X.landing_key("city_name", "timestamp").alias("landing_key")).distinct()


_NO_HOURS = scenarios.CUT_CITY


@register("n2_short_arrays", O.sql(f"""
SELECT city, year, month, day, pos, time, CASE WHEN pos < n - 1 THEN temperature END AS temperature_2m,
       windspeed AS windspeed_10m
FROM (SELECT lower(replace(c.name, ' ', '_')) AS city, strftime(r.timestamp, '%Y') AS year,
             strftime(r.timestamp, '%m') AS month, strftime(r.timestamp, '%d') AS day,
             CAST(row_number() OVER (PARTITION BY r.city_id, date_trunc('hour', r.timestamp)
                                     ORDER BY r.timestamp) - 1 AS BIGINT) AS pos,
             COUNT(*) OVER (PARTITION BY r.city_id, date_trunc('hour', r.timestamp)) AS n,
             strftime(r.timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS time,
             CAST(r.temperature AS DOUBLE) AS temperature, CAST(r.windspeed AS DOUBLE) AS windspeed
      {_RC} WHERE r.city_id <> {_NO_HOURS})"""))
def q_n2(spark, sf_dir):
    """Temperature arrays one short; one city's documents without ``hourly``."""
    cities = bindings.cities(spark, sf_dir)
    docs = landing.landing_docs(bindings.readings(spark, sf_dir), cities, F.date_trunc("day", "timestamp"))
    short = F.col("hourly").withField("temperature_2m", F.slice(
        "hourly.temperature_2m", F.lit(1), F.greatest(F.size("hourly.temperature_2m") - 1, F.lit(0))))
    gone = cities.where(F.col("id") == _NO_HOURS).select(X.slug("name").alias("city"), F.lit(True).alias("gone"))
    docs = docs.withColumn("hourly", short).join(gone, "city", "left").withColumn(
        "hourly", F.when(F.col("gone").isNull(), F.col("hourly")))
    return landing.explode_hourly(docs).select("city", "year", "month", "day", "pos", "time", "temperature_2m",
                                               "windspeed_10m")


@register("n6_current_weather", O.sql("""
SELECT CAST(city_id AS BIGINT) AS city_id, timestamp, CAST(temperature AS DOUBLE) AS temperature,
       CASE WHEN temperature IS NOT NULL THEN CAST(windspeed AS DOUBLE) END AS windspeed,
       CAST(NULL AS BIGINT) AS weather_code FROM readings"""))
def q_n6(spark, sf_dir):
    """A nested struct without ``weathercode``, absent where the temperature is."""
    nested = F.when(F.col("temperature").isNotNull(), F.struct("temperature", "windspeed"))
    rows = bindings.readings(spark, sf_dir).select("city_id", "timestamp", nested.alias("current_weather"))
    return jobs.current_weather(rows).drop("current_weather")
