"""Registry of named queries over the driver's tables, each with its oracle SQL.

Each entry is ``name -> (build(spark, sf_dir) -> DataFrame, duckdb_sql | None)``.
Queries run over the whole bound tables. At the harness edge decimals become
DOUBLE and integers BIGINT on both sides, so the comparison sees one type per
column.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus import files
from stratus import oracles as O
from stratus import schemas as S
from stratus.operators import publish, quality, sinks
from stratus.plans import daily_state, marts, panels, scenarios, staging, warehouse
from stratus.session import ensure_semantics
from stratus.sources import bindings, landing
from stratus.sources.tables import read_readings, read_runs
from stratus.streaming import jobs

AS_OF_BASELINE = datetime(2024, 2, 10, 0, 0, 0)
AS_OF_RECENT = datetime(2024, 1, 30, 12, 0, 0)

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_semantics(spark)
            return edge(fn(spark, sf_dir))
        REGISTRY[name] = (run, oracle)
        return fn
    return deco


def edge(df: DataFrame) -> DataFrame:
    """Normalise types for the comparison: decimal -> double, integers -> bigint."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# --------------------------------------------------------------- inputs ---

def inputs(spark: SparkSession, sf_dir: str):
    """Bound raw readings, staged readings and staged cities."""
    raw = bindings.readings(spark, sf_dir)
    return raw, staging.stg_readings(raw), staging.stg_cities(bindings.cities(spark, sf_dir))


MART_OF = {"m3": "daily_summary", "m4": "weekly_trends", "m5": "city_comparisons",
           "m6": "temperature_anomalies", "m7": "extreme_weather"}


def mart(spark, sf_dir, name: str) -> DataFrame:
    """A mart as its model computes it."""
    _, stg, cities = inputs(spark, sf_dir)
    if name == "m6":
        stats = marts.robust_stats_of(daily_state.staged_counts(state(spark, sf_dir, AS_OF_BASELINE), AS_OF_BASELINE))
        return marts.temperature_anomalies(stg, cities, AS_OF_BASELINE, stats=stats)
    return getattr(marts, MART_OF[name])(stg, cities)


# Folders of the state and the marts built from (application, tables, their files' names, sizes and times).
_WAREHOUSES: dict[tuple, str] = {}


def stored(spark, sf_dir) -> str:
    """The warehouse of the tables as they stand now: rewritten tables get a new one."""
    tables = tuple(files.fingerprint(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in bindings.SOURCES)
    key = (spark.sparkContext.applicationId, sf_dir, tables)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = scenarios.scratch_dir(spark, "warehouse")
        daily_state.refresh(spark, bindings.readings(spark, sf_dir), warehouse.state_path(_WAREHOUSES[key]))
    return _WAREHOUSES[key]


def state(spark, sf_dir, as_of: datetime) -> dict[str, DataFrame]:
    """The daily state as the baselines read it, from the files of their window's days."""
    return warehouse.state(spark, stored(spark, sf_dir), as_of)


def built(spark, sf_dir, name: str) -> DataFrame:
    """A mart as dashboards and tests read it, from its files; built on first use."""
    base, model = stored(spark, sf_dir), MART_OF[name]
    if publish.version(spark, warehouse.mart_path(base, model)) is None:
        raw, _, cities = inputs(spark, sf_dir)
        warehouse.build(spark, base, model, raw, cities, AS_OF_BASELINE)
    return warehouse.mart(spark, base, model)


# ----------------------------------------------------- staging and marts ---

STG_SPEC = ("i:city_id t:reading_at d:temperature_c d:feels_like_c d:temperature_f "
            "d:precipitation_mm d:windspeed_kmh i:humidity_pct i:weather_code "
            "s:weather_condition")
CITY_SPEC = ("i:id s:name s:country s:country_code s:continent d:latitude d:longitude "
             "s:timezone i:population s:region")
M3_SPEC = ("s:city_name s:country s:continent s:region t:date d:avg_temp_c d:min_temp_c "
           "d:max_temp_c d:total_precip_mm d:avg_windspeed_kmh d:avg_humidity_pct "
           "s:dominant_condition i:reading_count")
M4_SPEC = ("i:city_id s:city_name s:continent s:region t:day d:daily_avg_temp_c "
           "d:temp_7day_rolling_avg")
M5_SPEC = ("s:city_name s:country s:continent s:region d:latitude d:longitude d:avg_temp_c "
           "d:min_temp_c d:max_temp_c d:avg_windspeed_kmh d:avg_humidity_pct "
           "d:total_precip_mm i:total_readings")
M6_SPEC = ("i:city_id s:city_name s:country s:continent s:region t:reading_at "
           "d:temperature_c s:weather_condition d:mean_temp d:stddev_temp i:sample_size "
           "d:z_score d:robust_z_score s:anomaly_severity b:is_anomaly")
M7_SPEC = ("s:city_name s:country s:continent t:reading_at d:temperature_c d:windspeed_kmh "
           "d:precipitation_mm s:weather_condition s:event_type")


@register("m1_stg_readings", O.sql(O.norm("stg", STG_SPEC + " b:is_suspicious")))
def q_m1(spark, sf_dir):
    return inputs(spark, sf_dir)[1]


@register("m2_stg_cities", O.sql(O.norm("stg_cities", CITY_SPEC)))
def q_m2(spark, sf_dir):
    return inputs(spark, sf_dir)[2]


@register("m3_daily_summary", O.sql(O.norm("m3", M3_SPEC), "m3"))
def q_m3(spark, sf_dir):
    return mart(spark, sf_dir, "m3")


@register("m4_weekly_trends", O.sql(O.norm("m4", M4_SPEC), "m4"))
def q_m4(spark, sf_dir):
    return mart(spark, sf_dir, "m4")


@register("m5_city_comparisons", O.sql(O.norm("m5", M5_SPEC), "m5"))
def q_m5(spark, sf_dir):
    return mart(spark, sf_dir, "m5")


@register("m6_temperature_anomalies", O.sql(O.norm("m6", M6_SPEC), "m6"))
def q_m6(spark, sf_dir):
    return mart(spark, sf_dir, "m6")


@register("m7_extreme_weather", O.sql(O.norm("m7", M7_SPEC), "m7"))
def q_m7(spark, sf_dir):
    return mart(spark, sf_dir, "m7")


# ------------------------------------------------------------- panels ---

PANEL_CITY = "NATION_7"
RECENT = O.AS_OF_RECENT


def _runs(spark, sf_dir):
    return bindings.pipeline_runs(spark, sf_dir)


@register("d01_city_map", O.sql(
    "SELECT city_name, latitude, longitude, avg_temp_c FROM m5", "m5"))
def q_d01(spark, sf_dir):
    return panels.city_map(built(spark, sf_dir, "m5"))


@register("d02_city_ranking", O.sql(
    "SELECT city_name, country, region, avg_temp_c, min_temp_c, max_temp_c, "
    "avg_humidity_pct, avg_windspeed_kmh FROM m5", "m5"))
def q_d02(spark, sf_dir):
    return panels.city_ranking(built(spark, sf_dir, "m5"))


@register("d03_total_readings", O.sql("SELECT COUNT(*) AS total_readings FROM readings"))
def q_d03(spark, sf_dir):
    return panels.total_readings(bindings.readings(spark, sf_dir))


@register("d07_total_readings", O.sql("SELECT COUNT(*) AS total_readings FROM readings"))
def q_d07(spark, sf_dir):
    return panels.total_readings(bindings.readings(spark, sf_dir))


@register("d04_last_run_rows", O.sql(
    "SELECT CAST(rows_loaded AS BIGINT) AS rows_loaded FROM pipeline_runs "
    "ORDER BY created_at DESC NULLS FIRST, id DESC LIMIT 1"))
def q_d04(spark, sf_dir):
    return panels.last_run_rows(_runs(spark, sf_dir))


@register("d05_run_count", O.sql("SELECT COUNT(*) AS total_runs FROM pipeline_runs"))
def q_d05(spark, sf_dir):
    return panels.run_count(_runs(spark, sf_dir))


@register("d06_active_cities", O.sql(
    f"SELECT COUNT(DISTINCT city_id) AS cities_active FROM readings "
    f"WHERE timestamp > {RECENT} - INTERVAL '2 hours'"))
def q_d06(spark, sf_dir):
    return panels.active_cities(bindings.readings(spark, sf_dir), AS_OF_RECENT)


@register("d08_recent_runs", O.sql(
    "SELECT run_id, CAST(rows_fetched AS BIGINT) AS rows_fetched, "
    "CAST(rows_loaded AS BIGINT) AS rows_loaded, status, created_at FROM pipeline_runs "
    "ORDER BY created_at DESC NULLS FIRST, id DESC LIMIT 20"))
def q_d08(spark, sf_dir):
    return panels.recent_runs(_runs(spark, sf_dir), 20)


@register("d09_anomalies_24h", O.sql(
    f"SELECT COUNT(*) AS anomalies_24h FROM m6 WHERE is_anomaly = true "
    f"AND reading_at > {RECENT} - INTERVAL '24 hours'", "m6"))
def q_d09(spark, sf_dir):
    return panels.anomalies_24h(built(spark, sf_dir, "m6"), AS_OF_RECENT)


@register("d10_max_abs_z", O.sql(
    f"SELECT CAST(ROUND(CAST(MAX(ABS(z_score)) AS DECIMAL(12,3)), 2) AS DOUBLE) AS max_z_score "
    f"FROM m6 "
    f"WHERE reading_at > {RECENT} - INTERVAL '24 hours'", "m6"))
def q_d10(spark, sf_dir):
    return panels.max_abs_z(built(spark, sf_dir, "m6"), AS_OF_RECENT)


@register("d11_extremes_24h", O.sql(
    f"SELECT COUNT(*) AS extreme_count FROM m6 WHERE anomaly_severity = 'extreme' "
    f"AND reading_at > {RECENT} - INTERVAL '24 hours'", "m6"))
def q_d11(spark, sf_dir):
    return panels.extremes_24h(built(spark, sf_dir, "m6"), AS_OF_RECENT)


@register("d12_cities_flagged", O.sql(
    f"SELECT COUNT(DISTINCT city_name) AS cities_flagged FROM m6 WHERE is_anomaly = true "
    f"AND reading_at > {RECENT} - INTERVAL '24 hours'", "m6"))
def q_d12(spark, sf_dir):
    return panels.cities_flagged(built(spark, sf_dir, "m6"), AS_OF_RECENT)


@register("d13_top_anomalies", O.sql(
    "SELECT city_name, reading_at, CAST(temperature_c AS DOUBLE) AS temperature_c, "
    "ROUND(z_score, 3) + 0.0 AS z_score, anomaly_severity FROM m6 WHERE is_anomaly = true "
    "ORDER BY ABS(z_score) DESC NULLS FIRST, city_name, reading_at LIMIT 25", "m6"))
def q_d13(spark, sf_dir):
    return panels.top_anomalies(built(spark, sf_dir, "m6"), 25)


@register("d14_anomalous_cities", O.sql(
    "SELECT city_name, COUNT(*) AS anomaly_count FROM m6 WHERE is_anomaly = true "
    "GROUP BY city_name ORDER BY anomaly_count DESC, city_name LIMIT 15", "m6"))
def q_d14(spark, sf_dir):
    return panels.anomalous_cities(built(spark, sf_dir, "m6"), 15)


@register("d15_recent_events", O.sql(
    "SELECT city_name, country, reading_at, CAST(temperature_c AS DOUBLE) AS temperature_c, "
    "CAST(windspeed_kmh AS DOUBLE) AS windspeed_kmh, "
    "CAST(precipitation_mm AS DOUBLE) AS precipitation_mm, event_type FROM m7 "
    "ORDER BY reading_at DESC NULLS FIRST, city_name, event_type LIMIT 20", "m7"))
def q_d15(spark, sf_dir):
    return panels.recent_events(built(spark, sf_dir, "m7"), 20)


_CITY_WHERE = f"WHERE city_name = '{PANEL_CITY}'"
_LATEST = "ORDER BY date DESC NULLS FIRST, country, continent, region"


@register("d16_city_series", O.sql(
    f"SELECT date AS time, avg_temp_c, min_temp_c, max_temp_c FROM m3 {_CITY_WHERE}", "m3"))
def q_d16(spark, sf_dir):
    return panels.city_series(built(spark, sf_dir, "m3"), PANEL_CITY)


@register("d17_city_rain", O.sql(
    f"SELECT CAST(date AS VARCHAR) AS date, total_precip_mm FROM m3 {_CITY_WHERE} "
    f"{_LATEST} LIMIT 30", "m3"))
def q_d17(spark, sf_dir):
    return panels.city_rain(built(spark, sf_dir, "m3"), PANEL_CITY, 30)


@register("d18_city_condition", O.sql(
    f"SELECT dominant_condition FROM m3 {_CITY_WHERE} {_LATEST} LIMIT 1", "m3"))
def q_d18(spark, sf_dir):
    return panels.city_condition(built(spark, sf_dir, "m3"), PANEL_CITY)


@register("d19_city_humidity", O.sql(
    f"SELECT ROUND(avg_humidity_pct, 1) AS humidity FROM m3 {_CITY_WHERE} {_LATEST} LIMIT 1",
    "m3"))
def q_d19(spark, sf_dir):
    return panels.city_humidity(built(spark, sf_dir, "m3"), PANEL_CITY)


@register("d20_city_temp", O.sql(
    f"SELECT avg_temp_c FROM m3 {_CITY_WHERE} {_LATEST} LIMIT 1", "m3"))
def q_d20(spark, sf_dir):
    return panels.city_temp(built(spark, sf_dir, "m3"), PANEL_CITY)


@register("d21_city_wind", O.sql(
    f"SELECT avg_windspeed_kmh FROM m3 {_CITY_WHERE} {_LATEST} LIMIT 1", "m3"))
def q_d21(spark, sf_dir):
    return panels.city_wind(built(spark, sf_dir, "m3"), PANEL_CITY)


@register("d22_city_names", O.sql("SELECT DISTINCT city_name FROM m3", "m3"))
def q_d22(spark, sf_dir):
    return panels.city_names(built(spark, sf_dir, "m3"))


# ------------------------------------------------------- data quality ---

_DQ_COUNTS = (
    f"dq AS (SELECT COUNT(DISTINCT city_id) AS city_count, "
    f"COUNT(*) FILTER (WHERE temperature IS NULL) AS null_count, "
    f"COUNT(*) FILTER (WHERE temperature < -90 OR temperature > 60) AS extreme_count "
    f"FROM readings WHERE timestamp > {RECENT} - INTERVAL '2 hours')")
def _issue_sql(text: str, count: str) -> str:
    """An issue text of the report as a SQL concatenation around its count."""
    before, after = text.format(window=quality.DQ_WINDOW, expected=quality.EXPECTED_CITIES).split("%d")
    return f"'{before}' || {count} || '{after}'"


_DQ_CHECKS = [("coverage", "city_count", f"city_count >= {quality.MIN_CITIES}", quality.LOW_COVERAGE),
              ("null_temperatures", "null_count", "null_count = 0", quality.NULL_TEMPERATURES),
              ("extreme_values", "extreme_count", "extreme_count = 0", quality.EXTREME_VALUES)]
_DQ_REPORT = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, {n} AS observed, {ok} AS passed, "
    f"CASE WHEN NOT ({ok}) THEN {_issue_sql(text, n)} END AS message FROM dq"
    for name, n, ok, text in _DQ_CHECKS)


@register("q04_dq_report", O.with_models(_DQ_REPORT, _DQ_COUNTS))
def q_q04(spark, sf_dir):
    return quality.dq_report(bindings.readings(spark, sf_dir), AS_OF_RECENT)


@register("q01_coverage", O.with_models(
    f"SELECT * FROM ({_DQ_REPORT}) WHERE check_name = 'coverage'", _DQ_COUNTS))
def q_q01(spark, sf_dir):
    return quality.check_coverage(bindings.readings(spark, sf_dir), AS_OF_RECENT)


@register("q01_coverage_reached", O.with_models(
    "SELECT 'coverage' AS check_name, city_count AS observed, city_count >= 20 AS passed, "
    "CASE WHEN city_count < 20 THEN 'LOW COVERAGE: only ' || city_count "
    "|| '/50 cities in last 1 day' END AS message FROM dq",
    _DQ_COUNTS.replace("2 hours", "1 day")))
def q_q01_reached(spark, sf_dir):
    return quality.check_coverage(bindings.readings(spark, sf_dir), AS_OF_RECENT, 20, "1 day")


@register("q02_null_temperatures", O.with_models(
    f"SELECT * FROM ({_DQ_REPORT}) WHERE check_name = 'null_temperatures'", _DQ_COUNTS))
def q_q02(spark, sf_dir):
    return quality.check_nulls(bindings.readings(spark, sf_dir), AS_OF_RECENT)


@register("q03_out_of_range", O.with_models(
    f"SELECT * FROM ({_DQ_REPORT}) WHERE check_name = 'extreme_values'", _DQ_COUNTS))
def q_q03(spark, sf_dir):
    return quality.check_range(bindings.readings(spark, sf_dir), AS_OF_RECENT)


@register("q05_freshness", O.sql(
    f"SELECT COUNT(*) AS recent_count, COUNT(DISTINCT city_id) AS city_count, "
    f"MAX(timestamp) AS latest_timestamp FROM readings "
    f"WHERE timestamp > {RECENT} - INTERVAL '10 minutes'"))
def q_q05(spark, sf_dir):
    return quality.freshness(bindings.streaming_readings(spark, sf_dir), AS_OF_RECENT)


@register("q06_stream_volume", O.sql(
    f"SELECT COUNT(*) FILTER (WHERE timestamp > {RECENT} - INTERVAL '1 hour') AS hour_count, "
    f"COUNT(DISTINCT city_id) AS total_cities FROM readings"))
def q_q06(spark, sf_dir):
    return quality.stream_volume(bindings.streaming_readings(spark, sf_dir), AS_OF_RECENT)


_TEST_SOURCES = {
    "stg_weather_readings": "stg",
    "stg_cities": "stg_cities",
    "daily_summary": "m3",
    "temperature_anomalies": "m6",
    "city_comparisons": "m5",
    "weekly_trends": "m4",
    "extreme_weather": "m7",
}


@register("q07_column_tests", O.sql(
    O.column_tests_sql(quality.COLUMN_TESTS, _TEST_SOURCES), "m3", "m4", "m5", "m6", "m7"))
def q_q07(spark, sf_dir):
    _, stg, cities = inputs(spark, sf_dir)
    frames = {"stg_weather_readings": stg, "stg_cities": cities,
              **{model: built(spark, sf_dir, m) for m, model in MART_OF.items()}}
    return quality.union_all([quality.column_tests(name, frames[name], t)
                              for name, t in quality.COLUMN_TESTS.items()])


_Q8 = f"""
SELECT 'daily_summary_has_rows' AS check_name, CAST(COUNT(*) AS DOUBLE) AS observed,
       COUNT(*) > 0 AS passed FROM m3
UNION ALL
SELECT 'daily_summary_null_temp_rate', CAST(COUNT(*) FILTER (WHERE avg_temp_c IS NULL) AS DOUBLE)
       / NULLIF(COUNT(*), 0),
       COALESCE(CAST(COUNT(*) FILTER (WHERE avg_temp_c IS NULL) AS DOUBLE)
                / NULLIF(COUNT(*), 0) < 0.05, TRUE) FROM m3
UNION ALL
SELECT 'city_comparisons_cities', CAST(COUNT(DISTINCT city_name) AS DOUBLE),
       COUNT(DISTINCT city_name) >= 45 FROM m5
UNION ALL
SELECT 'anomalies_max_abs_z', MAX(ABS(z_score)), COALESCE(MAX(ABS(z_score)) < 10, TRUE)
FROM m6 WHERE z_score IS NOT NULL
UNION ALL
SELECT 'extreme_event_types_valid',
       CAST(COUNT(DISTINCT CASE WHEN event_type NOT IN ('Thunderstorm', 'Heatwave', 'Freeze',
            'High winds', 'Heavy rain', 'Other') THEN event_type END) AS DOUBLE),
       COUNT(DISTINCT CASE WHEN event_type NOT IN ('Thunderstorm', 'Heatwave', 'Freeze',
            'High winds', 'Heavy rain', 'Other') THEN event_type END) = 0 FROM m7
UNION ALL
SELECT 'weekly_rolling_avg_not_null',
       CAST(COUNT(*) FILTER (WHERE temp_7day_rolling_avg IS NULL
                             AND day < {O.AS_OF_BASELINE} - INTERVAL '7 days') AS DOUBLE),
       COUNT(*) FILTER (WHERE temp_7day_rolling_avg IS NULL
                        AND day < {O.AS_OF_BASELINE} - INTERVAL '7 days') = 0 FROM m4
UNION ALL
SELECT 'city_comparisons_coordinates',
       CAST(COUNT(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) AS DOUBLE),
       COUNT(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) = 0 FROM m5"""


@register("q08_mart_invariants", O.sql(_Q8, "m3", "m4", "m5", "m6", "m7"))
def q_q08(spark, sf_dir):
    return quality.mart_invariants(*(built(spark, sf_dir, m) for m in MART_OF), AS_OF_BASELINE)


@register("q09_run_status", O.sql(
    "SELECT run_id, CAST(rows_fetched - rows_loaded AS BIGINT) AS errors, "
    "CASE WHEN rows_fetched - rows_loaded = 0 THEN 'success' ELSE 'partial' END "
    "AS derived_status FROM pipeline_runs"))
def q_q09(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    errors = (F.col("rows_fetched") - F.col("rows_loaded")).cast("bigint")
    return runs.select("run_id", errors.alias("errors"),
                       quality.run_status(errors).alias("derived_status"))


@register("q10_key_checks", O.sql("""
SELECT 'readings_duplicate_keys' AS check_name,
       CAST(COUNT(*) - COUNT(DISTINCT (city_id, timestamp)) AS BIGINT) AS violations
FROM readings
UNION ALL
SELECT 'readings_orphan_city', COUNT(*) FROM readings r
WHERE r.city_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cities c WHERE c.id = r.city_id)
UNION ALL
SELECT 'runs_bad_status', COUNT(*) FROM pipeline_runs
WHERE status IS NOT NULL AND status NOT IN ('success', 'partial', 'failed')
UNION ALL
SELECT 'runs_duplicate_id', CAST(COUNT(id) - COUNT(DISTINCT id) AS BIGINT) FROM pipeline_runs"""))
def q_q10(spark, sf_dir):
    r = bindings.readings(spark, sf_dir)
    runs = _runs(spark, sf_dir)
    c = bindings.cities(spark, sf_dir)
    return quality.key_checks(r, c, runs)


# -------------------------------------------------- landing and sinks ---

_REV = "TIMESTAMP '2024-01-16 00:00:00'"
_RC = "FROM readings r JOIN cities c ON c.id = r.city_id"
_UNFIT = (f"r.city_id = {scenarios.OVERFLOW_CITY} AND r.weather_code = {scenarios.OVERFLOW_CODE}")
_CUT = f"r.city_id = {scenarios.CUT_CITY} AND hour(r.timestamp) = {scenarios.CUT_HOUR}"
_LOST = f"(({_UNFIT}) OR ({_CUT}))"


@register("s1_landing_scan", O.sql(f"""
SELECT lower(replace(c.name, ' ', '_')) AS city,
       strftime(r.timestamp, '%Y') AS year,
       strftime(r.timestamp, '%m') AS month,
       strftime(r.timestamp, '%d') AS day,
       '00' AS hour,
       CAST(row_number() OVER (PARTITION BY r.city_id, date_trunc('hour', r.timestamp)
                               ORDER BY r.timestamp) - 1 AS BIGINT) AS pos,
       strftime(r.timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS time,
       CAST(r.temperature + 1 AS DOUBLE) AS temperature_2m,
       CAST(r.feels_like AS DOUBLE) AS apparent_temperature,
       CAST(r.precipitation AS DOUBLE) AS precipitation,
       CAST(r.windspeed AS DOUBLE) AS windspeed_10m,
       CAST(r.humidity AS BIGINT) AS relative_humidity_2m,
       CAST(r.weather_code AS BIGINT) AS weathercode
{_RC}"""))
def q_s1(spark, sf_dir):
    base_a = scenarios.land_provisional(spark, sf_dir)
    return landing.explode_hourly(landing.read_landing(spark, base_a))


@register("j5_city_landings", O.sql(
    "SELECT CAST(id AS BIGINT) AS id, name, id IN (SELECT city_id FROM readings) AS landed "
    "FROM cities"))
def q_j5(spark, sf_dir):
    base_a = scenarios.land_provisional(spark, sf_dir)
    return landing.city_landing_status(landing.read_landing(spark, base_a),
                                       bindings.cities(spark, sf_dir))


@register("k2_upsert_table", O.sql(f"""
SELECT CAST(r.city_id AS BIGINT) AS city_id, r.timestamp,
       CAST(CASE WHEN r.timestamp >= {_REV} THEN r.temperature ELSE r.temperature + 1 END
            AS DOUBLE) AS temperature,
       CAST(r.feels_like AS DOUBLE) AS feels_like,
       CAST(r.precipitation AS DOUBLE) AS precipitation,
       CAST(r.windspeed AS DOUBLE) AS windspeed,
       CAST(r.humidity AS BIGINT) AS humidity,
       CAST(r.weather_code AS BIGINT) AS weather_code,
       CAST(r.timestamp AS DATE) AS reading_date
{_RC} WHERE r.timestamp >= {_REV} OR NOT {_LOST}"""))
def q_k2(spark, sf_dir):
    table, _, _ = scenarios.two_loads(spark, sf_dir)
    return read_readings(spark, table)


def _load_sql(n: int, where: str, times: int) -> str:
    """One run-log row: rows of a load over the readings ``where``, its errors counted by city."""
    return f"""
SELECT {n} AS id, 'load-{n}' AS run_id, loaded + errors AS rows_fetched, loaded AS rows_loaded,
       CASE WHEN errors = 0 THEN 'success' ELSE 'partial' END AS status,
       TIMESTAMP '2024-02-01 00:00:00' AS created_at
FROM (SELECT CAST((SELECT {times} * COUNT(*) {_RC} WHERE {where})
                  - (SELECT COUNT(*) {_RC} WHERE {where} AND {_LOST}) AS BIGINT) AS loaded,
             CAST((SELECT COUNT(*) FROM cities WHERE id NOT IN (SELECT r.city_id FROM readings r WHERE {where}))
                  + (SELECT COUNT(DISTINCT r.city_id) {_RC} WHERE {where} AND {_LOST}) AS BIGINT) AS errors)"""


@register("k4_run_log", O.sql(
    _load_sql(1, "true", 1) + " UNION ALL " + _load_sql(2, f"r.timestamp >= {_REV}", 2)))
def q_k4(spark, sf_dir):
    _, runs, _ = scenarios.two_loads(spark, sf_dir)
    return read_runs(spark, runs).select("id", "run_id", "rows_fetched", "rows_loaded",
                                         "status", "created_at")


def _rejects_sql(n: int, where: str) -> str:
    slug = "lower(replace(c.name, ' ', '_'))"
    return f"""
SELECT 'load-{n}' AS run_id, {slug} AS city, 'row out of range' AS reason, COUNT(*) AS n
{_RC} WHERE {where} AND {_UNFIT} GROUP BY c.name
UNION ALL
SELECT 'load-{n}', {slug}, 'unreadable document', COUNT(DISTINCT CAST(r.timestamp AS DATE))
{_RC} WHERE {where} AND {_CUT} GROUP BY c.name"""


@register("k4_rejects", O.sql(
    _rejects_sql(1, "true") + " UNION ALL " + _rejects_sql(2, f"r.timestamp >= {_REV}")))
def q_k4_rejects(spark, sf_dir):
    _, _, rejects = scenarios.two_loads(spark, sf_dir)
    return (spark.read.parquet(rejects).where(F.length("original") > 0)
                 .groupBy("run_id", "city", "reason").agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------ streaming ---

_NOT_STORED = (f"(r.weather_code = {scenarios.BROKEN_CODE} OR (r.weather_code = {scenarios.UNFIT_CODE} "
               f"AND r.city_id IN ({scenarios.OVERFLOW_CITY}, {scenarios.NO_ID_CITY})))")
_FIRST = f"""
SELECT r.city_id, r.timestamp, r.temperature, r.windspeed, r.weather_code {_RC}
WHERE NOT {_NOT_STORED}"""
_REPLAY_NEW = f"""
SELECT r.city_id, r.timestamp, r.temperature + 1 AS temperature, r.windspeed, r.weather_code
{_RC} WHERE {_NOT_STORED} AND r.timestamp >= {_REV}"""


@register("t1_stream_readings_sink", O.sql(f"""
SELECT CAST(city_id AS BIGINT) AS city_id, timestamp, CAST(temperature AS DOUBLE) AS temperature,
       CAST(windspeed AS DOUBLE) AS windspeed, CAST(weather_code AS BIGINT) AS weather_code,
       CAST(timestamp AS DATE) AS reading_date
FROM ({_FIRST} UNION ALL {_REPLAY_NEW}) t"""))
def q_t1(spark, sf_dir):
    table, _ = scenarios.stream_to_table(spark, sf_dir)
    return spark.read.parquet(table)


@register("t7_stream_quarantine", O.sql(f"""
SELECT CAST(r.city_id AS VARCHAR) AS key, CAST(r.city_id % 3 AS BIGINT) AS partition,
       epoch_us(r.timestamp) AS offset,
       CASE WHEN r.weather_code = {scenarios.BROKEN_CODE} THEN 'malformed'
            WHEN r.city_id = {scenarios.NO_ID_CITY} THEN 'no city' ELSE 'overflow' END AS kind
{_RC} WHERE {_NOT_STORED}"""))
def q_t7(spark, sf_dir):
    _, quarantine = scenarios.stream_to_table(spark, sf_dir)
    value = F.col("value")
    kind = (F.when(value.contains('"city_id":null'), "no city")
             .when(value.contains(f'"temperature":{scenarios.OVERFLOW_VALUE}.0'), "overflow")
             .when(~value.endswith("}"), "malformed"))
    return spark.read.parquet(quarantine).select("key", "partition", "offset", kind.alias("kind"))


_BASELINE = f"""
base AS (
  SELECT r.city_id,
         {O.exact_mean('r.temperature')} AS mean_temp,
         {O.exact_avg('r.temperature', 2)} AS mean_temp_2dp,
         {O.exact_stddev('r.temperature')} AS stddev_temp
  FROM readings r
  WHERE r.timestamp >= {O.AS_OF_BASELINE} - INTERVAL '30 days' AND r.temperature IS NOT NULL
    AND r.city_id IN (SELECT id FROM cities)
  GROUP BY r.city_id
  HAVING COUNT(*) >= 24
)"""


@register("a15_raw_baseline", O.with_models(
    "SELECT CAST(city_id AS BIGINT) AS city_id, mean_temp, mean_temp_2dp, stddev_temp FROM base",
    _BASELINE))
def q_a15(spark, sf_dir):
    return daily_state.raw_baseline(state(spark, sf_dir, AS_OF_BASELINE), AS_OF_BASELINE, bindings.cities(spark, sf_dir))


# A window that begins within a day: that day's readings, the other days' state.
AS_OF_MIDDAY = datetime(2024, 2, 9, 13, 37, 0)


@register("a15_raw_baseline_midday", O.with_models(
    "SELECT CAST(city_id AS BIGINT) AS city_id, mean_temp, mean_temp_2dp, stddev_temp FROM base",
    _BASELINE.replace(O.AS_OF_BASELINE, "TIMESTAMP '2024-02-09 13:37:00'")))
def q_a15_midday(spark, sf_dir):
    return daily_state.raw_baseline(state(spark, sf_dir, AS_OF_MIDDAY), AS_OF_MIDDAY, bindings.cities(spark, sf_dir),
                                    bindings.readings(spark, sf_dir))


@register("a16_robust_stats", O.sql(
    "SELECT CAST(city_id AS BIGINT) AS city_id, mean_temp, stddev_temp, p25, p75, "
    "sample_size FROM city_stats", "m6"))
def q_a16(spark, sf_dir):
    return marts.robust_stats_of(daily_state.staged_counts(state(spark, sf_dir, AS_OF_BASELINE), AS_OF_BASELINE))


_MSGS = f"""
msgs AS (
  SELECT r.city_id, c.name AS city_name, c.country, c.continent, r.timestamp,
         CAST(r.temperature AS DOUBLE) AS temperature, CAST(r.windspeed AS DOUBLE) AS windspeed,
         CAST(r.weather_code AS INTEGER) AS weather_code, '1.0' AS schema_version, r.timestamp AS reading_time
  {_RC} WHERE r.weather_code <> 42
  UNION ALL
  SELECT r.city_id, c.name, c.country, c.continent, r.timestamp,
         CAST(r.temperature + 1 AS DOUBLE), CAST(r.windspeed AS DOUBLE),
         CAST(r.weather_code AS INTEGER), '1.0', r.timestamp
  {_RC} WHERE r.timestamp >= {_REV}
)"""


_ALERTS = f"""
SELECT CAST(m.city_id AS BIGINT) AS city_id, m.city_name, m.country, m.continent, m.timestamp,
       m.temperature, m.windspeed, CAST(m.weather_code AS BIGINT) AS weather_code,
       m.schema_version, m.reading_time, 'temperature_anomaly' AS alert_type,
       ROUND((m.temperature - b.mean_temp) / b.stddev_temp, 3) + 0.0 AS z_score,
       b.mean_temp_2dp AS baseline_mean, ROUND(b.stddev_temp, 2) AS baseline_stddev,
       CASE WHEN ABS((m.temperature - b.mean_temp) / b.stddev_temp) > 3 THEN 'extreme'
            ELSE 'significant' END AS severity
FROM msgs m JOIN base b ON b.city_id = m.city_id
WHERE m.temperature IS NOT NULL AND b.stddev_temp > 0
  AND ABS((m.temperature - b.mean_temp) / b.stddev_temp) > 2"""


@register("t3_stream_alerts", O.with_models(_ALERTS, _BASELINE, _MSGS))
def q_t3(spark, sf_dir):
    out = scenarios.stream_alerts(spark, sf_dir, AS_OF_BASELINE)
    return spark.read.parquet(out).drop("batch_id")


_ALERT_KEYS = [f.name for f in S.READING_MESSAGE.fields] + S.ALERT_FIELDS


@register("k6_alert_messages", O.with_models(
    f"SELECT CAST(city_id AS VARCHAR) AS key, '{','.join(_ALERT_KEYS)}' AS fields, a.* FROM ({_ALERTS}) a",
    _BASELINE, _MSGS))
def q_k6(spark, sf_dir):
    out = scenarios.stream_alerts(spark, sf_dir, AS_OF_BASELINE)
    sent = jobs.to_alert_messages(spark.read.parquet(out))
    schema = T.StructType(S.READING_MESSAGE.fields + [
        T.StructField(f, T.StringType() if f in ("alert_type", "severity") else T.DoubleType())
        for f in S.ALERT_FIELDS])
    return sent.select("key", F.array_join(F.json_object_keys("value"), ",").alias("fields"),
                       F.from_json("value", schema).alias("m")).select("key", "fields", "m.*")


@register("n5_message_roundtrip", O.with_models(f"""
SELECT CAST(city_id AS VARCHAR) AS key, CAST(city_id AS BIGINT) AS city_id, city_name, country,
       continent, timestamp, temperature, windspeed, CAST(weather_code AS BIGINT) AS weather_code,
       schema_version, reading_time FROM (
  SELECT r.city_id, c.name AS city_name, c.country, c.continent,
         r.timestamp + INTERVAL '7 minutes' AS timestamp,
         CAST(r.temperature AS DOUBLE) AS temperature, CAST(r.windspeed AS DOUBLE) AS windspeed,
         r.weather_code, '1.0' AS schema_version, r.timestamp AS reading_time {_RC}) t"""))
def q_n5(spark, sf_dir):
    ingested = F.col("timestamp") + F.expr("INTERVAL 7 MINUTES")
    msgs = jobs.to_messages(bindings.readings(spark, sf_dir), bindings.cities(spark, sf_dir), ingested)
    good, _ = jobs.decode(msgs.drop("timestamp"))
    return good.drop("value")


@register("a13_null_rate", O.sql(
    "SELECT CAST(COUNT(*) FILTER (WHERE temperature IS NULL) AS DOUBLE) / NULLIF(COUNT(*), 0) "
    "AS null_rate FROM readings"))
def q_a13(spark, sf_dir):
    return quality.null_rate(bindings.readings(spark, sf_dir), "temperature")


@register("k7_mart_build", O.sql(O.norm("m3", M3_SPEC), "m3"))
def q_k7(spark, sf_dir):
    path = scenarios.scratch_dir(spark, "mart-daily-summary")
    sinks.build_mart(mart(spark, sf_dir, "m3"), path)
    return publish.read_published(spark, path)


from stratus.plans import catalog_jobs  # noqa: E402,F401 — registers its queries here
