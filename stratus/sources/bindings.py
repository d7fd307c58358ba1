"""Bind the driver's generated tables to this library's inputs.

The test tables are a TPC-H-like star plus an ``events`` stream. They become:

* ``cities``        <- ``nation`` joined to ``region`` (25 rows)
* ``readings``      <- ``events`` (one reading per event, whole table)
* ``pipeline_runs`` <- ``orders`` (one run-log row per order, whole table)

The mapping is deterministic and written once as SQL fragments that Spark and
the DuckDB oracle both evaluate, so the two sides see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratus import files
from stratus.operators.joins import join_dimension

# Fixed binding values (also used verbatim by the oracle SQL).
WEATHER_CODE_CYCLE = [0, 1, 2, 3, 45, 48, 51, 53, 55, 61, 63, 65, 71, 73, 75, 77, 80, 81,
                      82, 95, 96, 99, 42]
CITY_MODULUS = 25
CONTINENT_OF_REGION = [
    ("AFRICA", "Africa"),
    ("AMERICA", "North America"),
    ("ASIA", "Asia"),
    ("EUROPE", "Europe"),
    ("MIDDLE EAST", "Middle East"),
]
RUN_STATUS_OF_ORDER = [("O", "success"), ("P", "partial"), ("F", "failed")]


def _case(col: str, pairs) -> str:
    whens = " ".join(f"WHEN {col} = '{a}' THEN '{b}'" for a, b in pairs)
    return f"CASE {whens} END"


# Measures shared verbatim by both engines.
READING_EXPRS = {
    "city_id": f"CAST(user_id % {CITY_MODULUS} AS INT)",
    "temperature": "CASE WHEN event_id % 50 = 7 THEN NULL "
                   "ELSE CAST(value - 40 AS DECIMAL(5,2)) END",
    "feels_like": "CASE WHEN event_id % 50 = 7 THEN NULL "
                  "ELSE CAST(value - 40 - (event_id % 5) AS DECIMAL(5,2)) END",
    "precipitation": "CAST(CAST(event_id * 7 % 31 AS INT) * 0.5 - 0.5 AS DECIMAL(6,2))",
    "windspeed": "CAST(CAST(event_id % 97 AS INT) * 0.9 - 0.9 AS DECIMAL(5,2))",
}
SPARK_ONLY = {
    "humidity": "CAST(CAST(get_json_object(props, '$.k') AS INT) + 3 AS SMALLINT)",
    "weather_code": "CAST(element_at(array(%s), CAST(event_id * 11 %% 23 AS INT) + 1) AS SMALLINT)"
                    % ", ".join(map(str, WEATHER_CODE_CYCLE)),
}
DUCKDB_ONLY = {
    "humidity": "CAST(CAST(json_extract(props, '$.k') AS INTEGER) + 3 AS SMALLINT)",
    "weather_code": "CAST([%s][event_id * 11 %% 23 + 1] AS SMALLINT)"
                    % ", ".join(map(str, WEATHER_CODE_CYCLE)),
}

CITY_EXPRS = {
    "id": "n_nationkey",
    "name": "n_name",
    "country": "n_name",
    "country_code": "lpad(CAST(n_nationkey AS STRING), 2, '0')",
    "continent": _case("r_name", CONTINENT_OF_REGION),
    "latitude": "CAST(n_nationkey * 3 - 36 AS DECIMAL(8,5))",
    "longitude": "CAST(n_nationkey * 14 - 168 AS DECIMAL(8,5))",
    "timezone": "'UTC'",
    "population": "CAST(NULL AS INT)",
}

RUN_EXPRS = {
    "id": "CAST(o_orderkey AS INT)",
    "run_id": "CAST(o_orderkey AS STRING)",
    "city_id": "CAST(NULL AS INT)",
    "rows_fetched": "CAST(o_custkey + CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_orderkey % 7 + 1 END AS INT)",
    "rows_loaded": "CAST(o_custkey AS INT)",
    "status": _case("o_orderstatus", RUN_STATUS_OF_ORDER),
    "duration_ms": "CAST(NULL AS INT)",
    "error_msg": "CAST(NULL AS STRING)",
}


# The tables that the readings and the dimension are made of.
SOURCES = ("events", "nation", "region")


# One relation a (application, table, its files' names, sizes and times): a rewritten table is read anew.
_RELATIONS: dict[tuple, DataFrame] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path, files.fingerprint(spark, path))
    if key not in _RELATIONS:
        _RELATIONS[key] = spark.read.parquet(path)
    return _RELATIONS[key]


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``weather_readings`` (city_id, timestamp, six measures) from ``events``."""
    exprs = {**READING_EXPRS, **SPARK_ONLY}
    e = _table(spark, sf_dir, "events")
    return e.selectExpr(
        exprs["city_id"] + " AS city_id",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        *(f"{exprs[c]} AS {c}" for c in
          ["temperature", "feels_like", "precipitation", "windspeed", "humidity",
           "weather_code"]))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cities`` dimension from ``nation`` x ``region`` (region is 5 rows)."""
    n = _table(spark, sf_dir, "nation")
    r = _table(spark, sf_dir, "region")
    j = join_dimension(n, r, n.n_regionkey == r.r_regionkey)
    return j.selectExpr(*(f"{v} AS {k}" for k, v in CITY_EXPRS.items()))


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pipeline_runs`` run log from ``orders``; ``created_at`` = order date."""
    o = _table(spark, sf_dir, "orders")
    return o.selectExpr(*(f"{v} AS {k}" for k, v in RUN_EXPRS.items()),
                        "CAST(o_orderdate AS TIMESTAMP) AS created_at")


# ------------------------------------------------------------- oracle side ---

def duckdb_ctes() -> str:
    """The same binding as DuckDB CTEs: ``readings``, ``cities``, ``pipeline_runs``."""
    r = {**READING_EXPRS, **DUCKDB_ONLY}
    rcols = ",\n    ".join(
        [r["city_id"] + " AS city_id", "ts AS timestamp"]
        + [f"{r[c]} AS {c}" for c in ["temperature", "feels_like", "precipitation",
                                       "windspeed", "humidity", "weather_code"]])
    ccols = ",\n    ".join(f"{v} AS {k}"
                           for k, v in CITY_EXPRS.items())
    runcols = ",\n    ".join([f"{v} AS {k}" for k, v in RUN_EXPRS.items()]
                             + ["o_orderdate AS created_at"])
    return (
        f"readings AS (SELECT\n    {rcols}\n  FROM events),\n"
        f"cities AS (SELECT\n    {ccols}\n  FROM nation JOIN region ON n_regionkey = r_regionkey),\n"
        f"pipeline_runs AS (SELECT\n    {runcols}\n  FROM orders)")


def streaming_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``streaming_readings`` shape (key + temperature, windspeed, code) of the readings."""
    return readings(spark, sf_dir).select("city_id", "timestamp", "temperature", "windspeed",
                                          "weather_code")
