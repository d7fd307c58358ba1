"""Landed API documents: write (K1), read (S1), explode (N1-N3), resolve cities.

A landed document is one JSON object per city per run, holding an ``hourly``
struct of parallel arrays, stored under a Hive-style path
``city=<slug>/year=YYYY/month=MM/day=DD/hour=HH/``. Partition values come
from the run's interval start, not from the readings inside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus import schemas as S
from stratus.functions import exprs as X
from stratus.operators import joins

# Fixed text format of the ``time`` array elements.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Landing array fields -> reading columns, with the target types.
MEASURES = [
    ("temperature_2m", "temperature", "decimal(5,2)"),
    ("apparent_temperature", "feels_like", "decimal(5,2)"),
    ("precipitation", "precipitation", "decimal(6,2)"),
    ("windspeed_10m", "windspeed", "decimal(5,2)"),
    ("relative_humidity_2m", "humidity", "smallint"),
    ("weathercode", "weather_code", "smallint"),
]


def partition_values(run_ts) -> list:
    """``year, month, day, hour`` strings of the run's interval start."""
    ts = X._c(run_ts)
    return [F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month"),
            F.date_format(ts, "dd").alias("day"), F.date_format(ts, "HH").alias("hour")]


def landing_docs(readings: DataFrame, cities: DataFrame, run_ts,
                 measure_shift=None) -> DataFrame:
    """Build landed documents from readings: one per city, run and hour of reading.

    ``run_ts`` is a column giving each reading's run (its interval start). A
    document gathers one hour of one city, a naturally small group that does
    not grow with the history; a run's object holds its documents as JSON
    lines. Arrays are ordered by reading time. The optional ``measure_shift``
    adds a constant to temperatures (used to stage revisions).
    """
    r = joins.with_city(readings.withColumn("__run_ts", run_ts), cities,
                        [F.col("name").alias("__city_name")])
    temp = F.col("temperature")
    if measure_shift is not None:
        temp = temp + F.lit(measure_shift)
    element = F.struct(
        F.col("timestamp").alias("ts"),
        F.date_format("timestamp", TIME_FORMAT).alias("time"),
        temp.cast("double").alias("temperature_2m"),
        F.col("feels_like").cast("double").alias("apparent_temperature"),
        F.col("precipitation").cast("double").alias("precipitation"),
        F.col("windspeed").cast("double").alias("windspeed_10m"),
        F.col("humidity").cast("int").alias("relative_humidity_2m"),
        F.col("weather_code").cast("int").alias("weathercode"))
    grouped = (r.groupBy("__city_name", "__run_ts", F.date_trunc("hour", "timestamp").alias("__hour"))
                .agg(F.sort_array(F.collect_list(element)).alias("__els")))
    hourly = F.struct(*[F.col("__els")[f].alias(f) for f in
                        ["time", "temperature_2m", "apparent_temperature", "precipitation",
                         "windspeed_10m", "relative_humidity_2m", "weathercode"]])
    return grouped.select(hourly.alias("hourly"), X.slug("__city_name").alias("city"),
                          *partition_values("__run_ts"))


def write_landing(docs: DataFrame, base: str, num_tasks: int | None = None,
                  files_per_run: int = 1) -> None:
    """K1: write documents under ``city=/year=/month=/day=/hour=``.

    Dynamic partition overwrite: re-landing a run replaces exactly its own
    objects and leaves every other run untouched. Documents are dealt by their
    partition values into ``num_tasks`` (default: the cluster's parallelism)
    tasks, so the many small objects are opened in parallel. A source whose
    runs are large sets ``files_per_run``: a hash of a document's first time
    then deals each run to that many tasks.
    """
    n = num_tasks or docs.sparkSession.sparkContext.defaultParallelism
    part = F.pmod(F.xxhash64(F.get("hourly.time", F.lit(0))), F.lit(files_per_run))
    (docs.repartition(n, *S.LANDING_PARTITIONS, part)
         .write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*S.LANDING_PARTITIONS)
         .json(base))


def read_landing(spark: SparkSession, base: str) -> DataFrame:
    """Scan landed documents with an explicit schema.

    Partition columns are declared as strings in the schema, so ``month=04``
    stays ``"04"``; filters on them prune directories before any file is read.
    A document that is not valid JSON has its text in ``_corrupt``.
    """
    return (spark.read.schema(S.LANDING).option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", S.CORRUPT).json(base))


def explode_hourly(docs: DataFrame) -> DataFrame:
    """One row per element of ``hourly.time``.

    Each measure is ``get(array, pos)``: a short measure array yields NULL (N2)
    and extra elements are ignored; a document with no ``hourly`` or an empty
    ``time`` yields no rows (N3). Raw values keep the landing types; see
    :func:`typed_readings` for the table types.
    """
    exploded = docs.select("*", F.posexplode("hourly.time").alias("__pos", "__time"))
    return exploded.select(
        *[c for c in docs.columns if c not in ("hourly", S.CORRUPT)],
        F.col("__pos").alias("pos"),
        F.col("__time").alias("time"),
        *[F.get(F.col(f"hourly.{src}"), F.col("__pos")).alias(src) for src, _, _ in MEASURES])


def typed_readings(exploded: DataFrame, city_id_col: str = "city_id") -> tuple[DataFrame, DataFrame]:
    """Cast exploded rows to the readings types; split off rows that cannot be stored.

    Returns ``(good, rejected)``. A row is rejected when its time cannot be
    parsed or a present measure overflows its column type — one bad value
    cannot fail the load. A rejected row keeps its raw values as JSON in
    ``original``.
    """
    typed = typed_rows(exploded)
    out_cols = [city_id_col, "timestamp"] + [dst for _, dst, _ in MEASURES]
    srcs = {src for src, _, _ in MEASURES}
    other = [c for c in exploded.columns if c not in srcs and c not in out_cols]
    return typed.where(~F.col("unfit")).select(*out_cols, *other), typed.where("unfit").drop("unfit")


def typed_rows(exploded: DataFrame) -> DataFrame:
    """Exploded rows with the readings' types, ``unfit`` (it cannot be stored) and ``original`` (as JSON)."""
    srcs = {src for src, _, _ in MEASURES}
    bad = F.col("timestamp").isNull() | X.overflowed(
        [(F.col(f"__raw_{src}"), F.col(dst)) for src, dst, _ in MEASURES])
    return exploded.select(
        *[c for c in exploded.columns if c not in srcs],
        F.to_json(F.struct(*[c for c in ["time", *sorted(srcs)] if c in exploded.columns]),
                  {"ignoreNullFields": "false"}).alias("original"),
        *[F.col(src).alias(f"__raw_{src}") for src, _, _ in MEASURES],
        X.parse_hour("time").cast("timestamp").alias("timestamp"),
        *[F.col(src).try_cast(t).alias(dst) for src, dst, t in MEASURES]).withColumn("unfit", bad)


def resolve_cities(landed: DataFrame, cities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Attach ``city_id`` to landed rows by city slug; list cities with no landing.

    Returns ``(present, missing)``: ``present`` is ``landed`` inner-joined to
    the (size-checked, broadcast) dimension; ``missing`` holds the cities with
    no landed document, each counted as an error by the load.
    """
    dim = cities.select(F.col("id").alias("city_id"), X.slug("name").alias("__slug"))
    present = joins.join_dimension(landed, dim, F.col("city") == F.col("__slug")).drop("__slug")
    missing = joins.missing_keys(cities.select("id", "name", X.slug("name").alias("__slug")),
                                 landed.select("city"), "__slug", "city").drop("__slug")
    return present, missing


def city_landing_status(docs: DataFrame, cities: DataFrame) -> DataFrame:
    """J5 report: every city with ``landed`` = whether any readable document exists for it."""
    readable = F.col(S.CORRUPT).isNull() | F.col("hourly").isNotNull()
    slugs = docs.where(readable).select(F.col("city").alias("__slug")).distinct().withColumn("__hit", F.lit(True))
    dim = cities.select("id", "name", X.slug("name").alias("__slug"))
    return (dim.join(slugs, "__slug", "left")
               .select("id", "name", F.coalesce("__hit", F.lit(False)).alias("landed")))
