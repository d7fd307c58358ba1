"""Batch ETL (the reference's hourly DAG), as Spark jobs.

``read_landing -> staged_rows (resolve cities, explode, type, judge) -> stage -> upsert
-> quarantine -> log_run -> dq_report -> daily state and marts of the touched days``. The
driver only plans; executors read the JSON once, shuffle on the reading key for the upsert
and write Parquet.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus import files
from stratus import schemas as S
from stratus.functions import exprs as X
from stratus.operators import joins, quality, sinks
from stratus.plans import staging, warehouse
from stratus.session import scratch_dir
from stratus.sources import landing

log = logging.getLogger(__name__)


@dataclass
class LoadResult:
    """``counters``: rows read, stored and rejected and cities in error, observed while the rows were staged."""
    run_id: str
    rows_loaded: int
    errors: int
    rejected: int
    report: list
    touched: list[date]
    counters: dict[str, int]


def read_runs(spark: SparkSession, sources: list[tuple[str, Column | None]]) -> DataFrame:
    """Landed documents of the selected runs.

    ``sources`` lists ``(landing_base, run_filter)``; a filter is a predicate
    on the partition columns (``city``, ``year`` .. ``hour``), so it prunes
    landing directories before any file is read.
    """
    frames = []
    for base, run_filter in sources:
        d = landing.read_landing(spark, base)
        frames.append(d.where(run_filter) if run_filter is not None else d)
    return reduce(DataFrame.unionByName, frames)


UNREADABLE, UNKNOWN_CITY, OUT_OF_RANGE = "unreadable document", "unknown city", "row out of range"


def staged_rows(docs: DataFrame, cities: DataFrame) -> DataFrame:
    """Every row of the landed documents, with what becomes of it, in one pass over the JSON.

    Rows to be stored have a position and no ``reason``; they carry the landing
    order ``run_ts`` (the run's interval start) and ``pos``. A row that cannot
    be stored, an unreadable document and a document of an unknown city have a
    ``reason`` and their text as ``original``. A document without hours is one
    row with neither.
    """
    dim = cities.select(F.col("id").alias("city_id"), X.slug("name").alias("__slug"))
    known = joins.join_dimension(docs, dim, F.col("city") == F.col("__slug"), "left").drop("__slug")
    why = (F.when(F.col(S.CORRUPT).isNotNull(), UNREADABLE)
            .when(F.col("city_id").isNull(), UNKNOWN_CITY))
    text = F.coalesce(S.CORRUPT, F.to_json("hourly"))
    known = known.select("*", why.alias("why"), F.when(why.isNotNull(), text).alias("document"))
    times = F.when(F.col("why").isNull(), F.col("hourly.time"))
    rows = known.select(
        "city", "city_id", "why", "document",
        F.to_timestamp(F.format_string("%s-%s-%s %s:00:00", "year", "month", "day", "hour")).alias("run_ts"),
        F.posexplode_outer(times).alias("pos", "time"), "hourly")
    rows = landing.typed_rows(rows.select(
        *[c for c in rows.columns if c != "hourly"],
        *[F.get(F.col(f"hourly.{src}"), F.col("pos")).alias(src) for src, _, _ in landing.MEASURES]))
    reason = F.when(F.col("why").isNotNull(), F.col("why")).when(F.col("pos").isNotNull() & F.col("unfit"), OUT_OF_RANGE)
    return rows.select(
        "city", "city_id", "timestamp", *[d for _, d, _ in landing.MEASURES], "run_ts", "pos",
        reason.alias("reason"), F.when(reason.isNotNull(), F.coalesce("document", "original")).alias("original"))


def load_runs(spark: SparkSession, sources: list[tuple[str, Column | None]], table: str,
              runs_log: str, cities: DataFrame, run_id: str, quarantine: str,
              created_at: datetime | None = None, as_of: datetime | None = None,
              base: str | None = None, marts: tuple[str, ...] = warehouse.MARTS) -> LoadResult:
    """Load landed runs into the readings table (K2), log the run (K4) and check the table (Q4).

    One pass parses the documents, writes their rows to a stage and observes
    the counters (A17): rows read, stored and rejected, the cities seen, those
    in error and the days touched, one entry a city and day. The upsert and the
    quarantine read the stage. Each city is loaded on its own terms: what
    cannot be stored goes to the ``quarantine`` table (partition ``run_id``,
    replaced when the run is repeated) with its text, everything else is
    upserted. ``errors`` counts the cities with no landed document, an
    unreadable one or a rejected row; any error makes the run ``partial``.
    ``report`` is the data-quality report as of ``as_of`` (default: now); its
    issues are logged and never fail the load. With ``base``, the daily state
    and the ``marts`` there are rebuilt for the touched days.
    """
    as_of, stage = as_of or datetime.now(), scratch_dir(spark, "load")
    stored = F.col("reason").isNull() & F.col("pos").isNotNull()
    failed = F.col("reason").isNotNull()
    observed, seen = quality.observed(
        staged_rows(read_runs(spark, sources), cities), f"load_{run_id}",
        read=F.count_if(F.col("pos").isNotNull() | failed), stored=F.count_if(stored), rejected=F.count_if(failed),
        cities=F.collect_set("city"), cities_in_error=F.collect_set(F.when(failed, F.col("city"))),
        days=F.collect_set(F.when(stored, F.to_date("timestamp"))))
    observed.write.parquet(stage)
    got, rows = seen.get, spark.read.schema(observed.schema).parquet(stage)
    touched = sinks.upsert(spark, table, rows.where(stored).drop("city", "reason", "original"),
                           in_files=True, dates=got["days"])
    sinks.append_once(rows.where(failed).select("city", "reason", "original"), quarantine, "run_id", run_id,
                      any_rows=got["rejected"] > 0)
    slugs = spark.createDataFrame([(c,) for c in got["cities"]], "slug string")
    absent = cities.select(X.slug("name").alias("slug")).join(slugs, "slug", "left_anti").distinct().count()
    errors = absent + len(got["cities_in_error"])
    files.remove(spark, stage)
    sinks.log_run(spark, runs_log, run_id, got["stored"], errors, created_at)
    report = quality.dq_report(spark.read.parquet(table), as_of).collect()
    for row in report:
        if not row["passed"]:
            log.warning("run %s: %s", run_id, row["message"])
    if base:
        warehouse.refresh(spark, base, spark.read.parquet(table), staging.stg_cities(cities), as_of, touched, marts)
    counters = {"read": got["read"], "stored": got["stored"], "rejected": got["rejected"], "cities_in_error": errors}
    return LoadResult(run_id, got["stored"], errors, got["rejected"], report, touched, counters)
