"""Data-quality and monitoring operators.

Checks are aggregates, so each is one distributed pass with map-side partial
aggregation; only the final one-row (or few-row) result reaches the driver,
and only where the reference itself acts on the value (Q5 raises).
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratus import schemas as S
from stratus.functions import exprs as X
from stratus.operators import joins

# Fixed thresholds of the reference's checks.
MIN_CITIES = 45
EXPECTED_CITIES = 50
DQ_WINDOW = "2 hours"
FRESHNESS_WINDOW = "10 minutes"
VOLUME_WINDOW = "1 hour"
MAX_NULL_RATE = 0.05
MAX_ABS_Z = 10
# Fixed issue texts of the report; {window} and {expected} are filled in.
LOW_COVERAGE = "LOW COVERAGE: only %d/{expected} cities in last {window}"
NULL_TEMPERATURES = "NULL TEMPERATURES: %d rows in last {window}"
EXTREME_VALUES = "EXTREME VALUES: %d rows outside −90°C to 60°C"


# ------------------------------------------------------ batch DQ (Q1-Q4) ---

def dq_counts(readings: DataFrame, as_of: datetime, window: str = DQ_WINDOW) -> DataFrame:
    """Q1-Q3 in one scan: recent distinct cities, NULL and out-of-range temperatures.

    The shared recency predicate is applied first so it reaches the Parquet
    reader as a pushed filter; the three counts share one aggregate.
    """
    t = F.col("temperature")
    return X.recent(readings, "timestamp", as_of, window).agg(
        F.count_distinct("city_id").alias("city_count"),
        F.count_if(t.isNull()).alias("null_count"),
        F.count_if((t < X.TEMP_MIN) | (t > X.TEMP_MAX)).alias("extreme_count"))


def _issue(passed: Column, observed: Column, text: str, window: str, expected: int) -> Column:
    return F.when(~passed, F.format_string(text.format(window=window, expected=expected), observed))


def _check(counts: DataFrame, name: str, observed: Column, passed: Column, text: str,
           window: str, expected: int = EXPECTED_CITIES) -> DataFrame:
    return counts.select(F.lit(name).alias("check_name"), observed.alias("observed"),
                         passed.alias("passed"),
                         _issue(passed, observed, text, window, expected).alias("message"))


def dq_report(readings: DataFrame, as_of: datetime, min_cities: int = MIN_CITIES,
              expected_cities: int = EXPECTED_CITIES, window: str = DQ_WINDOW) -> DataFrame:
    """Q4: one row per check: ``check_name, observed, passed, message``.

    Issues are reported, never raised: the load is not failed (as in the
    reference). ``passed`` of the whole report is ``every(passed)``.
    """
    n, nulls, extreme = F.col("city_count"), F.col("null_count"), F.col("extreme_count")
    checks = [("coverage", n, n >= min_cities, LOW_COVERAGE),
              ("null_temperatures", nulls, nulls == 0, NULL_TEMPERATURES),
              ("extreme_values", extreme, extreme == 0, EXTREME_VALUES)]
    rows = F.inline(F.array(*[F.struct(
        F.lit(name).alias("check_name"), seen.alias("observed"), ok.alias("passed"),
        _issue(ok, seen, text, window, expected_cities).alias("message"))
        for name, seen, ok, text in checks]))
    return dq_counts(readings, as_of, window).select(rows)


def check_coverage(readings: DataFrame, as_of: datetime, min_cities: int = MIN_CITIES,
                   window: str = DQ_WINDOW) -> DataFrame:
    """Q1: distinct cities in the last 2 hours against the threshold."""
    n = F.col("n")
    counts = X.recent(readings, "timestamp", as_of, window).agg(F.count_distinct("city_id").alias("n"))
    return _check(counts, "coverage", n, n >= min_cities, LOW_COVERAGE, window)


def check_nulls(readings: DataFrame, as_of: datetime, window: str = DQ_WINDOW) -> DataFrame:
    """Q2: NULL temperatures in the last 2 hours must be 0."""
    n = F.col("n")
    counts = X.recent(readings, "timestamp", as_of, window).agg(
        F.count_if(F.col("temperature").isNull()).alias("n"))
    return _check(counts, "null_temperatures", n, n == 0, NULL_TEMPERATURES, window)


def check_range(readings: DataFrame, as_of: datetime, window: str = DQ_WINDOW) -> DataFrame:
    """Q3: temperatures outside -90..60 in the last 2 hours must be 0."""
    n, t = F.col("n"), F.col("temperature")
    counts = X.recent(readings, "timestamp", as_of, window).agg(
        F.count_if((t < X.TEMP_MIN) | (t > X.TEMP_MAX)).alias("n"))
    return _check(counts, "extreme_values", n, n == 0, EXTREME_VALUES, window)


# ------------------------------------------------------ stream monitors ---

def freshness(stream_table: DataFrame, as_of: datetime,
              window: str = FRESHNESS_WINDOW) -> DataFrame:
    """Q5 summary: rows, distinct cities and latest timestamp in the last 10 minutes."""
    return (X.recent(stream_table, "timestamp", as_of, window)
            .agg(F.count(F.lit(1)).alias("recent_count"),
                 F.count_distinct("city_id").alias("city_count"),
                 F.max("timestamp").alias("latest_timestamp")))


def check_freshness(stream_table: DataFrame, as_of: datetime) -> dict:
    """Q5: raise when no streamed row arrived in the last 10 minutes.

    Collects the single summary row — the monitor must act on it.
    """
    row = freshness(stream_table, as_of).first()
    if row["recent_count"] == 0:
        raise ValueError("No streaming data in last 10 minutes — check the producer")
    return row.asDict()


def stream_volume(stream_table: DataFrame, as_of: datetime,
                  window: str = VOLUME_WINDOW) -> DataFrame:
    """Q6: rows in the last hour and distinct cities ever, in one pass."""
    return stream_table.agg(
        F.count_if(X.since("timestamp", as_of, window)).alias("hour_count"),
        F.count_distinct("city_id").alias("total_cities"))


# ------------------------------------------------- column tests (Q7/Q10) ---

def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Q10 foreign key: child rows whose non-NULL key has no parent."""
    p = joins.bounded(parent.select(F.col(pk).alias("__pk")).distinct())
    return (child.where(F.col(fk).isNotNull())
                 .join(p, F.col(fk) == F.col("__pk"), "left_anti"))


# Declared column tests of the staged models and marts (fixed, from the reference).
WEATHER_CONDITIONS = [label for label, _ in X.WEATHER_LABELS] + [X.UNKNOWN_LABEL]
REGION_VALUES = ["AMER", "EMEA", "APAC", "OTHER"]
COLUMN_TESTS = {
    "stg_weather_readings": [
        ("city_id", "not_null", None),
        ("reading_at", "not_null", None),
        ("weather_condition", "not_null", None),
        ("weather_condition", "accepted", WEATHER_CONDITIONS),
        ("is_suspicious", "not_null", None),
    ],
    "stg_cities": [
        ("id", "not_null", None),
        ("id", "unique", None),
        ("name", "not_null", None),
        ("region", "not_null", None),
        ("region", "accepted", REGION_VALUES),
    ],
    "daily_summary": [
        ("city_name", "not_null", None),
        ("date", "not_null", None),
        ("reading_count", "not_null", None),
    ],
    "temperature_anomalies": [
        ("city_name", "not_null", None),
        ("temperature_c", "not_null", None),
        ("anomaly_severity", "not_null", None),
        ("anomaly_severity", "accepted", X.SEVERITIES),
        ("is_anomaly", "not_null", None),
        # is_anomaly is NULL exactly when z is NULL (zero stddev): the same test where z exists
        ("CASE WHEN z_score IS NOT NULL THEN is_anomaly ELSE true END", "not_null", None),
    ],
    "city_comparisons": [
        ("city_name", "not_null", None),
        ("total_readings", "not_null", None),
    ],
    "weekly_trends": [
        ("city_name", "not_null", None),
        ("day", "not_null", None),
    ],
    "extreme_weather": [
        ("city_name", "not_null", None),
        ("event_type", "not_null", None),
        ("event_type", "accepted", X.EVENT_TYPES),
    ],
}


def column_tests(model: str, df: DataFrame, tests: list[tuple]) -> DataFrame:
    """Q7: run a model's column tests in one aggregate; one row per test.

    ``tests`` holds ``(column, kind, arg)`` with kind ``not_null``, ``accepted``
    (arg = allowed values) or ``unique``. Result: ``model, column, test,
    failures`` (violating rows; for ``unique``, rows beyond the first per key).
    """
    aggs, names = [], []
    for i, (col, kind, arg) in enumerate(tests):
        c = F.expr(col)
        if kind == "not_null":
            a = F.count_if(c.isNull())
        elif kind == "accepted":
            a = F.count_if(c.isNotNull() & ~c.isin(arg))
        elif kind == "unique":
            a = F.count(c) - F.count_distinct(c)
        else:
            raise ValueError(f"unknown test {kind}")
        aggs.append(a.cast("bigint").alias(f"t{i}"))
        names.append((col, kind))
    counts = df.agg(*aggs)
    pairs = ", ".join(f"'{col}', '{kind}', t{i}" for i, (col, kind) in enumerate(names))
    return counts.select(F.lit(model).alias("model"), F.expr(
        f"stack({len(names)}, {pairs}) AS (column_name, test, failures)"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---------------------------------------------------- mart invariants (Q8) ---

def mart_invariants(m3: DataFrame, m4: DataFrame, m5: DataFrame, m6: DataFrame,
                    m7: DataFrame, as_of: datetime) -> DataFrame:
    """Q8: the seven integration invariants, one row each: ``check_name, observed, passed``.

    Each input is reduced by its own one-row aggregate; the seven rows are
    then combined (a union of single rows, no join of large inputs).
    """
    n, one = F.count(F.lit(1)), F.lit(1)
    nulls = F.count_if(F.col("avg_temp_c").isNull()) / F.nullif(F.count(one), F.lit(0))
    unknown = F.when(~F.col("event_type").isin(X.EVENT_TYPES), F.col("event_type"))
    late = F.col("temp_7day_rolling_avg").isNull() & X.older_than("day", as_of, "7 days", ntz=True)
    nowhere = F.col("latitude").isNull() | F.col("longitude").isNull()
    # one aggregate per mart: (mart, [(check, observed, passed given observed)])
    marts = [
        (m3, [("daily_summary_has_rows", n, lambda x: x > 0),
              ("daily_summary_null_temp_rate", nulls,
               lambda x: F.coalesce(x < MAX_NULL_RATE, F.lit(True)))]),
        (m5, [("city_comparisons_cities", F.count_distinct("city_name"), lambda x: x >= MIN_CITIES),
              ("city_comparisons_coordinates", F.count_if(nowhere), lambda x: x == 0)]),
        (m6, [("anomalies_max_abs_z", F.max(F.abs("z_score")),
               lambda x: F.coalesce(x < MAX_ABS_Z, F.lit(True)))]),
        (m7, [("extreme_event_types_valid", F.count_distinct(unknown), lambda x: x == 0)]),
        (m4, [("weekly_rolling_avg_not_null", F.count_if(late), lambda x: x == 0)]),
    ]
    parts = []
    for mart, checks in marts:
        sums = mart.agg(*[seen.cast("double").alias(f"c{i}") for i, (_, seen, _) in enumerate(checks)])
        parts.append(sums.select(F.inline(F.array(*[F.struct(
            F.lit(name).alias("check_name"), F.col(f"c{i}").alias("observed"),
            ok(F.col(f"c{i}")).alias("passed")) for i, (name, _, ok) in enumerate(checks)]))))
    return union_all(parts)


def null_rate(df: DataFrame, col: str) -> DataFrame:
    """Share of rows where ``col`` is NULL (NULL for an empty input)."""
    return df.agg((F.count_if(F.col(col).isNull()) / F.nullif(F.count(F.lit(1)), F.lit(0)))
                  .alias("null_rate"))


# ----------------------------------------------------------- run log (Q9) ---

def run_status(errors) -> Column:
    """Q9: ``success`` when there were no errors, else ``partial``."""
    e = F.col(errors) if isinstance(errors, str) else errors
    return F.when(e == 0, F.lit("success")).otherwise(F.lit("partial"))


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Counters of a load or stage, taken while an action on the returned DataFrame runs.

    ``metrics`` are aggregates (by name); no second pass over the data. Read
    them with ``observation.get`` after the action.
    """
    obs = Observation(name)
    return df.observe(obs, *[c.alias(n) for n, c in metrics.items()]), obs


def key_checks(readings: DataFrame, cities: DataFrame, runs: DataFrame,
               days: list[date] | None = None) -> DataFrame:
    """Q10: key, foreign-key and CHECK constraints as violation counts.

    ``check_name, violations``: duplicate reading keys, readings whose city is
    missing, run statuses outside the allowed set, duplicate run ids. With
    ``days`` (those a load has touched) only these days of a table stored by
    day are read: a key's day follows from its timestamp, so no other day can
    hold its double.
    """
    if days is not None:
        readings = readings.where(F.col("reading_date").isin(days))
    dup_keys = readings.groupBy("city_id", "timestamp").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violations"))
    orphan = orphans(readings, cities, "city_id", "id").agg(
        F.count(F.lit(1)).alias("violations"))
    bad_status = runs.agg(F.count_if(F.col("status").isNotNull()
                                     & ~F.col("status").isin(S.RUN_STATUSES))
                          .alias("violations"))
    dup_ids = runs.agg((F.count("id") - F.count_distinct("id")).alias("violations"))
    named = [(n, d.select(F.lit(n).alias("check_name"), F.col("violations").cast("bigint")))
             for n, d in [("readings_duplicate_keys", dup_keys), ("readings_orphan_city", orphan),
                          ("runs_bad_status", bad_status), ("runs_duplicate_id", dup_ids)]]
    return union_all([d for _, d in named])
