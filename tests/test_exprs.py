"""Column expressions on boundary inputs (staging validation, labels, scores)."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import D
from stratus.functions import exprs as X


def _one(spark, schema, rows, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_range_validation_inclusive(spark):
    rows = [(D(v),) for v in (-90, 60, -90.01, 60.01, None)]
    got = _one(spark, "t decimal(5,2)", rows, X.in_range_or_null("t", -90, 60))
    assert [g[0] for g in got] == [D("-90.00"), D("60.00"), None, None, None]


def test_humidity_range_and_one_sided(spark):
    got = _one(spark, "h smallint", [(0,), (100,), (-1,), (101,), (None,)],
               X.in_range_or_null("h", 0, 100), X.at_least_or_null("h", 0))
    assert got == [(0, 0), (100, 100), (None, None), (None, 101), (None, None)]


def test_c_to_f_exact_decimal(spark):
    got = _one(spark, "t decimal(5,2)", [(D("20.55"),), (D("-40"),), (D("65"),), (None,)],
               X.c_to_f("t"))
    assert [g[0] for g in got] == [D("68.99"), D("-40.00"), None, None]


def test_weather_labels(spark):
    codes = [0, 1, 2, 3, 45, 48, 51, 53, 55, 61, 63, 65, 71, 73, 75, 77, 80, 81, 82, 95, 96,
             99, 4, 42, 999, None]
    got = [g[0] for g in _one(spark, "c int", [(c,) for c in codes], X.weather_label("c"))]
    assert got == (["Clear sky"] + ["Cloudy"] * 3 + ["Fog"] * 2 + ["Drizzle"] * 3
                   + ["Rain"] * 3 + ["Snow"] * 4 + ["Rain showers"] * 3
                   + ["Thunderstorm"] * 3 + ["Unknown"] * 4)


def test_suspicious_three_valued(spark):
    rows = [(None, 150), (None, None), (D(20), 50), (D(61), None), (D(-91), 50), (D(20), -1)]
    got = [g[0] for g in _one(spark, "t decimal(5,2), h int", rows,
                              X.is_suspicious("t", "h"))]
    assert got == [True, False, False, True, True, True]


def test_extreme_predicate_matches_reference_cases(spark):
    # out-of-range temperatures as in the reference's unit test: 61, -91 flagged
    got = [g[0] for g in _one(spark, "t double", [(61.0,), (-91.0,), (35.5,), (-20.0,), (None,)],
                              ((F.col("t") < -90) | (F.col("t") > 60)))]
    assert got == [True, True, False, False, None]


def test_event_priority(spark):
    rows = [(D(36), D(10), D(0), "Thunderstorm"), (D(36), D(70), D(0), "Rain"),
            (D(-11), D(70), D(20), "Rain"), (D(0), D(61), D(20), "Rain"),
            (D(0), D(0), D("10.01"), "Rain")]
    args = ("t", "w", "p", "c")
    got = _one(spark, "t decimal(5,2), w decimal(5,2), p decimal(6,2), c string", rows,
               X.event_type(*args), X.is_extreme_event(*args))
    assert got == [("Thunderstorm", True), ("Heatwave", True), ("Freeze", True),
                   ("High winds", True), ("Heavy rain", True)]


def test_event_bounds_are_strict(spark):
    rows = [(D(35), D(60), D(10), "Rain"), (D(-10), D(0), D(0), "Fog")]
    got = _one(spark, "t decimal(5,2), w decimal(5,2), p decimal(6,2), c string", rows,
               X.is_extreme_event("t", "w", "p", "c"))
    assert got == [(False,), (False,)]


def test_region_mapping(spark):
    conts = ["Europe", "Africa", "Asia", "Oceania", "North America", "South America",
             "Middle East", None]
    got = [g[0] for g in _one(spark, "c string", [(c,) for c in conts], X.region_of("c"))]
    assert got == ["EMEA", "EMEA", "APAC", "APAC", "AMER", "AMER", "OTHER", "OTHER"]


def test_exact_avg_rounds_once(spark):
    df = spark.createDataFrame([(1, D("1.23")), (1, D("1.24")), (2, D("0.01")), (2, D("0.00")),
                                (2, D("0.00")), (3, D("-0.125")), (4, None)],
                               "g int, x decimal(6,3)")
    got = dict(df.groupBy("g").agg(X.exact_avg("x", 2, in_scale=3).alias("a")).collect())
    # 1.235 -> 1.24 (half away from zero); 0.00333.. -> 0.00; -0.125 -> -0.13; all NULL -> NULL
    assert got == {1: D("1.24"), 2: D("0.00"), 3: D("-0.13"), 4: None}


def test_exact_avg_boundary_just_below_half(spark):
    # mean = 0.004999.. (1 + 0.00 * 999 .. ) must round down to 0.00
    rows = [(D("0.01"),)] * 499 + [(D("0.00"),)] * 500
    df = spark.createDataFrame(rows, "x decimal(5,2)")
    assert df.agg(X.exact_avg("x", 2)).first()[0] == D("0.00")


def test_exact_stddev_matches_textbook(spark):
    vals = [D("2.00"), D("4.00"), D("4.00"), D("4.00"), D("5.00"), D("5.00"), D("7.00"),
            D("9.00")]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(5,2)")
    sd, mean = df.agg(X.exact_stddev_samp("x"), X.exact_mean("x")).first()
    assert abs(sd - 2.1380899352993952) < 1e-12 and mean == 5.0
    one = spark.createDataFrame([(D(1),)], "x decimal(5,2)")
    assert one.agg(X.exact_stddev_samp("x")).first()[0] is None


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([(c,) for c in ["Rain", "Rain", "Fog", "Fog", "Snow"]], "c string")
    assert df.agg(F.mode("c", deterministic=True)).first()[0] == "Fog"


def test_z_score_and_severity(spark):
    # reference unit test: mean 15, stddev 5, temperature 27 -> 2.4, anomaly
    df = spark.createDataFrame([(27.0, 15.0, 5.0), (30.1, 15.0, 5.0), (15.0, 15.0, 0.0)],
                               "t double, m double, s double")
    z = X.z_score("t", "m", "s")
    got = [tuple(r) for r in df.select(F.round(z, 3), X.severity(z), X.is_anomaly(z)).collect()]
    assert got == [(2.4, "significant", True), (3.02, "extreme", True), (None, "normal", None)]


def test_iqr_score_centres_on_mean(spark):
    df = spark.createDataFrame([(12.0, 10.0, 8.0, 12.0), (12.0, 10.0, 9.0, 9.0)],
                               "t double, m double, a double, b double")
    got = [r[0] for r in df.select(X.iqr_score("t", "m", "a", "b")).collect()]
    assert got == [0.5, None]


def test_since_bounds(spark):
    as_of = datetime(2024, 1, 30, 12)
    rows = [(datetime(2024, 1, 30, 10),), (datetime(2024, 1, 30, 10, 0, 1),),
            (datetime(2024, 1, 31),)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("ts", T.TimestampNTZType())]))
    got = [tuple(r) for r in df.select(X.since("ts", as_of, "2 hours", ntz=True),
                                       X.since("ts", as_of, "2 hours", True, ntz=True)).collect()]
    assert got == [(False, True), (True, True), (True, True)]


def test_slug_and_landing_key(spark):
    df = spark.createDataFrame([("New York", datetime(2026, 4, 6, 14, 0)), ("São Paulo",
                                datetime(2026, 4, 6, 0, 0))],
                               T.StructType([T.StructField("n", T.StringType()),
                                             T.StructField("ts", T.TimestampNTZType())]))
    got = [tuple(r) for r in df.select(X.slug("n"), X.landing_key("n", "ts")).collect()]
    assert got[0] == ("new_york", "city=new_york/year=2026/month=04/day=06/hour=14/data.json")
    assert got[1][0] == "são_paulo"


def test_parse_hour_lenient(spark):
    df = spark.createDataFrame([("2026-04-06T00:00",), ("2026-04-06T01:00:07.5",), ("junk",)],
                               "s string")
    got = [r[0] for r in df.select(X.parse_hour("s").cast("string")).collect()]
    assert got == ["2026-04-06 00:00:00", "2026-04-06 01:00:07.5", None]
