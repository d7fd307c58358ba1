"""Size-checked broadcast joins."""

import contextlib
import io
from datetime import datetime

from pyspark.sql import functions as F

from stratus.operators import joins


def test_bounded_keeps_output_names_per_projection(spark):
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")
    a = joins.bounded(dim.select(F.col("id").alias("a"), "name"))
    b = joins.bounded(dim.select(F.col("id").alias("b"), "name"))
    assert a.columns == ["a", "name"] and b.columns == ["b", "name"]


def test_oversized_dimension_is_not_broadcast(spark):
    dim = spark.range(10).withColumnRenamed("id", "k")
    fact = spark.range(100).select((F.col("id") % 10).alias("k"))
    assert not joins.fits_broadcast(dim, max_rows=5)
    assert not joins.fits_broadcast(dim, max_bytes=20)
    j = joins.join_dimension(fact, dim, "k", max_bytes=20)
    assert j.count() == 100


def test_a_city_added_by_another_writer_is_joined(spark, tmp_path):
    path = f"file:{tmp_path}/cities"
    spark.createDataFrame([(1, "A")], "id int, name string").write.parquet(path)
    r = spark.createDataFrame([(1, 5), (2, 6)], "city_id int, v int")

    def joined():
        return joins.with_city(r, spark.read.parquet(path), [F.col("name").alias("city_name")]).count()

    assert joined() == 1
    spark.createDataFrame([(2, "B")], "id int, name string").write.mode("append").parquet(path)
    assert joined() == 2


def test_no_broadcast_when_the_check_fails(spark, monkeypatch):
    from stratus.operators import quality
    from stratus.plans import marts
    from stratus.streaming import jobs
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a, **k: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stg = spark.createDataFrame([], "city_id int, reading_at timestamp_ntz, temperature_c decimal(5,2), "
                                        "weather_condition string")
        cities = spark.createDataFrame([], "id int, name string, country string, continent string, region string")
        messages = spark.createDataFrame([], "city_id int, temperature double")
        base = spark.createDataFrame([], "city_id int, mean_temp double, mean_temp_2dp double, stddev_temp double")
        for df in (marts.temperature_anomalies(stg, cities, datetime(2024, 1, 1)),
                   jobs.score_alerts(messages, base), quality.orphans(messages, cities, "city_id", "id")):
            out = io.StringIO()
            with contextlib.redirect_stdout(out):
                df.explain()
            assert "Broadcast" not in out.getvalue()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_with_city_drops_orphans(spark):
    cities = spark.createDataFrame([(1, "A")], "id int, name string")
    r = spark.createDataFrame([(1, 5), (2, 6)], "city_id int, v int")
    out = joins.with_city(r, cities, [F.col("name").alias("city_name")]).collect()
    assert [(x.city_id, x.city_name) for x in out] == [(1, "A")]
