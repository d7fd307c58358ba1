"""Published tables: whole versions, partial rebuilds, concurrent builds, tidying."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from stratus.operators import publish as P
from stratus.session import scratch_dir


def rows(spark, path):
    return sorted(tuple(r) for r in P.read_published(spark, path).collect())


def frame(spark, values):
    return spark.createDataFrame(values, "day string, v int")


def test_a_reader_sees_one_version_whole(spark):
    path = scratch_dir(spark, "t-pub")
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, path)
    P.publish(frame(spark, [("a", 1), ("b", 2)]), path)
    old = P.read_published(spark, path)
    P.publish(frame(spark, [("c", 3)]), path)
    # planned before the rebuild, run after it: the old table, with all its rows
    assert sorted(tuple(r) for r in old.collect()) == [("a", 1), ("b", 2)]
    assert rows(spark, path) == [("c", 3)]


def test_a_build_that_fails_changes_nothing(spark):
    from pyspark.sql import functions as F
    path = scratch_dir(spark, "t-pub-fail")
    P.publish(frame(spark, [("a", 1)]), path)
    bad = frame(spark, [("a", 2)]).withColumn("v", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception):
        P.publish(bad, path)
    assert rows(spark, path) == [("a", 1)] and P.version(spark, path).number == 1


def test_partitions_are_replaced_and_others_keep_their_files(spark):
    path = scratch_dir(spark, "t-pub-part")
    first = P.publish(frame(spark, [("d1", 1), ("d2", 2), ("d3", 3), ("d 4/x", 4)]), path, ["day"])
    second = P.publish(frame(spark, [("d2", 20), ("d5", 5)]), path, ["day"], ["d2", "d3", "d5"])
    assert rows(spark, path) == [(1, "d1"), (4, "d 4/x"), (5, "d5"), (20, "d2")]   # d3 has no rows any more
    assert second.folders["day=d1"] == first.folders["day=d1"] and second.folders["day=d2"] != first.folders["day=d2"]
    with pytest.raises(ValueError):
        P.publish(frame(spark, [("d9", 9)]), path, ["day"], ["d1"])
    P.publish(frame(spark, []), path, ["day"], ["d1", "d2", "d5", "d%204"])
    P.publish(frame(spark, []), path, ["day"])
    assert rows(spark, path) == [] and P.read_published(spark, path).columns == ["v", "day"]


def test_builds_at_the_same_time_add_up(spark):
    path = scratch_dir(spark, "t-pub-both")
    P.publish(frame(spark, [(f"d{i}", 0) for i in range(6)]), path, ["day"])
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: P.publish(frame(spark, [(f"d{i}", i)]), path, ["day"], [f"d{i}"]), range(6)))
    assert rows(spark, path) == [(i, f"d{i}") for i in range(6)] and P.version(spark, path).number == 7


def test_a_partition_filter_prunes_before_files_are_opened(spark):
    from pyspark.sql import functions as F
    path = scratch_dir(spark, "t-pub-prune")
    P.publish(frame(spark, [(f"d{i}", i) for i in range(9)]), path, ["day"])
    P.publish(frame(spark, [("d3", 33)]), path, ["day"], ["d3"])
    one = P.read_published(spark, path).where(F.col("day") == "d3")
    assert len(one.inputFiles()) >= 1 and [tuple(r) for r in one.collect()] == [(33, "d3")]
    assert one.select(F.input_file_name()).distinct().count() == 1


def test_tidy_keeps_what_kept_versions_name(spark):
    path = scratch_dir(spark, "t-pub-tidy")
    P.publish(frame(spark, [("d1", 1), ("d2", 2)]), path, ["day"])
    for v in (20, 200, 2000):
        P.publish(frame(spark, [("d2", v)]), path, ["day"], ["d2"])
    reader = P.read_published(spark, path)
    assert P.tidy(spark, path, keep=2) == 2        # d2 of the first two versions
    assert rows(spark, path) == sorted(tuple(r) for r in reader.collect()) == [(1, "d1"), (2000, "d2")]
    folders = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("build=")]
    assert len(folders) == 4 and P.tidy(spark, path, keep=2) == 0
