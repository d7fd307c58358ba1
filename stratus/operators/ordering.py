"""Sorts, latest-row and top-k (O1-O6) with explicit null ordering.

The reference's engine sorts NULLs as if larger than every value (ASC puts
them last, DESC first); Spark's defaults are the opposite, so every order here
spells out its null placement. Top-k adds a total tie-break so results are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.session import scratch_dir


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def asc_nulls_last(c) -> Column:
    """Ascending, NULLs last."""
    return _c(c).asc_nulls_last()


def desc_nulls_first(c) -> Column:
    """O3: descending, NULLs first."""
    return _c(c).desc_nulls_first()


def order_by(df: DataFrame, *specs: Column) -> DataFrame:
    """O1/O2: multi-key sort with mixed directions (range-partitioned global sort)."""
    return df.orderBy(*specs)


def top_k(df: DataFrame, k: int, *specs: Column) -> DataFrame:
    """The first ``k`` rows under ``specs``.

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: each partition keeps
    its own top ``k`` and only those reach the final merge, so no global sort
    and no shuffle of the input.
    """
    return df.orderBy(*specs).limit(k)


def latest(df: DataFrame, *specs: Column) -> DataFrame:
    """``ORDER BY ... LIMIT 1``."""
    return top_k(df, 1, *specs)


def ranked(df: DataFrame, name: str, *specs: Column) -> DataFrame:
    """O1-O4 as data: ``df`` with its 1-based place under ``specs``, without one task that sorts all.

    The range-partitioned global sort is written once with the number of its
    partition; a row's place is its place inside its partition plus the rows of
    the partitions before (one row a partition).
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "ranked")
    inside = F.monotonically_increasing_id()
    (df.orderBy(*specs).withColumn("__part", F.shiftright(inside, 33))
       .withColumn("__inside", inside.bitwiseAND(F.lit((1 << 33) - 1))).write.parquet(path))
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return (rows.join(F.broadcast(before), "__part")
                .withColumn(name, F.col("__before") + F.col("__inside") + 1).drop("__part", "__inside", "__before"))
