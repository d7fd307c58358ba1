"""Table sources (S2, S3, S5, S6): the dimension, the readings table, marts, the run log.

Tables are Parquet directories (the readings and streaming tables are
partitioned by ``reading_date``); a declared schema avoids inference and keeps
types stable across files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus import schemas as S


def read_table(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """A declared source or materialised mart, by path (or catalog name)."""
    if "/" not in path and ":" not in path:
        return spark.table(path)
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", "true")
    return r.load(path)


def read_cities(spark: SparkSession, path: str, fmt: str = "parquet",
                columns: list[str] | None = None) -> DataFrame:
    """The city dimension (all rows), optionally projected; ids are the key.

    The reference lists cities ``ORDER BY id``; the order only matters to
    callers that iterate, so :func:`cities_in_order` applies it explicitly.
    """
    df = read_table(spark, path, S.CITIES if fmt != "parquet" else None, fmt)
    return df.select(*columns) if columns else df


def cities_in_order(cities: DataFrame) -> DataFrame:
    return cities.orderBy(F.col("id").asc_nulls_last())


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """S3: the readings table (partitioned by ``reading_date``)."""
    return spark.read.parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The pipeline run log."""
    return spark.read.parquet(path)
