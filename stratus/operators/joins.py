"""Join operators.

Dimension joins broadcast the small side only after its size is checked, at
each use, so a dimension that grew is never broadcast on an old answer; one
that fails the check is joined with a normal shuffle join (and adaptive
execution may still switch strategy at runtime from real statistics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side we broadcast is at most this large, as JSON text (an upper bound of its row size).
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
# The check stops reading here: more rows than this are never broadcast.
MAX_BROADCAST_ROWS = 500_000


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES,
                   max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """True when ``df`` holds at most ``max_bytes`` (and ``max_rows``) now.

    Reads at most ``max_rows + 1`` rows, so the check itself is bounded; the
    answer is not kept, so it is never older than the plan it decides on.
    """
    size = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    rows, held = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    return rows <= max_rows and (held or 0) <= max_bytes


def bounded(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it passes the size check, else unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join a fact table to a dimension, broadcasting the dimension if it is small."""
    return fact.join(bounded(dim, max_bytes), on, how)


def with_city(readings: DataFrame, cities: DataFrame, cols: list[str],
              key: str = "city_id") -> DataFrame:
    """Inner equi-join ``readings.city_id = cities.id``; readings without a city drop.

    ``cols`` are the city columns to carry (renamed by the caller). The
    dimension is projected before the size check, so the broadcast holds only
    what is used.
    """
    dim = cities.select(F.col("id").alias("__city_key"), *cols)
    return (join_dimension(readings, dim, F.col(key) == F.col("__city_key"))
            .drop("__city_key"))


def left_anti(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key is absent from ``target`` (``ON CONFLICT DO NOTHING``)."""
    return batch.join(target.select(*keys), keys, "left_anti")


def missing_keys(expected: DataFrame, present: DataFrame, key_expected: str,
                 key_present: str) -> DataFrame:
    """J5 helper: rows of ``expected`` with no match in ``present``."""
    p = bounded(present.select(F.col(key_present).alias("__k")).distinct())
    return expected.join(p, F.col(key_expected) == F.col("__k"), "left_anti")
