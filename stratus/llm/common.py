"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus import files
from stratus.session import scratch_dir

# A word is a run of characters other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a fresh table under the shared checkpoint folder and read back.

    Cuts the lineage: later jobs re-read files any executor can reach.
    """
    return _written(df, scratch_dir(df.sparkSession, purpose))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Rounds:
    """The table that an iteration rewrites every round: like :func:`written`, and the round before is removed.

    For tables of which no earlier round is used again.
    """

    def __init__(self, purpose: str):
        self.purpose, self.path = purpose, None

    def write(self, df: DataFrame) -> DataFrame:
        before, self.path = self.path, scratch_dir(df.sparkSession, self.purpose)
        out = _written(df, self.path)
        if before:
            files.remove(df.sparkSession, before)
        return out


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct: columns added beside it cannot clash with the table's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked_row(df: DataFrame, row: str, **changed: Column) -> list[Column]:
    """The columns of ``df`` out of the struct ``row``, those in ``changed`` replaced."""
    return [(changed[c] if c in changed else F.col(row).getField(c)).alias(c) for c in df.columns]


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its 0-based position in ``order`` as ``name``, without one global sort task.

    Rows are range-partitioned and written with their partition number; the
    positions inside a partition are offset by the counts of the partitions
    before it (one row per partition).
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.repartitionByRange(parts, *order)
                      .withColumn("__part", F.spark_partition_id()), "numbered")
    counts = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select(  # at most ``parts`` rows
        "__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return (dealt.join(F.broadcast(before), "__part")
                 .withColumn(name, inside + F.col("__before") - 1)
                 .drop("__part", "__before"))
