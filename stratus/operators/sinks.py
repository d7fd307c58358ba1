"""Table sinks on Parquet: upsert (K2), insert-if-absent (K3), run log (K4), marts (K7/K8).

Tables are Parquet directories partitioned by a date column, so a load
rewrites only the dates it touches: a dynamic partition overwrite stages its
files and moves them in when the whole job has succeeded. Rows are dealt to
the writing tasks by date, with large dates split and small ones put together
by size, so the number of files per date follows its bytes.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus import files
from stratus import schemas as S
from stratus.operators.publish import publish
from stratus.session import scratch_dir

PARTITION_COL = "reading_date"


def table_exists(spark: SparkSession, path: str) -> bool:
    return any(not n.startswith(("_", ".")) for n in files.children(spark, path))


def touched_dates(rows: DataFrame) -> list[date]:
    """Days present in a load or micro-batch: one entry a day."""
    return sorted(r[0] for r in rows.select(PARTITION_COL).distinct().collect() if r[0] is not None)


def touched_target(spark: SparkSession, path: str, dates: list[date]) -> DataFrame | None:
    """The target table restricted to ``dates``, or None where it holds none of them.

    Only their ``reading_date=`` directories are read: a load or micro-batch
    never reads the whole (multi-year) table.
    """
    found = sorted({f"{PARTITION_COL}={d.isoformat()}" for d in dates} & files.children(spark, path))
    if not found:
        return None
    return spark.read.option("basePath", path).parquet(*[f"{path.rstrip('/')}/{d}" for d in found])


def latest_per_key(updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last write wins: for each key keep the row with the greatest ``order`` tuple.

    A ``max_by`` aggregate, so duplicates of one key are combined map-side
    before the shuffle (a hot key never lands whole in one task).
    """
    values = [c for c in updates.columns if c not in keys and c not in order]
    picked = (updates.groupBy(*keys)
              .agg(F.max_by(F.struct(*values), F.struct(*order)).alias("__v")))
    return picked.select(*keys, *[F.col("__v")[c].alias(c) for c in values])


def first_per_key(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First write wins within a batch: the row with the smallest ``order`` tuple per key."""
    values = [c for c in batch.columns if c not in keys and c not in order]
    picked = (batch.groupBy(*keys)
              .agg(F.min_by(F.struct(*values), F.struct(*order)).alias("__v")))
    return picked.select(*keys, *[F.col("__v")[c].alias(c) for c in values])


def _with_partition(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumn(PARTITION_COL, F.to_date(ts_col))


def _by_date(df: DataFrame, keys: list[str]) -> DataFrame:
    """Deal rows to writing tasks by date, sized by bytes, sorted for the partitioned writer."""
    return df.hint("rebalance", PARTITION_COL).sortWithinPartitions(PARTITION_COL, *keys)


def upsert(spark: SparkSession, path: str, updates: DataFrame,
           keys: list[str] = S.READING_KEY, order: list[str] = ("run_ts", "pos"),
           ts_col: str = "timestamp", in_files: bool = False, dates: list[date] | None = None) -> list[date]:
    """K2: ``INSERT ... ON CONFLICT (keys) DO UPDATE`` — the latest update replaces all measures.

    1. ``updates`` are written once as they come, unless the caller has them
       ``in_files`` already. ``dates`` are their days, where the caller knows.
    2. The target's rows of these days and the updates are reduced together to
       the last write per key (landing order ``order``, a stored row before
       any update): one shuffle on the key, combined map-side.
    3. The result replaces the touched partitions (dynamic overwrite), and the
       files of step 1 are removed.

    Returns the touched dates, which drive the rebuild of what derives from them.
    """
    stage, order = None, list(order)
    if not in_files:
        stage = scratch_dir(spark, "updates")
        updates.write.parquet(stage)
        updates = spark.read.parquet(stage)
    rows = _with_partition(updates, ts_col)
    dates = touched_dates(rows) if dates is None else sorted(dates)
    target = touched_target(spark, path, dates)
    if target is not None:
        before = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order]
        stored = target.select("*", *before)
        rows = stored.unionByName(rows.select(*stored.columns))
    (_by_date(latest_per_key(rows, keys, order), keys).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COL).parquet(path))
    if stage:
        files.remove(spark, stage)
    return dates


def insert_absent(spark: SparkSession, path: str, batch: DataFrame,
                  keys: list[str] = S.READING_KEY, order: list[str] = ("offset",),
                  ts_col: str = "timestamp", dates: list[date] | None = None) -> list[date]:
    """K3: ``INSERT ... ON CONFLICT DO NOTHING`` — the first write of a key wins.

    Within the batch the earliest row (by ``order``, e.g. the source offset)
    per key is kept; keys already in the table are dropped by an anti join
    against the touched dates only; the rest is appended. Replaying a batch
    appends nothing, so an at-least-once source gives an exactly-once table.
    ``dates`` are the batch's days, where the caller knows them. Returns them.
    """
    order = list(order)
    first = _with_partition(first_per_key(batch, keys, order), ts_col)
    if dates is None:
        dates = touched_dates(_with_partition(batch.select(ts_col), ts_col))
    target = touched_target(spark, path, dates)
    if target is not None:
        new = first.join(target.select(*keys), keys, "left_anti").select(*target.columns)
    else:
        new = first.select(*[c for c in first.columns if c not in order])
    _by_date(new, keys).write.mode("append").partitionBy(PARTITION_COL).parquet(path)
    return dates


# A day is rewritten once it has more files than this, and they are small on average.
MAX_FILES = 16
SMALL_BYTES = 64 * 1024 * 1024


def crowded(spark: SparkSession, path: str, dates: list[date], max_files: int = MAX_FILES,
            small_bytes: int = SMALL_BYTES) -> list[date]:
    """Those of ``dates`` with more than ``max_files`` files of less than ``small_bytes`` on average.

    From listings alone, one a date; no file is opened.
    """
    out = []
    for d in dates:
        found = files.sizes(spark, f"{path.rstrip('/')}/{PARTITION_COL}={d.isoformat()}")
        if len(found) > max_files and sum(found.values()) < small_bytes * len(found):
            out.append(d)
    return out


def compact(spark: SparkSession, path: str, dates: list, keys: list[str] = S.READING_KEY) -> None:
    """Rewrite the given dates of a table with files sized by bytes (after many small appends)."""
    rows = touched_target(spark, path, dates)
    if rows is not None:
        (_by_date(rows, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                             .partitionBy(PARTITION_COL).parquet(path))


def append_once(df: DataFrame, path: str, name: str, value, any_rows: bool = True) -> None:
    """Write ``df`` as partition ``name=value``; running it again replaces that partition only.

    A caller that knows ``df`` to be empty says so (``any_rows``): the partition is removed, nothing is run.
    """
    if not any_rows:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(
            name, str(value))
        files.remove(spark, f"{path.rstrip('/')}/{folder}")
        return
    (df.withColumn(name, F.lit(value)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path))


CLAIMS = "_claims"


def claim_id(spark: SparkSession, path: str, run_id: str) -> int:
    """The next id of a run log, claimed by a file that can be created once only.

    Runs at the same time get different ids, in the order of their claims, and
    no row of the log is read. A run that fails later leaves a gap, as a
    sequence does. A log without claims (written before there were any) is
    read once for its greatest id.
    """
    claims = f"{path.rstrip('/')}/{CLAIMS}"
    taken = [int(n) for n in files.children(spark, claims) if n.isdigit()]
    if taken:
        n = max(taken) + 1
    elif table_exists(spark, path):
        n = (spark.read.parquet(path).agg(F.max("id")).first()[0] or 0) + 1
    else:
        n = 1
    while not files.create_once(spark, f"{claims}/{n:012d}", run_id):
        n += 1
    return n


def log_run(spark: SparkSession, path: str, run_id: str, rows_loaded: int, errors: int,
            created_at: datetime | None = None) -> DataFrame:
    """K4/Q9: append one run-log row; ``rows_fetched = rows_loaded + errors``.

    ``status`` is ``success`` without errors, else ``partial``; ``created_at``
    defaults to the current time. ``id`` continues the log's sequence.
    """
    row = spark.createDataFrame(
        [(claim_id(spark, path, run_id), run_id, None, rows_loaded + errors, rows_loaded,
          "success" if errors == 0 else "partial", None, None, created_at)],
        S.PIPELINE_RUNS)
    if created_at is None:
        row = row.withColumn("created_at", F.current_timestamp())
    row.write.mode("append").parquet(path)
    return row


def build_mart(df: DataFrame, path: str, partition_by: list[str] | None = None,
               replaces: list[str] | None = None, note: str = "") -> None:
    """K7: build a mart (``materialized='table'``) and publish it at ``path``.

    Readers (:func:`publish.read_published`) see the old mart until the new one
    is complete. ``replaces`` rebuilds only these values of the first partition
    column.
    """
    publish(df, path, partition_by, replaces, note)


def stage_view(df: DataFrame, name: str) -> DataFrame:
    """K8: a staging model as a lazy temp view (``materialized='view'``)."""
    df.createOrReplaceTempView(name)
    return df
