"""Published tables (K7): a reader sees the old or the new table whole, also during a rebuild.

A build writes its files into a folder of its own (``build=<id>``). The last
step creates the next version file, a short list of the partition folders that
make up the table; readers take the newest one. A rebuild of some partitions
keeps the others' folders, so it writes what it replaces and nothing else. A
version number can be created once only: of two builds at a time, the second
adds its partitions to what the first has published.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus import files

VERSIONS = "_versions"
BUILD = "build"


@dataclass
class Version:
    """``folders``: outermost partition folder (``reading_date=...``; one empty name without) -> build.

    ``note``: what the builder wants to know at its next build, say what else the table was built from.
    """
    number: int
    schema: T.StructType
    folders: dict[str, str]
    note: str = ""


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in files.children(spark, f"{root}/{VERSIONS}")
                  if n.endswith(".json") and not n.startswith("."))


def _load(spark: SparkSession, root: str, number: int) -> Version:
    stored = json.loads(files.read_text(spark, f"{root}/{VERSIONS}/{number:012d}.json"))
    return Version(number, T.StructType.fromJson(stored["schema"]), stored["folders"], stored.get("note", ""))


def version(spark: SparkSession, root: str) -> Version | None:
    """The newest version, or None before the first build."""
    numbers = _numbers(spark, root.rstrip("/"))
    return _load(spark, root.rstrip("/"), numbers[-1]) if numbers else None


def publish(df: DataFrame, root: str, by: list[str] | None = None,
            replaces: list[str] | None = None, note: str = "") -> Version:
    """Write ``df`` and make it the table at ``root``.

    With ``by`` the table is partitioned. ``replaces`` lists values of the
    outermost partition column: only these are replaced (one without new rows
    is dropped), the others stay. Without it the whole table is replaced.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    build = f"{BUILD}={uuid.uuid4().hex[:12]}"
    writer = df.write
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(f"{root}/{build}")
    # read columns back in the order in which a partitioned table has them
    schema = T.StructType([f for f in df.schema if f.name not in (by or [])] + [df.schema[c] for c in by or []])
    new = {n: build for n in files.children(spark, f"{root}/{build}") if "=" in n} if by else {"": build}
    gone = {f"{by[0]}={v}" for v in replaces} if replaces is not None else set()
    if not set(new) <= gone and replaces is not None:
        raise ValueError(f"rows outside the replaced partitions: {sorted(set(new) - gone)[:3]}")
    while True:
        last = version(spark, root)
        kept = {n: b for n, b in last.folders.items() if n not in gone} if last and replaces is not None else {}
        now = Version(last.number + 1 if last else 1, schema, {**kept, **new}, note)
        if files.create_once(spark, f"{root}/{VERSIONS}/{now.number:012d}.json", json.dumps(
                {"schema": json.loads(schema.json()), "folders": now.folders, "note": note})):
            return now


def read_published(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The newest version of a published table.

    The version is fixed here: a build that ends later does not change what
    this DataFrame reads. ``first`` and ``last`` bound the values of the
    outermost partition column (as text, so for dates and months): only these
    folders are listed, of however many the table has.
    """
    root = root.rstrip("/")
    now = version(spark, root)
    if now is None:
        raise FileNotFoundError(f"nothing has been published at {root}")
    wanted = {n: b for n, b in now.folders.items() if not n or (
        (first is None or n.split("=", 1)[1] >= first) and (last is None or n.split("=", 1)[1] <= last))}
    paths = [f"{root}/{b}/{n}".rstrip("/") for n, b in sorted(wanted.items())]
    if not paths:
        return spark.createDataFrame([], now.schema)
    schema = T.StructType([*now.schema, T.StructField(BUILD, T.StringType())])
    return (spark.read.schema(schema).option("basePath", root).parquet(*paths)
                 .select(*[F.col(f"`{f.name}`") for f in now.schema]))


def tidy(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove versions before the newest ``keep`` and the folders that only they name; returns how many folders.

    Readers of the kept versions go on; a build that has not been published is not touched.
    """
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    kept = [_load(spark, root, n) for n in numbers[-keep:]]
    used = {f"{b}/{n}" for v in kept for n, b in v.folders.items()}
    removed = set()
    for number in numbers[:-keep]:
        for name, build in _load(spark, root, number).folders.items():
            if f"{build}/{name}" not in used | removed:
                files.remove(spark, f"{root}/{build}/{name}".rstrip("/"))
                removed.add(f"{build}/{name}")
        files.remove(spark, f"{root}/{VERSIONS}/{number:012d}.json")
    return len(removed)
