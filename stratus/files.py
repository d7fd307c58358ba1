"""Files and folders through the file system of their path (local, HDFS or an object store)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> set[str]:
    """Names in a folder (one listing); empty when it does not exist."""
    folder, fs = _open(spark, path)
    return {f.getPath().getName() for f in fs.listStatus(folder)} if fs.exists(folder) else set()


def sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files in a folder and their bytes (one listing)."""
    folder, fs = _open(spark, path)
    if not fs.exists(folder):
        return {}
    return {f.getPath().getName(): f.getLen() for f in fs.listStatus(folder)
            if f.isFile() and not f.getPath().getName().startswith(("_", "."))}


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and modification times of a file or of all files below a folder."""
    folder, fs = _open(spark, path)
    found, out = fs.listFiles(folder, True), []
    while found.hasNext():
        f = found.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def read_text(spark: SparkSession, path: str) -> str:
    folder, fs = _open(spark, path)
    stream = fs.open(folder)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole text if there is none yet; False if there is one.

    The text is written aside and moved in. The move fails where the file
    exists: by a hard link on a local file system, by ``rename`` on HDFS. A
    store without such a rename needs one writer at a time.
    """
    target, fs = _open(spark, path)
    fs.mkdirs(target.getParent())
    aside, _ = _open(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.tmp")
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            try:
                os.link(aside.toUri().getPath(), target.toUri().getPath())
                return True
            except FileExistsError:
                return False
        return not fs.exists(target) and fs.rename(aside, target)
    finally:
        if fs.exists(aside):
            fs.delete(aside, False)


def remove(spark: SparkSession, path: str) -> None:
    folder, fs = _open(spark, path)
    fs.delete(folder, True)
