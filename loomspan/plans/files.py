"""Questions to the file system of a path, through Spark's own access to it."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _at(spark, path)
    return files.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none if there is no such folder."""
    where, files = _at(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(where)) if files.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    where, files = _at(spark, path)
    files.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    where, files = _at(spark, path)
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that is there whole or not at all; False, and nothing done, if there is one already."""
    where, files = _at(spark, path)
    if files.exists(where):
        return False
    made, _ = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = files.create(made)
    out.write(bytearray(text.encode()))
    out.close()
    return files.rename(made, where)
