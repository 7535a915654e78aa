"""Hadoop file-system steps used around Spark writes (rename, delete, list)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _path(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    where, system = _path(spark, path)
    system.delete(where, True)


def replace(spark: SparkSession, fresh: str, target: str) -> None:
    """Put ``fresh`` in the place of ``target``. The old folder is moved aside first."""
    source, system = _path(spark, fresh)
    final, _ = _path(spark, target)
    aside, _ = _path(spark, f"{target.rstrip('/')}.replaced")
    if system.exists(aside):
        system.delete(aside, True)
    if system.exists(final) and not system.rename(final, aside):
        raise OSError(f"cannot move {target} aside")
    if not system.rename(source, final):
        raise OSError(f"cannot rename {fresh} to {target}")
    if system.exists(aside):
        system.delete(aside, True)


def create(spark: SparkSession, path: str) -> None:
    where, system = _path(spark, path)
    system.mkdirs(where)


def move(spark: SparkSession, source: str, target: str) -> None:
    where, system = _path(spark, source)
    final, _ = _path(spark, target)
    system.mkdirs(final.getParent())
    if not system.rename(where, final):
        raise OSError(f"cannot rename {source} to {target}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, such as a table's partitions."""
    where, system = _path(spark, path)
    return [s.getPath().getName() for s in system.listStatus(where) if s.isDirectory()]


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly under ``path``."""
    where, system = _path(spark, path)
    return [s.getPath().getName() for s in system.listStatus(where)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, on any file system that Spark reaches."""
    where, system = _path(spark, path)
    stream = system.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    where, system = _path(spark, path)
    stream = system.open(where)
    try:
        size = system.getFileStatus(where).getLen()
        return bytes(stream.readNBytes(int(size))).decode()
    finally:
        stream.close()
