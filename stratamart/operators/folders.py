"""Folders and small files, through the file system interface that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _at(spark, path)
    return system.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    system, target = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(target)) if exists(spark, path) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target must not be there yet."""
    system, old = _at(spark, source)
    _, new = _at(spark, target)
    if system.exists(new):
        raise FileExistsError(target)
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"cannot rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    system, target = _at(spark, path)
    system.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it appears whole or not at all."""
    system, target = _at(spark, path)
    _, unfinished = _at(spark, f"{path}.unfinished")
    stream = system.create(unfinished, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    system.delete(target, False)
    if not system.rename(unfinished, target):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    system, target = _at(spark, path)
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def same_system(spark: SparkSession, one: str, other: str) -> bool:
    """Whether folders can be moved between two paths."""
    return _at(spark, one)[0].getUri().equals(_at(spark, other)[0].getUri())
