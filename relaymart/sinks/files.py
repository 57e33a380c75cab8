"""Paths of tables, through the file system Spark itself uses for them.

Errors (a refused listing, a time-out) are raised, never read as "missing".
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if it does not exist."""
    fs, p = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    if fs.exists(p) and not fs.delete(p, True):
        raise OSError(f"could not remove {path}")


def listing(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names in a folder and when each was last changed (seconds); none if it does not exist."""
    fs, p = _path(spark, path)
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(p)] if fs.exists(p) else []


def create(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already."""
    fs, p = _path(spark, path)
    fs.mkdirs(p.getParent())
    return fs.createNewFile(p)
