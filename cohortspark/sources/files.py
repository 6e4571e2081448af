"""Listing, testing and deleting paths on whatever file system they name."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """File and folder names directly below ``folder``; none when it does not exist."""
    fs, p = _at(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False when there is one already. Of several callers one gets True."""
    fs, p = _at(spark, path)
    fs.mkdirs(p.getParent())
    try:
        fs.create(p, False).close()
    except Py4JJavaError as e:
        if fs.exists(p):
            return False
        raise e
    return True


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
