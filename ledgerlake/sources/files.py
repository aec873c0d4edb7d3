"""Files without a job: existence, bytes, names, and small texts.

Asked through Hadoop's file system, so they work for any store Spark reads.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def bytes_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path``."""
    fs, p = _path(spark, path)
    return fs.getContentSummary(p).getLength()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it is not there)."""
    fs, p = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """A file with this text, complete as soon as it can be seen; False if
    there is one already (written beside it, then renamed without overwriting)."""
    fs, p = _path(spark, path)
    fs.mkdirs(p.getParent())
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{p.getParent()}/.{uuid.uuid4().hex}.part")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    none = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = none
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(p).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(part), fs.makeQualified(p), options)
        return True
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        fs.delete(part, False)
        return False
