"""Small files beside tables, through the file system that Spark uses for their path."""

from __future__ import annotations

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    location, fs = _at(spark, path)
    return fs.exists(location)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is missing."""
    location, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(location)) if fs.exists(location) else []


def read_text(spark: SparkSession, path: str) -> str:
    location, fs = _at(spark, path)
    stream = fs.open(location)
    try:
        size = fs.getFileStatus(location).getLen()
        return bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, *, overwrite: bool = True) -> bool:
    """Write a small file. Without ``overwrite``, False if it is there already.

    The text is written beside its place and renamed there in one step, so no reader sees half of it
    and of two writers one succeeds.
    """
    jvm = spark.sparkContext._jvm
    parent, name = path.rsplit("/", 1)
    location, fs = _at(spark, path)
    draft, _ = _at(spark, f"{parent}/.{name}.{uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if overwrite else rename.NONE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    try:
        context.rename(draft, location, options)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True
