"""Small file-system questions and steps, through Spark's own file-system access."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; nothing for a folder that is not there."""
    fs, target = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds; nothing if it is gone already."""
    fs, target = _at(spark, path)
    fs.delete(target, True)


def size_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files and bytes below a path."""
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return 0, 0
    found = fs.getContentSummary(target)
    return found.getFileCount(), found.getLength()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _at(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a file in its place whole, by one rename; False if another is there already."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, name = path.rsplit("/", 1)
    fs, part = _at(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(part, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    nothing = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(fs.makeQualified(part), target, nothing)
    except Py4JJavaError as error:
        fs.delete(part, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True
