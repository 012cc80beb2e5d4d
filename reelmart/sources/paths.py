"""Small files and names in whatever store holds a path, by Hadoop's file API.

Only names and short texts (commit files, suites) go through here; rows never do.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class NameTaken(Exception):
    """There is a file of that name."""


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def store_of(spark: SparkSession, path: str):
    """The file system that holds ``path``."""
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return store_of(spark, path).exists(hadoop_path(spark, path))


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder; nothing if it is not there."""
    if not exists(spark, folder):
        return []
    found = store_of(spark, folder).listStatus(hadoop_path(spark, folder))
    return sorted(s.getPath().getName() for s in found)


def read_text(spark: SparkSession, path: str) -> str:
    stream = store_of(spark, path).open(hadoop_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    out = store_of(spark, path).create(hadoop_path(spark, path), True)
    out.write(bytearray(text.encode()))
    out.close()


def delete(spark: SparkSession, path: str) -> None:
    store_of(spark, path).delete(hadoop_path(spark, path), True)


def rename_new(spark: SparkSession, old: str, new: str) -> None:
    """Rename in one step, unless there is a file of the new name."""
    api = spark._jvm.org.apache.hadoop.fs
    kind = getattr(api, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = api.FileContext.getFileContext(hadoop_path(spark, new).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(hadoop_path(spark, old), hadoop_path(spark, new), options)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            raise NameTaken(new) from None
        raise
