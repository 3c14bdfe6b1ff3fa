"""Small files that at most one writer can put in place."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def on_storage(spark: SparkSession, path: str) -> tuple:
    """The path and the file system it is on."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it does not exist."""
    where, files = on_storage(spark, folder)
    return [status.getPath().getName() for status in files.listStatus(where)] if files.exists(where) else []


def exists(spark: SparkSession, path: str) -> bool:
    where, files = on_storage(spark, path)
    return files.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    where, files = on_storage(spark, path)
    files.delete(where, True)


def put_if_absent(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Write a file whole, or not at all and return false if there is one of that name."""
    draft, files = on_storage(spark, f"{folder}/_{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    final = files.makeQualified(hadoop.Path(f"{folder}/{name}"))
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration()).rename(
            files.makeQualified(draft), final, no_options
        )
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True
