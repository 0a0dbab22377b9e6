"""Path checks through the file system that Spark itself uses."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _resolve(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target  # noqa: SLF001


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return bool(fs.exists(target))


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return bool(fs.exists(target)) and bool(fs.getFileStatus(target).isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    fs, target = _resolve(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(target)] if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")  # noqa: SLF001
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _resolve(spark, path)
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _hidden_beside(path: str) -> str:
    folder, _, _ = path.rpartition("/")
    return f"{folder}/_{uuid.uuid4().hex}"


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content; False, and no change, if it exists.

    The content goes to a hidden file that then gets the name. Where the file system of Spark replaces a file in a
    rename (a local one), a hard link does what the rename cannot."""
    fs, target = _resolve(spark, path)
    temporary = _hidden_beside(path)
    _write_text(spark, temporary, text)
    try:
        if fs.getScheme() == "file":
            local = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
            plain = lambda p: local(p).toUri().getPath()
            try:
                os.link(plain(temporary), plain(path))
            except FileExistsError:
                return False
            return True
        return not fs.exists(target) and bool(fs.rename(_resolve(spark, temporary)[1], target))
    finally:
        if exists(spark, temporary):
            remove(spark, temporary)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Give a file a new content in one step: readers see the old or the new one."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    temporary = _hidden_beside(path)
    _write_text(spark, temporary, text)
    source, target = jvm.org.apache.hadoop.fs.Path(temporary), jvm.org.apache.hadoop.fs.Path(path)
    qualified = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(source)  # noqa: SLF001
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)  # noqa: SLF001
    options[0] = rename.OVERWRITE
    context.rename(source, target, options)


def any_match(spark: SparkSession, pattern: str) -> bool:
    fs, target = _resolve(spark, pattern)
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
