"""File operations on any file system that Spark can reach."""

from __future__ import annotations

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as file listings have it."""
    files, place = _opened(spark, path)
    return files.makeQualified(place).toString()


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _opened(spark, path)
    return files.exists(place)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies right below a folder; an absent one has nothing."""
    files, place = _opened(spark, folder)
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; an absent one is fine."""
    files, place = _opened(spark, path)
    files.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder. The target must not exist: it would take the folder in."""
    files, place = _opened(spark, source)
    if exists(spark, target):
        raise FileExistsError(target)
    if not files.rename(place, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """What a small file holds; None if there is none."""
    files, place = _opened(spark, path)
    try:
        stream = files.open(place)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileNotFoundException":
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file at once: a reader sees the old text or the new one.

    The text goes to a file beside, which then takes the name. Where that cannot replace a file, as in
    object stores, a file is written in one piece when it is closed.
    """
    files, place = _opened(spark, path)

    def create(target) -> None:
        stream = files.create(target, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    hadoop = spark._jvm.org.apache.hadoop.fs
    beside = hadoop.Path(place.getParent(), f".{place.getName()}.{uuid4().hex}")
    try:
        context = hadoop.FileContext.getFileContext(place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri())
    except Py4JJavaError:
        create(place)
        return
    create(beside)
    overwrite = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    overwrite[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context.rename(files.makeQualified(beside), files.makeQualified(place), overwrite)
