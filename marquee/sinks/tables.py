"""Full-refresh table writes and result previews."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame

from marquee.sinks.versions import TRANSACTIONAL
from marquee.sources.tables import staged_name, table_location, table_path
from marquee.storage import children, exists, move, remove

# File formats that tell their schema without reading the data.
SELF_DESCRIBING = ("parquet", "orc", "avro")


class SchemaChanged(ValueError):
    """A table would be replaced by one of other columns."""


def conforming(df: DataFrame, root: str, name: str, fmt: str, overwrite_schema: bool = False) -> DataFrame:
    """The frame with its columns in the order of the stored table ``root/name``.

    Other columns than the stored ones, by name or type, raise :class:`SchemaChanged` unless
    ``overwrite_schema`` says that they are meant. Formats that hold no schema are taken as they are.
    """
    spark = df.sparkSession
    path = table_location(spark, root, name)
    if overwrite_schema or fmt not in SELF_DESCRIBING or not exists(spark, path):
        return df
    try:
        stored = spark.read.format(fmt).load(path).schema
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return df  # a folder without a file says nothing
    old = {column.name: column.dataType.simpleString() for column in stored}
    new = {column.name: column.dataType.simpleString() for column in df.schema}
    if old != new:
        changes = [
            f"{column}: {old.get(column, 'absent')} to {new.get(column, 'absent')}"
            for column in old | new
            if old.get(column) != new.get(column)
        ]
        raise SchemaChanged(f"{path} would change its columns ({'; '.join(changes)})")
    return df.select(*(f"`{column}`" for column in old)) if list(old) != list(new) else df


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    fmt: str = "parquet",
    rebalance: Sequence[str] = (),
    overwrite_schema: bool = False,
) -> None:
    """Replace the table ``root/name``; running it again gives the same table.

    The new table is written beside the old one and takes its name when it is whole. A job that fails leaves
    the old table, and ``df`` may read the table that it replaces. Formats that commit by themselves
    do so. Where renaming is copying, as in object stores, prefer :func:`marquee.sinks.new_version`.

    ``rebalance`` evens out the files: adaptive execution merges small shuffle blocks of
    those columns up to the advisory size and splits one that is too large.
    """
    spark = df.sparkSession
    if fmt in TRANSACTIONAL:
        if rebalance:
            df = df.hint("rebalance", *rebalance)
        schema = str(overwrite_schema).lower()
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", schema).save(table_path(root, name))
        return
    df = conforming(df, root, name, fmt, overwrite_schema)
    if rebalance:
        df = df.hint("rebalance", *rebalance)
    beside = (staged_name(name), f".{name}.old-")
    left = [other for other in children(spark, root) if other.startswith(beside)]
    staged = table_path(root, f"{staged_name(name)}{uuid4().hex}")
    try:
        df.write.format(fmt).save(staged)
        _replace(df, staged, root, name)
    except BaseException:
        # a whole table whose name is free is put there by the next reader
        if exists(spark, table_path(root, name)) or not exists(spark, f"{staged}/_SUCCESS"):
            remove(spark, staged)
        raise
    for other in left:  # of jobs that died
        remove(spark, table_path(root, other))


def save_table(
    df: DataFrame, folder: str, name: str, fmt: str = "parquet", rebalance: Sequence[str] = ()
) -> None:
    """Write a table that is not there yet, such as one of a version that nobody reads before it is published.

    ``rebalance`` is as for :func:`write_table`."""
    if rebalance:
        df = df.hint("rebalance", *rebalance)
    df.write.format(fmt).save(table_path(folder, name))


def _replace(df: DataFrame, staged: str, root: str, name: str) -> None:
    spark, target = df.sparkSession, table_path(root, name)
    if not exists(spark, target):
        move(spark, staged, target)
        return
    aside = table_path(root, f".{name}.old-{uuid4().hex}")
    move(spark, target, aside)
    try:
        move(spark, staged, target)
    except BaseException:
        move(spark, aside, target)
        raise
    remove(spark, aside)


def preview(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows in a given order, as a DataFrame."""
    return df.orderBy(*order).limit(n)


def show_preview(df: DataFrame, n: int = 20) -> None:
    """Print the first ``n`` rows in full width."""
    df.show(n, truncate=False)
