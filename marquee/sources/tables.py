"""Tables addressed by root and name on any file system Spark can reach."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from marquee.storage import children, exists, move, read_text, write_text

# Where a root keeps versions of its tables, and the file that says which of them count. No reader of
# the root takes either for data.
VERSIONS = "_versions"
POINTER = "_current"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


@dataclass
class Pointer:
    """The version of each table: ``tables``, or ``pending`` ones as soon as the file ``mark`` exists."""

    tables: dict[str, str] = field(default_factory=dict)
    pending: dict[str, str] = field(default_factory=dict)
    mark: str | None = None


def read_pointer(spark: SparkSession, root: str) -> Pointer:
    """Which versions count now; nothing is pending in the answer."""
    while True:
        text = read_text(spark, table_path(root, POINTER))
        found = Pointer(**json.loads(text)) if text else Pointer()
        if not found.mark:
            return found
        if exists(spark, found.mark):
            return Pointer(found.pending)
        # the mark goes as soon as the pointer says the same without it
        if text == read_text(spark, table_path(root, POINTER)):
            return Pointer(found.tables)


def write_pointer(spark: SparkSession, root: str, pointer: Pointer) -> None:
    write_text(spark, table_path(root, POINTER), json.dumps(vars(pointer), sort_keys=True))


def staged_name(name: str) -> str:
    """What the folder of a table that is about to take its place begins with."""
    return f".{name}.new-"


def table_location(spark: SparkSession, root: str, name: str) -> str:
    """The folder of a table: of its current version, if the root keeps versions of it.

    A job that dies between the two renames of a replacement leaves the new table beside its name,
    whole; it is put there now.
    """
    version = read_pointer(spark, root).tables.get(name)
    if version:
        return table_path(root, f"{VERSIONS}/{version}/{name}")
    path = table_path(root, name)
    if not exists(spark, path):
        for beside in sorted(children(spark, root)):
            if beside.startswith(staged_name(name)) and exists(spark, table_path(root, f"{beside}/_SUCCESS")):
                move(spark, table_path(root, beside), path)
                break
    return path


def table_names(spark: SparkSession, root: str) -> list[str]:
    """The tables of a root, those it keeps versions of and those in plain folders."""
    plain = [name for name in children(spark, root) if not name.startswith((".", "_"))]
    return sorted({*plain, *read_pointer(spark, root).tables})


def read_table(
    spark: SparkSession, root: str, name: str, fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """A table as it is now. The frame stays with the version it was made from.

    With a ``schema``, the columns of the table are those: what is not stored, or stored as another type,
    is an error rather than NULL, and what else is stored is not read.
    """
    reader = spark.read.format(fmt)
    path = table_location(spark, root, name)
    if schema is None:
        return reader.load(path)
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    stored = reader.load(path)
    kinds = {column.name: column.dataType.simpleString() for column in stored.schema}
    wrong = [
        f"{column.name} {column.dataType.simpleString()} (stored: {kinds.get(column.name, 'no such column')})"
        for column in declared
        if kinds.get(column.name) != column.dataType.simpleString()
    ]
    if wrong:
        raise ValueError(f"{path} does not have the declared columns: {', '.join(wrong)}")
    return stored.select(*declared.names)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A few rows given in the program, with a DDL schema."""
    return spark.createDataFrame(list(rows), schema)
