"""The gate in front of a run: are all required inputs there?"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.tables import literal_rows, table_path
from marquee.storage import exists, qualified


def input_files(spark: SparkSession, path: str | list[str], deep: bool = False) -> DataFrame:
    """``path`` and ``length`` of the files a reader of these paths reads; contents are not read.

    That is the files right below it and those in partition folders (``day=1``). With ``deep`` it is
    all files at any depth. A scan gives each large file a task of its own. There is next
    to nothing to do per file here, so a few tasks per core take them all.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", deep).load(path)
    return files.select("path", "length").coalesce(4 * spark.sparkContext.defaultParallelism)


def _glob_literal(name: str) -> str:
    return re.sub(r"([{}\[\]*?,\\])", r"\\\1", name)


def listed_inputs(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """``name`` and ``path`` of every file of each input, at any depth, and whether a reader ``reads`` it:
    if all folders between are partition folders. All inputs are listed at once."""
    wanted = {name: qualified(spark, table_path(root, name)) for name in names}
    present = [name for name in names if exists(spark, wanted[name])]
    if not present:
        return literal_rows(spark, [], "name string, path string, reads boolean")
    paths = [table_path(root, _glob_literal(name)) for name in present]
    path = F.col("path")
    owners = (
        F.when((path == wanted[name]) | path.startswith(f"{wanted[name]}/"), F.struct(F.lit(name), F.lit(wanted[name])))
        for name in present
    )
    owner = F.explode(F.array_compact(F.array(*owners))).alias("owner")
    inner = F.expr("substring(path, length(owner.col2) + 1)")
    return (
        input_files(spark, paths, deep=True)
        .select("path", owner)
        .select(F.col("owner.col1").alias("name"), "path", inner.rlike(r"^(/[^/]*=[^/]*)*(/[^/]*)?$").alias("reads"))
    )


def missing_inputs(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """The names with no file that a reader would read, as a one-column DataFrame ``name``.

    An input is a file of that name or a folder of part files. Spark lists no files without
    content, so an empty input, which could not be read either, is missing. So is one whose files
    all lie in plain sub-folders. An absent root means that everything is missing.
    """
    expected = literal_rows(spark, [(name,) for name in names], "name string")
    return expected.join(listed_inputs(spark, root, names).filter("reads").select("name"), "name", "left_anti")


def unread_files(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """``name`` and ``path`` of files below an input that its reader does not read, as they lie in
    plain sub-folders."""
    return listed_inputs(spark, root, names).filter("not reads").select("name", "path")


def require_inputs(spark: SparkSession, root: str, names: Sequence[str]) -> None:
    """Raise one ``FileNotFoundError`` that lists every missing input, and a ``ValueError`` if
    files of an input would be left out."""
    # one listing answers both; at most a row per name comes back
    found = (
        listed_inputs(spark, root, names)
        .groupBy("name")
        .agg(F.bool_or("reads").alias("reads"), F.min(F.when(~F.col("reads"), F.col("path"))).alias("unread"))
        .collect()
    )
    refuse_missing(root, sorted(set(names) - {row["name"] for row in found if row["reads"]}))
    unread = sorted(row["unread"] for row in found if row["unread"])
    if unread:
        raise ValueError(f"files in sub-folders would not be read, such as {unread}")


def refuse_missing(root: str, missing: Sequence[str]) -> None:
    if missing:
        raise FileNotFoundError(f"missing inputs under {root}: {missing}")
