"""Raw CSV extracts with a header, doubled quotes and line breaks inside quoted fields."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.ranges import listed_files, reachable, read_ranges
from marquee.sources.records import read_quoted_records

# Quoting of the extracts.
CSV_OPTIONS = {"quote": '"', "escape": '"'}


def read_extract(
    spark: SparkSession,
    path: str,
    multiline: bool = True,
    split_records: bool = True,
    scratch: str | None = None,
) -> DataFrame:
    """Read an extract as text columns named by its header, and its partition columns.

    Files are read in byte ranges (see :mod:`marquee.sources.ranges`), so that a file of any size is no
    more than a task's work. Without ``split_records``, Spark's ``multiLine`` scan reads each file in one
    task. Both give the same rows. Files with quotes or line ends by which records cannot be told from
    lines are left to that scan, with a warning. Gzip files are read in a task per file, with a warning.

    Reading in ranges runs a first pass when this is called. Files that tasks cannot open by themselves, as
    they lie where only Spark's readers reach, are read in splits of lines instead (see
    :mod:`marquee.sources.records`), which writes every column of the extract to ``scratch``: keep that folder
    until the frame has been used.

    ``multiline=False`` ends a record at every line break, also inside quotes.
    """
    reader = spark.read.options(header=True, multiLine=multiline, **CSV_OPTIONS)
    plain = reader.csv(path)
    if not (multiline and split_records):
        return plain
    # without partition discovery, only what the files hold
    own = reader.option("recursiveFileLookup", True).csv(path).schema
    listed = listed_files(spark, path)
    first = listed.first()
    if first is not None and reachable(spark, first["_file"]):
        records, irregular = read_ranges(spark, listed, own, plain.columns, CSV_OPTIONS)
    else:
        records, irregular = read_quoted_records(spark, path, own, plain.columns, CSV_OPTIONS, scratch)
    if not irregular:
        return records
    warnings.warn(f"{path}: {len(irregular)} irregular files are read in a task per file", stacklevel=2)
    # the scan is narrowed to those files when it is planned
    return records.unionByName(plain.filter(F.col("_metadata.file_path").isin(irregular)))
