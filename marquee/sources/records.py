"""CSV records with quoted line breaks, read in splits rather than file by file.

A line starts inside a quoted field when an odd number of quotes precedes it in its file.
No task needs to see a whole file for that. While a split is scanned, running counts are
kept beside its lines. One row per split then tells, by a running sum, how each split
begins, and with it every line knows its state. A line that is a record by itself, which
most are, goes straight on. Only the lines of longer records are shuffled, by record, and
it does not matter whether those cross a split border.

That holds where quotes stand only around a field or doubled inside a quoted field, as RFC
4180 says. Every line is checked for it in the state it turns out to have, and a file with any
other quote is left out and named rather than misread. Records end in LF or CRLF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.scratch import scratch_root

# Fixed value: Spark's own bound on the bytes of one string.
MAX_RECORD = 2**31

_SPLIT = ["file", "split"]

# Partition columns travel with the lines under names of their own.
_CARRIED = "_in_"

# A field that starts in a line: quoted, up to its closing quote or on beyond the line, or bare.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+(?:"|\z)|[^",]*+)'
# A line in which every quote has its place, if it starts outside or inside of quotes. No
# quantifier gives back what it took, so a line is read once.
_OUTSIDE = rf"^{_FIELD}(?:,{_FIELD})*+\r?\z"
_INSIDE = rf'^[^"]*+(?:""[^"]*+)*+(?:"(?:,{_FIELD})*+\r?)?\z'


def _has_stray_quote(line: Column, inside: bool) -> Column:
    """Whether a line has a quote that is not at a field's border, nor doubled inside one, if the
    line starts ``inside`` or outside of quotes.

    Lines that in truth start the other way mostly fail by their first quote already.
    """
    return F.contains(line, F.lit('"')) & ~line.rlike(_INSIDE if inside else _OUTSIDE)


def _ending(line: Column) -> Column:
    """How a line up to its LF goes on: 0 plainly, 1 with a CR before the LF, 2 with a lone CR."""
    place = F.instr(line, "\r")
    return F.when(place == 0, 0).when(place == F.length(line), 1).otherwise(2)


def _running_counts() -> Callable[[Column], Column]:
    """Counts over the lines of a scan task, in scan order.

    ``quotes`` is the number of odd lines before a line, ``evens`` and ``odds`` the number of
    lines up to it that have an even or odd ``quotes``.
    """

    # local, so that executors need no copy of this package
    @F.arrow_udf("struct<quotes: bigint, evens: bigint, odds: bigint>")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        quotes = evens = odds = 0
        for batch in batches:
            odd = batch.to_numpy(zero_copy_only=False).astype(np.int64)
            before = quotes + np.cumsum(odd) - odd
            starts_odd = before % 2
            odd_lines = odds + np.cumsum(starts_odd)
            even_lines = evens + np.cumsum(1 - starts_odd)
            yield pa.StructArray.from_arrays(
                [pa.array(before), pa.array(even_lines), pa.array(odd_lines)],
                ["quotes", "evens", "odds"],
            )
            if len(odd):
                quotes, evens, odds = int(before[-1] + odd[-1]), int(even_lines[-1]), int(odd_lines[-1])

    return counts


def stage_lines(spark: SparkSession, path: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Write the lines of all files with their place and running counts, and a row per split.

    Split borders depend on the cores at hand when a scan is planned. The written tables
    fix them for the steps that follow, also when executors come and go.
    """
    value = F.col("value")
    marks = F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"')))
    scan = spark.read.option("lineSep", "\n").text(path)
    places = scan.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
        F.when(F.col("_metadata.file_block_start") == 0, _ending(F.col("value"))).alias("ending"),
        F.endswith("value", F.lit("\r")).alias("cr"),
        (~value.isin("", "\r")).alias("filled"),
        "value",
        *(F.col(name).alias(_CARRIED + name) for name in scan.columns if name != "value"),
    )
    flagged = places.withColumns(
        {
            "odd": (marks % 2).cast("tinyint"),
            "bad_outside": _has_stray_quote(value, inside=False),
            "bad_inside": _has_stray_quote(value, inside=True),
        }
    )
    counted = flagged.withColumn("counts", _running_counts()("odd"))
    counted.write.mode("overwrite").parquet(f"{target}/lines", compression="zstd")
    lines = spark.read.parquet(f"{target}/lines")

    def irregular(outside: int) -> Column:
        """A bad line, and a line that ends a record by LF alone, if ``outside`` is the parity
        of quotes outside of quotes."""
        starts_outside = F.col("counts.quotes") % 2 == outside
        ends_outside = (F.col("counts.quotes") + F.col("odd")) % 2 == outside
        bad = F.when(starts_outside, F.col("bad_outside")).otherwise(F.col("bad_inside"))
        return F.struct(F.bool_or(bad).alias("bad"), F.bool_or(ends_outside & ~F.col("cr")).alias("lf"))

    lines.groupBy(*_SPLIT).agg(
        F.sum("odd").alias("odd"),
        irregular(0).alias("if_0"),
        irregular(1).alias("if_1"),
        F.min("counts.quotes").alias("quotes"),
        F.min_by("ending", "line").alias("ending"),
        F.min(F.when(F.col("filled"), F.col("counts.evens"))).alias("filled_evens"),
        F.min(F.when(F.col("filled"), F.col("counts.odds"))).alias("filled_odds"),
        *(
            bound(f"counts.{name}").alias(f"{end}_{name}")
            for end, bound in (("first", F.min), ("last", F.max))
            for name in ("evens", "odds")
        ),
    ).write.mode("overwrite").parquet(f"{target}/splits")
    return lines, spark.read.parquet(f"{target}/splits")


def split_states(splits: DataFrame) -> DataFrame:
    """How each split begins and ends, one row per split.

    ``closed`` is the parity of ``quotes`` at which a line starts outside quotes, ``origin``
    the split holding the start of the record that is open where this split begins.
    """
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    begins_open = F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1
    states = (
        splits.withColumn("begins_open", begins_open)
        .withColumn("ends_open", (F.col("odd") + F.col("begins_open").cast("int")) % 2 == 1)
        .withColumn("closed", (F.col("quotes") + F.col("begins_open").cast("int")) % 2)
    )
    # a split inside one long record neither begins nor ends it
    starts_one = F.col("ends_open") & ~(F.col("begins_open") & (F.col("odd") == 0))
    origin = F.last(F.when(starts_one, F.col("split")), ignorenulls=True).over(earlier)

    def record(end: str) -> Column:
        # of the lines that start outside of quotes in truth
        return F.when(F.col("closed") == 0, F.col(f"{end}_evens")).otherwise(F.col(f"{end}_odds"))

    return states.select(
        *_SPLIT,
        "odd",
        F.when(F.col("closed") == 0, F.col("if_0")).otherwise(F.col("if_1")).alias("lines"),
        # as Spark does, take the first line end of a file for all of them
        F.max("ending").over(Window.partitionBy("file")).alias("ending"),
        # the header is the first line with anything in it
        F.min(F.when(F.col("filled_evens").isNotNull(), F.col("split")))
        .over(Window.partitionBy("file"))
        .alias("header_split"),
        record("filled").alias("header_record"),
        "begins_open",
        "ends_open",
        "closed",
        F.when(F.col("begins_open"), origin).alias("origin"),
        record("first").alias("first_record"),
        record("last").alias("last_record"),
    )


def irregular_files(states: DataFrame) -> list[str]:
    """Files whose records cannot be told from their lines; a row comes back for each of them.

    A record longer than a string can be is an error, as no reader could give it.
    """
    mixed_ends = (F.col("ending") == 2) | ((F.col("ending") == 1) & F.col("lines.lf"))
    per_file = states.groupBy("file").agg(
        (F.bool_or(F.col("lines.bad") | mixed_ends) | (F.sum("odd") % 2 == 1)).alias("irregular"),
        F.max(F.col("split") - F.col("origin")).alias("longest"),
    )
    longest = per_file.filter("not irregular").agg(F.max("longest")).first()[0] or 0
    if longest > MAX_RECORD:
        raise ValueError(f"a record of {longest} bytes or more is longer than a Spark string can be")
    return [row["file"] for row in per_file.filter("irregular").select("file").collect()]


def assemble_records(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Staged lines of the files in ``states`` to one row per CSV record: ``value`` and what else
    the scan gives, headers left out. Spark broadcasts the states if their table is small."""
    carried = [name for name in lines.columns if name.startswith(_CARRIED)]
    inside = F.col("counts.quotes") % 2 != F.col("closed")
    record = F.when(F.col("closed") == 0, F.col("counts.evens")).otherwise(F.col("counts.odds"))
    unended = F.expr("if(ending = 1 and endswith(value, '\\r'), left(value, length(value) - 1), value)")
    numbered = (
        lines.drop("ending")
        .join(states, _SPLIT)
        .withColumns({"inside": inside, "record": record, "value": unended})
    )
    header = (F.col("split") == F.col("header_split")) & (F.col("record") == F.col("header_record"))
    alone = ~F.col("inside") & (F.col("odd") == 0)
    single = numbered.filter(alone & ~header).select("value", *carried)

    head = F.col("begins_open") & (F.col("record") == F.col("first_record"))
    tail = F.col("ends_open") & (F.col("record") == F.col("last_record"))
    several = (
        numbered.filter(~alone)
        .groupBy(
            "file",
            F.when(head, F.col("origin")).otherwise(F.col("split")).alias("start"),
            F.when(head | tail, -1).otherwise(F.col("record")).alias("record"),
        )
        .agg(
            F.expr("listagg(value, '\\n') within group (order by split, line)").alias("value"),
            F.bool_or(header).alias("header"),
            *(F.first(name).alias(name) for name in carried),
        )
        .filter("not header")
        .select("value", *carried)
    )
    return single.unionByName(several)


def read_quoted_records(
    spark: SparkSession,
    path: str,
    schema: StructType,
    columns: Sequence[str],
    options: Mapping[str, str],
    scratch: str | None = None,
) -> tuple[DataFrame, list[str]]:
    """Rows of CSV files of any size, equal to a ``multiLine`` scan with a header, and the files left
    out as irregular. ``schema`` is what the files hold; of ``columns`` the rest are partition columns."""
    target = scratch or scratch_root(spark, "records")
    lines, splits = stage_lines(spark, path, target)
    split_states(splits).write.mode("overwrite").parquet(f"{target}/states")
    states = spark.read.parquet(f"{target}/states")
    irregular = irregular_files(states)
    regular = states.filter(~F.col("file").isin(irregular)) if irregular else states
    records = assemble_records(lines, regular.drop("odd", "lines")).filter(F.length("value") > 0)
    parsed = F.from_csv("value", schema.toDDL(), {**options, "multiLine": "true"})
    row = records.withColumn("_row", parsed)
    # a partition column stands for a column of its name in the files
    partitions = {name.removeprefix(_CARRIED) for name in records.columns} - {"value"}
    taken = [F.col(_CARRIED + name) if name in partitions else F.col("_row")[name] for name in columns]
    return row.select(*(column.alias(name) for column, name in zip(taken, columns))), irregular
