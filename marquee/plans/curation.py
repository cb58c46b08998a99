"""Raw extracts to the curated tables.

The extracts are read, cast and parsed once, into two staged tables with native arrays.
The eight curated tables then come from column-pruned parquet scans of those, instead of
from eight scans of the CSV text with the JSON parsed again in each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from marquee import catalog
from marquee.operators import (
    explode_bridge,
    fact_select,
    loss_names,
    orphan_rows,
    parse_json_arrays,
    with_losses,
)
from marquee.operators.shaping import CORRUPT
from marquee.scratch import remove_folder, scratch_folder
from marquee.sinks import new_version, save_table, write_table
from marquee.sinks.tables import conforming
from marquee.sinks.versions import TRANSACTIONAL
from marquee.sources import literal_rows, read_extract, read_table

T = TypeVar("T")


# Staged tables of what casts and parsing lost, by extract.
LOSSES = "losses_"


# Arrays as parsed for the count of losses, by array.
PARSED = "_parsed_"


def shaped(raw: DataFrame, columns: tuple, arrays: dict[str, str], parsed_as: str | None = None) -> DataFrame:
    """Cast columns, parsed arrays and corruption flags of an extract, not yet unrolled."""
    flags = [CORRUPT + name for name in arrays]
    parsed = parse_json_arrays(raw, arrays, flag=True, parsed_as=parsed_as)
    nested = [(name, name, "string") for name in (*arrays, *flags)]
    return fact_select(parsed, [*columns, *nested])


def _observed(raw: DataFrame, columns: tuple, arrays: dict[str, str], observation: Observation) -> DataFrame:
    """The shaped extract; the sums of what its rows lost go to ``observation`` when it is written."""
    losses = loss_names(columns, arrays)
    kept = [(name, name, "string") for name in losses]  # as they are
    counted = shaped(with_losses(raw, columns, arrays, PARSED), (*columns, *kept), arrays, PARSED)
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in losses]
    return counted.observe(observation, *sums).drop(*losses)


def side_by_side(spark: SparkSession, work: Callable[[str], T], names: Iterable[str]) -> list[T]:
    """Run independent jobs at the same time, so that the last tasks of each overlap."""
    names = list(names)
    with ThreadPoolExecutor(len(names)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), names))


def curated_frames(movies: DataFrame, credits: DataFrame) -> dict[str, DataFrame]:
    """The fact table and its seven bridges from the shaped extracts."""
    frames = {"movies": movies.select(*(name for _, name, _ in catalog.MOVIE_COLUMNS))}
    for source, bridges in ((movies, catalog.MOVIE_BRIDGES), (credits, catalog.CREDIT_BRIDGES)):
        for name, spec in bridges.items():
            frames[name] = explode_bridge(source, catalog.KEY, spec.array, spec.fields, spec.carry)
    return frames


def stage_extracts(
    spark: SparkSession,
    raw_root: str,
    staged_root: str,
    movies: str = "movies.csv",
    credits: str = "credits.csv",
    multiline: bool = True,
    split_records: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Read and parse both extracts into staged parquet tables, and read those back.

    What casts and parsing lose is counted while a table is written, and staged beside it as
    ``losses_movies`` and ``losses_credits``. What reading in splits writes below ``staged_root`` is
    removed once a table is staged.
    """
    staged_root = staged_root.rstrip("/")
    shapes = {
        "movies": (movies, catalog.MOVIE_COLUMNS, catalog.MOVIE_ARRAYS),
        "credits": (credits, catalog.CREDIT_COLUMNS, catalog.CREDIT_ARRAYS),
    }

    def stage(name: str) -> DataFrame:
        file, columns, arrays = shapes[name]
        path = f"{raw_root.rstrip('/')}/{file}"
        lines = f"{staged_root}/raw_{name}"
        try:
            raw = read_extract(spark, path, multiline, split_records, lines)
            observation = Observation()
            write_table(_observed(raw, columns, arrays, observation), staged_root, name, overwrite_schema=True)
            lost = [(name, check, rows) for check, rows in observation.get.items()]
            losses = literal_rows(spark, lost, "source string, check string, rows long").coalesce(1)
            write_table(losses, staged_root, LOSSES + name, overwrite_schema=True)
        finally:
            remove_folder(spark, lines)
        return read_table(spark, staged_root, name)

    movies_table, credits_table = side_by_side(spark, stage, shapes)
    return movies_table, credits_table


def write_tables(
    frames: dict[str, DataFrame],
    root: str,
    fmt: str,
    rebalance: dict[str, list[str]],
    overwrite_schema: bool = False,
    into: str | None = None,
) -> None:
    """Replace tables below ``root``, all at once, by ones of the same columns unless ``overwrite_schema``.

    With ``into``, a folder of a version of ``root``, the tables are written there, and the caller
    publishes that version.
    """
    spark = next(iter(frames.values())).sparkSession
    if into is None:
        with new_version(spark, [root], fmt) as (folder,):
            write_tables(frames, root, fmt, rebalance, overwrite_schema, folder)
        return

    def write(name: str) -> None:
        columns = rebalance.get(name, ())
        if fmt in TRANSACTIONAL:
            write_table(frames[name], into, name, fmt, columns, overwrite_schema)
        else:
            # nobody reads the version yet, so its tables need no renaming
            save_table(conforming(frames[name], root, name, fmt, overwrite_schema), into, name, fmt, columns)

    side_by_side(spark, write, frames)


def curate(
    spark: SparkSession,
    raw_root: str,
    curated_root: str,
    fmt: str = "parquet",
    movies: str = "movies.csv",
    credits: str = "credits.csv",
    multiline: bool = True,
    staged_root: str | None = None,
    split_records: bool = True,
    overwrite_schema: bool = False,
    into: str | None = None,
) -> dict[str, DataFrame]:
    """Write the curated tables below ``curated_root`` and return them as read back.

    All tables change at once; after a failure the old ones are there. With ``into``, a folder of a version
    of that root, it is the caller who publishes. The staged tables stay in
    ``staged_root``; without one they are removed in the end, also if the run fails.
    """
    bridges = catalog.MOVIE_BRIDGES | catalog.CREDIT_BRIDGES
    rebalance = {name: [catalog.KEY] for name, spec in bridges.items() if spec.compact}
    with scratch_folder(spark, "staged", staged_root) as folder:
        staged = stage_extracts(spark, raw_root, folder, movies, credits, multiline, split_records)
        write_tables(curated_frames(*staged), curated_root, fmt, rebalance, overwrite_schema, into)
    return curated_tables(spark, into or curated_root, fmt)


def curated_tables(spark: SparkSession, root: str, fmt: str = "parquet", names: Iterable[str] = catalog.CURATED_TABLES):
    """Curated tables with the columns that the catalogue declares."""
    return {name: read_table(spark, root, name, fmt, catalog.table_schema(name)) for name in names}


def _losses(frame: DataFrame, source: str, arrays: dict[str, str]) -> DataFrame:
    checks: dict[str, Column] = {
        "rows": F.count("*"),
        "null_key": F.count_if(F.col(catalog.KEY).isNull()),
        **{CORRUPT + name: F.count_if(F.col(CORRUPT + name)) for name in arrays},
    }
    counted = frame.agg(*(check.alias(name) for name, check in checks.items()))
    return counted.unpivot([], list(checks), "check", "rows").select(
        F.lit(source).alias("source"), "check", "rows"
    )


def curation_report(movies: DataFrame, credits: DataFrame, *losses: DataFrame) -> DataFrame:
    """What the curated tables and their joins silently leave out, counted from the staged tables.

    ``rows`` per ``source`` and ``check``: all rows, rows without a usable key, arrays lost to
    malformed JSON, and credits whose movie does not exist; and as staged in ``losses``, per column the
    texts that a cast made NULL (``lost_budget``), and per field of an array the elements in which it has a
    value but came out NULL (``lost_genres_id``).
    """
    # counted per key first, so that a hot key is one row in the join
    keys = credits.groupBy(catalog.KEY).agg(F.count("*").alias("rows"))
    orphans = orphan_rows(keys, movies, catalog.KEY).agg(
        F.lit("credits").alias("source"),
        F.lit("orphans").alias("check"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
    )
    parts = [
        _losses(movies, "movies", catalog.MOVIE_ARRAYS),
        _losses(credits, "credits", catalog.CREDIT_ARRAYS),
        orphans,
        *losses,
    ]
    return reduce(DataFrame.unionByName, parts)
