"""The whole run: gate, curate, answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.plans.answers import result_tables, run_analytics
from marquee.plans.curation import curate
from marquee.sinks import new_version
from marquee.sources import require_inputs


def run(
    spark: SparkSession,
    raw_root: str,
    curated_root: str,
    analytics_root: str,
    fmt: str = "parquet",
    movies: str = "movies.csv",
    credits: str = "credits.csv",
    multiline: bool = True,
    staged_root: str | None = None,
    split_records: bool = True,
    overwrite_schema: bool = False,
    **questions,
) -> dict[str, DataFrame]:
    """Fail if an extract is missing, else write curated and result tables; return the results.

    The tables of both roots change at the same moment, when all of them are written. A run that fails
    before changes none.
    """
    require_inputs(spark, raw_root, [movies, credits])
    with new_version(spark, [curated_root, analytics_root], fmt) as (curated, analytics):
        reading = (movies, credits, multiline, staged_root, split_records)
        curate(spark, raw_root, curated_root, fmt, *reading, overwrite_schema, curated)
        run_analytics(
            spark, curated, analytics_root, fmt, **questions, overwrite_schema=overwrite_schema, into=analytics
        )
    return result_tables(spark, analytics_root, fmt)
