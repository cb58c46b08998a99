"""Smoke job: does the session plan and run anything?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.sources import literal_rows

# The two rows of the smoke job.
PING_ROWS = ((1, "Hello"), (2, "World"))


def ping(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, PING_ROWS, "id int, text string")
