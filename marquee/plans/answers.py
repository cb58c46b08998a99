"""The five result tables over the curated tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import catalog
from marquee.operators import (
    filter_join_group_sum,
    filter_join_sort,
    group_count,
    join_group_avg,
    top_n,
)
from marquee.plans.curation import curated_tables, write_tables
from marquee.sinks import preview, show_preview
from marquee.sources import read_table

# Defaults of the questions.
ACTOR = "Tom Cruise"
DIRECTOR = "Director"
TOP = 10

# The column each result is ranked by.
RANKED_BY = {
    "tom_cruise_revenue": "revenue",
    "top_revenue_movies": "revenue",
    "genre_popularity": "movie_count",
    "top_directors": "total_revenue",
    "avg_rating_per_genre": "avg_rating",
}

_MOVIE = ["movie_id", "title", "revenue"]


def analytics_frames(
    tables: Mapping[str, DataFrame],
    actor: str = ACTOR,
    job: str = DIRECTOR,
    top: int = TOP,
) -> dict[str, DataFrame]:
    """The questions as DataFrames, each in ranked order.

    One actor's movies by revenue (a row per role), the highest grossing movies, movies per
    genre, revenue per director name, and the average rating per genre.
    """
    movies, genres = tables["movies"], tables["genres"]
    key = catalog.KEY
    return {
        "tom_cruise_revenue": filter_join_sort(
            tables["cast"],
            movies,
            key,
            F.col("person_name") == actor,
            _MOVIE,
            "revenue",
            spread=["credit_id"],
        ),
        "top_revenue_movies": top_n(movies, _MOVIE, "revenue", top, ties=[key]),
        "genre_popularity": group_count(genres, ["genre_name"], "movie_count"),
        "top_directors": filter_join_group_sum(
            tables["crew"],
            movies,
            key,
            F.col("job") == job,
            ["person_name"],
            "revenue",
            "total_revenue",
            "movie_count",
        ),
        "avg_rating_per_genre": join_group_avg(
            genres, movies, key, ["genre_name"], "vote_average", "avg_rating"
        ),
    }


def run_analytics(
    spark: SparkSession,
    curated_root: str,
    analytics_root: str,
    fmt: str = "parquet",
    actor: str = ACTOR,
    job: str = DIRECTOR,
    top: int = TOP,
    show: bool = False,
    overwrite_schema: bool = False,
    into: str | None = None,
) -> dict[str, DataFrame]:
    """Write the result tables, which change all at once, and return them as read back.

    Each question runs once; previews come from the written table. With ``into``, a folder of a version of
    ``analytics_root``, the caller publishes.
    """
    tables = curated_tables(spark, curated_root, fmt, ("movies", "cast", "crew", "genres"))
    frames = analytics_frames(tables, actor, job, top)
    write_tables(frames, analytics_root, fmt, {}, overwrite_schema, into)
    written = result_tables(spark, into or analytics_root, fmt)
    if show:
        show_results(written)
    return written


def result_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    return {name: read_table(spark, root, name, fmt) for name in RANKED_BY}


def show_results(tables: Mapping[str, DataFrame]) -> None:
    """Print the first rows of each result."""
    for name, table in tables.items():
        n = catalog.PREVIEW_ROWS[name]
        rank = RANKED_BY[name]
        ties = [F.col(other) for other in table.columns if other != rank]
        show_preview(preview(table, n, [F.col(rank).desc(), *ties]), n)
