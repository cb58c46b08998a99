"""The movie catalogue as data: JSON element types, curated tables, result tables.

The operators know nothing about movies; they are driven by these specs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructField, StructType

# Element types of the JSON array columns.
MOVIE_ARRAYS = {
    "genres": "array<struct<id:int,name:string>>",
    "keywords": "array<struct<id:int,name:string>>",
    "production_companies": "array<struct<id:int,name:string>>",
    "production_countries": "array<struct<iso_3166_1:string,name:string>>",
    "spoken_languages": "array<struct<iso_639_1:string,name:string>>",
}
CREDIT_ARRAYS = {
    "cast": (
        "array<struct<cast_id:int,character:string,credit_id:string,gender:int,"
        "id:int,name:string,`order`:int>>"
    ),
    "crew": (
        "array<struct<credit_id:string,department:string,gender:int,"
        "id:int,job:string,name:string>>"
    ),
}

# Columns of the fact table as (raw column, curated column, type).
MOVIE_COLUMNS = (
    ("budget", "budget", "int"),
    ("homepage", "homepage", "string"),
    ("id", "movie_id", "int"),
    ("original_language", "original_language", "string"),
    ("original_title", "original_title", "string"),
    ("overview", "overview", "string"),
    ("popularity", "popularity", "double"),
    ("release_date", "release_date", "string"),
    ("revenue", "revenue", "long"),
    ("runtime", "runtime", "int"),
    ("status", "status", "string"),
    ("tagline", "tagline", "string"),
    ("title", "title", "string"),
    ("vote_average", "vote_average", "double"),
    ("vote_count", "vote_count", "int"),
)
CREDIT_COLUMNS = (
    ("movie_id", "movie_id", "int"),
    ("title", "title", "string"),
)


@dataclass(frozen=True)
class Bridge:
    """One 1:N table: the array it unrolls and its columns as (struct field, column).

    ``compact`` marks tables whose rows are a sliver of the extract they come from.
    Written straight from the scan they would leave one tiny file per input split.
    """

    array: str
    fields: tuple[tuple[str, str], ...]
    carry: tuple[str, ...] = ()
    compact: bool = False


# The bridge tables in write order.
MOVIE_BRIDGES = {
    "genres": Bridge("genres", (("id", "genre_id"), ("name", "genre_name")), compact=True),
    "keywords": Bridge("keywords", (("id", "keyword_id"), ("name", "keyword_name")), compact=True),
    "production_companies": Bridge(
        "production_companies", (("id", "company_id"), ("name", "company_name")), compact=True
    ),
    "production_countries": Bridge(
        "production_countries",
        (("iso_3166_1", "country_code"), ("name", "country_name")),
        compact=True,
    ),
    "spoken_languages": Bridge(
        "spoken_languages",
        (("iso_639_1", "language_code"), ("name", "language_name")),
        compact=True,
    ),
}
CREDIT_BRIDGES = {
    "cast": Bridge(
        "cast",
        (
            ("cast_id", "cast_id"),
            ("character", "character"),
            ("credit_id", "credit_id"),
            ("gender", "gender"),
            ("id", "person_id"),
            ("name", "person_name"),
            ("order", "order"),
        ),
        carry=("title",),
    ),
    "crew": Bridge(
        "crew",
        (
            ("credit_id", "credit_id"),
            ("department", "department"),
            ("gender", "gender"),
            ("id", "person_id"),
            ("job", "job"),
            ("name", "person_name"),
        ),
        carry=("title",),
    ),
}

KEY = "movie_id"
CURATED_TABLES = ("movies", *MOVIE_BRIDGES, *CREDIT_BRIDGES)



def table_schema(name: str) -> StructType:
    """The declared columns of a curated table."""
    kinds = {target: kind for _, target, kind in (*MOVIE_COLUMNS, *CREDIT_COLUMNS)}
    if name == "movies":
        return StructType.fromDDL(", ".join(f"{target} {kind}" for _, target, kind in MOVIE_COLUMNS))
    bridge = (MOVIE_BRIDGES | CREDIT_BRIDGES)[name]
    element = StructType.fromDDL(f"item {(MOVIE_ARRAYS | CREDIT_ARRAYS)[bridge.array]}")["item"].dataType.elementType
    kept = StructType.fromDDL(", ".join(f"{column} {kinds[column]}" for column in (KEY, *bridge.carry)))
    return StructType([*kept, *(StructField(target, element[source].dataType) for source, target in bridge.fields)])


# Result tables and how many rows of each are previewed.
PREVIEW_ROWS = {
    "tom_cruise_revenue": 5,
    "top_revenue_movies": 20,
    "genre_popularity": 10,
    "top_directors": 10,
    "avg_rating_per_genre": 10,
}
