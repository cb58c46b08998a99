"""Test tables, and raw extracts rendered from them row by row (no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.plans import run
from marquee.scratch import scratch_root
from marquee.sources import read_table

ACTOR = "Supplier 7"

_RAW_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(price: str) -> Column:
    return F.round(F.col(price) * 100).cast("bigint")


# Extracts of a whole run are many times their tables: packed, in files that are little work each.
_PACKED_CSV = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 50_000}


def write_raw_csv(df: DataFrame, path: str, **options) -> None:
    df.write.options(**_RAW_CSV, **options).mode("overwrite").csv(path)


def _json(*elements: dict[str, Column]) -> Column:
    structs = [F.struct(*(value.alias(name) for name, value in e.items())) for e in elements]
    return F.to_json(F.array(*structs))


def _order_title(key: str) -> Column:
    return F.concat(F.lit("Order "), F.col(key).cast("string"))


def raw_movies(orders: DataFrame) -> DataFrame:
    """Orders as a movie extract: priorities play genres, with empty and broken arrays among them."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    price = cents("o_totalprice")
    date = F.col("o_orderdate")
    one = {"id": order, "name": priority}
    genres = (
        F.when(priority == "5-LOW", "[]")
        .when(priority == "4-NOT SPECIFIED", F.lit('[{"id": 35, "name":'))
        .when(priority == "3-MEDIUM", _json(one))
        .otherwise(_json(one, {"id": customer, "name": status}))
    )
    return orders.select(
        F.concat(price.cast("string"), F.lit(".7")).alias("budget"),
        genres.alias("genres"),
        F.when(status == "O", F.concat(F.lit("http://o/"), order.cast("string"))).alias("homepage"),
        order.cast("string").alias("id"),
        # an id that is no number is lost
        F.when(status == "P", _json({"id": F.concat(F.lit("k"), customer.cast("string")), "name": F.lower(priority)}))
        .otherwise(_json({"id": customer, "name": F.lower(priority)}))
        .alias("keywords"),
        F.lower(status).alias("original_language"),
        _order_title("o_orderkey").alias("original_title"),
        F.concat(F.lit('He said "'), priority, F.lit('",\nthen left')).alias("overview"),
        F.col("o_totalprice").cast("string").alias("popularity"),
        _json({"id": customer, "name": F.concat(F.lit("Customer "), customer.cast("string"))}).alias(
            "production_companies"
        ),
        _json({"iso_3166_1": status, "name": F.concat(F.lit("Land of "), status)}).alias(
            "production_countries"
        ),
        F.date_format(date, "yyyy-MM-dd").alias("release_date"),
        (price * 100).cast("string").alias("revenue"),
        F.when(F.dayofmonth(date) == 31, "n/a")
        .otherwise(F.concat(F.dayofmonth(date).cast("string"), F.lit(".0")))
        .alias("runtime"),
        _json({"iso_639_1": F.lower(status), "name": status}).alias("spoken_languages"),
        status.alias("status"),
        F.lit(None).cast("string").alias("tagline"),
        _order_title("o_orderkey").alias("title"),
        F.concat(F.month(date).cast("string"), F.lit(".5")).alias("vote_average"),
        F.year(date).cast("string").alias("vote_count"),
    )


def raw_credits(lineitem: DataFrame) -> DataFrame:
    """Order lines as a credits extract: two roles and one job each, no job for flag N."""
    supplier = F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string"))
    line, part = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    roles = _json(
        {
            "cast_id": line,
            "character": F.col("l_linestatus"),
            "credit_id": F.concat(F.lit("c"), part),
            "gender": F.lit(2),
            "id": F.col("l_suppkey"),
            "name": supplier,
            "order": line,
        },
        {
            "cast_id": line + 10,
            "character": F.col("l_returnflag"),
            "credit_id": F.concat(F.lit("d"), part),
            "gender": F.lit(None).cast("int"),  # left out of the JSON text
            "id": F.col("l_partkey"),
            "name": F.concat(F.lit("Part "), part),
            "order": F.lit(None).cast("int"),
        },
    )
    job = F.when(F.col("l_returnflag") == "R", "Director").otherwise("Writer")
    jobs = _json(
        {
            "credit_id": F.concat(F.lit("w"), part),
            "department": F.col("l_linestatus"),
            "gender": F.lit(1),
            "id": F.col("l_suppkey"),
            "job": job,
            "name": supplier,
        }
    )
    return lineitem.select(
        F.col("l_orderkey").cast("string").alias("movie_id"),
        _order_title("l_orderkey").alias("title"),
        roles.alias("cast"),
        F.when(F.col("l_returnflag") == "N", "[]").otherwise(jobs).alias("crew"),
    )


_runs: dict[tuple[str, str], str] = {}


def render_extracts(spark: SparkSession, sf_dir: str, root: str) -> None:
    write_raw_csv(raw_movies(table(spark, sf_dir, "orders")), f"{root}/movies.csv", **_PACKED_CSV)
    write_raw_csv(raw_credits(table(spark, sf_dir, "lineitem")), f"{root}/credits.csv", **_PACKED_CSV)


def finished_run(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a whole run over rendered extracts, made once per session and data."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _runs:
        root = scratch_root(spark, "run")
        render_extracts(spark, sf_dir, f"{root}/raw")
        run(
            spark,
            f"{root}/raw",
            f"{root}/curated",
            f"{root}/analytics",
            staged_root=f"{root}/staged",
            actor=ACTOR,
        )
        _runs[key] = root
    return _runs[key]


def run_output(spark: SparkSession, sf_dir: str, layer: str, name: str) -> DataFrame:
    return read_table(spark, f"{finished_run(spark, sf_dir)}/{layer}", name)
