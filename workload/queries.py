"""One query per operator over the test tables."""

from __future__ import annotations

import warnings
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.catalog import CURATED_TABLES, PREVIEW_ROWS
from marquee.functions import json_array, lenient_double, lenient_int, lenient_long
from marquee.operators import (
    explode_bridge,
    fact_select,
    filter_join_group_sum,
    filter_join_sort,
    group_count,
    join_group_avg,
    orphan_rows,
    parse_json_arrays,
    top_n,
    with_losses,
)
from marquee.plans import curation_report
from marquee.plans.curation import LOSSES
from marquee.plans.smoke import PING_ROWS
from marquee.scratch import scratch_root
from marquee.sinks import new_version, preview, save_table, write_table
from marquee.sources import literal_rows, missing_inputs, read_extract, read_table
from marquee.sources.extracts import CSV_OPTIONS
from marquee.sources.records import read_quoted_records
from workload.tables import cents, run_output, table, write_raw_csv


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("cents", cents("o_totalprice"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")


def q_filter_join_sort(spark, sf_dir, distinct=False):
    return filter_join_sort(
        _lines(spark, sf_dir),
        _orders(spark, sf_dir),
        "o_orderkey",
        F.col("l_suppkey") == 7,
        ["o_orderkey", "o_orderpriority", "cents"],
        "cents",
        spread=["l_partkey"],
        distinct=distinct,
    )


def q_top_n(spark, sf_dir):
    return top_n(
        _orders(spark, sf_dir), ["o_orderkey", "o_orderpriority", "cents"], "cents", 10, ["o_orderkey"]
    )


def q_group_count(spark, sf_dir):
    return group_count(table(spark, sf_dir, "part"), ["p_type"], "part_count")


def q_filter_join_group_sum(spark, sf_dir):
    return filter_join_group_sum(
        _lines(spark, sf_dir),
        _orders(spark, sf_dir),
        "o_orderkey",
        F.col("l_returnflag") == "R",
        ["l_suppkey"],
        "cents",
        "total_cents",
        "order_count",
    )


def q_join_group_avg(spark, sf_dir):
    return join_group_avg(
        _lines(spark, sf_dir),
        _orders(spark, sf_dir),
        "o_orderkey",
        ["l_returnflag"],
        "cents",
        "avg_cents",
    )


def q_orphan_rows(spark, sf_dir):
    """Orders without a returned line: the bridge here is the orders table."""
    returned = _lines(spark, sf_dir).filter(F.col("l_returnflag") == "R").select("o_orderkey")
    orders = _orders(spark, sf_dir).select("o_orderkey", "cents")
    return orphan_rows(orders, returned.distinct(), "o_orderkey")


def _number(name: str) -> Column:
    return F.col(name).cast("string")


def _element(number: Column, name: Column) -> Column:
    return F.struct(number.alias("id"), name.alias("name"))


def tagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with a JSON text column; the line number picks its form."""
    supplier, flag = F.col("l_suppkey"), F.col("l_returnflag")
    two = F.to_json(F.array(_element(supplier, flag), _element(F.col("l_partkey"), F.col("l_linestatus"))))
    one = F.to_json(_element(supplier, flag))
    forms = [
        two,
        one,  # an object, not an array
        F.concat(F.lit('[{"id":'), _number("l_suppkey"), F.lit("}]")),  # no name
        F.concat(F.lit('[{"id":"x","name":"'), flag, F.lit('"}]')),  # id is not a number
        F.concat(F.lit('[{"z":[1],"ID":5,"name":"'), flag, F.lit('"},null]')),  # other keys
        F.lit("[]"),
    ]
    tags = F.lit('[{"id": 1, "name":')
    for number, form in reversed(list(enumerate(forms, 1))):
        tags = F.when(F.col("l_linenumber") == number, form).otherwise(tags)
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", tags.alias("tags"))


_TAGS = {"tags": "array<struct<id:int,name:string>>"}


def q_json_array_parse(spark, sf_dir):
    """Rows per line number by what the parser made of the text."""
    parsed = parse_json_arrays(tagged_lines(spark, sf_dir), _TAGS, flag=True)
    return parsed.groupBy("l_linenumber").agg(
        F.count("*").alias("line_count"),
        F.count_if("corrupt_tags").alias("corrupt_count"),
        F.sum(F.size("tags")).alias("element_count"),
    )


def q_explode_bridge(spark, sf_dir):
    return explode_bridge(
        tagged_lines(spark, sf_dir),
        "l_orderkey",
        json_array(F.col("tags"), _TAGS["tags"]),
        [("id", "tag_id"), ("name", "tag_name")],
        ["l_linenumber"],
    )


def q_json_object_field(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", json_array(F.col("props"), "struct<k:int>")["k"].alias("k"))


_DOCUMENT = ["text", "lang", "source"]


def _documents_as_read(raw: DataFrame) -> DataFrame:
    numbers = (lenient_long(F.col(name)).alias(name) for name in ("doc_id", "n_chars"))
    return raw.select(*numbers, *_DOCUMENT)


def q_csv_scan(spark, sf_dir, split_records=True):
    """All documents through a CSV extract and back."""
    root = scratch_root(spark, "csv")
    write_raw_csv(table(spark, sf_dir, "documents"), f"{root}/documents.csv")
    raw = read_extract(
        spark, f"{root}/documents.csv", split_records=split_records, scratch=f"{root}/staged"
    )
    return _documents_as_read(raw)


def q_csv_scan_in_splits(spark, sf_dir):
    """All documents as where only Spark's readers reach the files: in splits of lines."""
    root = scratch_root(spark, "csv")
    path = f"{root}/documents.csv"
    write_raw_csv(table(spark, sf_dir, "documents"), path)
    schema = spark.read.options(header=True, multiLine=True, **CSV_OPTIONS).csv(path).schema
    raw, irregular = read_quoted_records(spark, path, schema, schema.names, CSV_OPTIONS, f"{root}/staged")
    assert not irregular
    return _documents_as_read(raw)


def q_csv_scan_single_line(spark, sf_dir):
    """All documents, their line breaks replaced, read with a record per line."""
    root = scratch_root(spark, "csv")
    flat = F.regexp_replace("text", "[\\r\\n]", " ").alias("text")
    documents = table(spark, sf_dir, "documents").withColumn("text", flat)
    write_raw_csv(documents, f"{root}/documents.csv")
    return _documents_as_read(read_extract(spark, f"{root}/documents.csv", multiline=False))


def q_csv_scan_irregular(spark, sf_dir):
    """All documents in splits, next to a file whose quotes do not tell records from lines."""
    root = scratch_root(spark, "csv")
    documents = table(spark, sf_dir, "documents")
    write_raw_csv(documents, f"{root}/documents.csv")
    few = documents.filter("n_chars < 500").select("doc_id", F.lit('5" disk').alias("text"), "lang", "source", "n_chars")
    # a quote in a bare field, as no CSV writer gives it
    lines = few.select(F.concat_ws(",", *few.columns).alias("value")).coalesce(1)
    header = literal_rows(spark, [(",".join(few.columns),)], "value string")
    header.coalesce(1).unionByName(lines).coalesce(1).write.mode("append").text(f"{root}/documents.csv")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        raw = read_extract(
            spark, f"{root}/documents.csv", split_records=True, scratch=f"{root}/staged"
        )
    return _documents_as_read(raw)


def q_lenient_cast(spark, sf_dir):
    """Every line's keys in the text form its line number picks, cast back."""
    part, supplier = _number("l_partkey"), _number("l_suppkey")
    forms = [
        part,
        F.concat(part, F.lit(".0")),
        F.concat(F.lit("-"), supplier, F.lit(".7")),
        F.concat(F.lit(" "), part, F.lit(" ")),
        F.concat(F.lit("9007199"), F.lpad(part, 12, "0"), F.lit(".5")),  # beyond 2**53
        F.concat(part, F.lit("e1")),
    ]
    text = F.lit("")
    for number, form in reversed(list(enumerate(forms, 1))):
        text = F.when(F.col("l_linenumber") == number, form).otherwise(text)
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        text.alias("raw"),
        F.col("l_extendedprice").cast("string").alias("price"),
    )
    return raw.select(
        "l_orderkey",
        "l_linenumber",
        lenient_int(F.col("raw")).alias("as_int"),
        lenient_long(F.col("raw")).alias("as_long"),
        lenient_double(F.col("price")).alias("as_double"),
    )


def q_fact_select(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    raw = orders.select(*(F.col(name).cast("string") for name in orders.columns))
    return fact_select(
        raw,
        [
            ("o_orderkey", "order_id", "long"),
            ("o_custkey", "customer_id", "int"),
            ("o_orderstatus", "status", "string"),
            ("o_totalprice", "price", "double"),
            ("cents", "cents", "long"),
        ],
    )


def q_table_roundtrip(spark, sf_dir):
    root = scratch_root(spark, "table")
    write_table(table(spark, sf_dir, "orders"), root, "orders")
    return read_table(spark, root, "orders")


def q_overwrite_idempotent(spark, sf_dir):
    """Another table first, then the orders twice: only the orders are left."""
    root = scratch_root(spark, "table")
    orders = table(spark, sf_dir, "orders")
    write_table(orders.select("o_custkey"), root, "orders")
    write_table(orders, root, "orders", rebalance=["o_custkey"], overwrite_schema=True)
    # the columns stay, in whatever order they come
    write_table(orders.select(*reversed(orders.columns)), root, "orders", rebalance=["o_custkey"])
    return read_table(spark, root, "orders")


def q_missing_inputs(spark, sf_dir):
    tables = ("orders", "lineitem", "part", "documents", "events", "absent")
    return missing_inputs(spark, sf_dir, [f"{name}.parquet" for name in tables])


def q_preview_n(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "cents")
    return preview(orders, 5, [F.col("cents").desc(), F.col("o_orderkey")])


def q_literal_rows(spark, sf_dir):
    """Literal rows as a lookup: lines per listed line number."""
    counts = group_count(table(spark, sf_dir, "lineitem"), ["l_linenumber"], "line_count")
    listed = literal_rows(spark, PING_ROWS, "l_linenumber int, text string")
    return counts.join(listed, "l_linenumber")


def q_curate_run(spark, sf_dir):
    """Genre bridge joined to the fact table, both as a run wrote them."""
    genres, movies = (run_output(spark, sf_dir, "curated", name) for name in ("genres", "movies"))
    facts = movies.select("movie_id", "revenue")
    return genres.join(facts, "movie_id").groupBy("genre_name").agg(
        F.sum("revenue").alias("revenue"), F.count("movie_id").alias("movie_count")
    )


def q_curation_report(spark, sf_dir):
    names = ("movies", "credits", LOSSES + "movies", LOSSES + "credits")
    return curation_report(*(run_output(spark, sf_dir, "staged", name) for name in names))


def q_atomic_replace(spark, sf_dir):
    """The orders, after a write of twice as many rows that failed on its last ones."""
    root = scratch_root(spark, "table")
    orders = table(spark, sf_dir, "orders")
    write_table(orders, root, "orders")
    fails = F.when(F.col("o_orderkey") >= 0, F.raise_error(F.lit("half way"))).otherwise(F.col("o_custkey"))
    broken = read_table(spark, root, "orders").unionByName(orders.withColumn("o_custkey", fails.cast("long")))
    try:
        write_table(broken, root, "orders")
    except Exception as error:  # Spark's own or the raised one, by version
        if "half way" not in str(error):
            raise
    return read_table(spark, root, "orders")


def q_version_set(spark, sf_dir):
    """Two tables that change together: a published set, and one that failed before it was."""
    root = scratch_root(spark, "table")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")

    def publish(share, fail=False):
        with new_version(spark, [f"{root}/a", f"{root}/b"]) as (first, second):
            save_table(orders.filter(f"o_orderkey % 4 < {share}"), first, "orders")
            if fail:
                raise InterruptedError
            save_table(lines.filter(f"l_orderkey % 4 < {share}"), second, "lines")

    publish(1)
    publish(3)
    try:
        publish(4, fail=True)
    except InterruptedError:
        pass
    held = read_table(spark, f"{root}/a", "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return group_count(held.join(read_table(spark, f"{root}/b", "lines"), "l_orderkey"), ["l_linenumber"], "line_count")


def q_lost_elements(spark, sf_dir):
    """Elements per line number whose id or name holds a value that parsing does not give."""
    counted = with_losses(tagged_lines(spark, sf_dir), [], _TAGS)
    return counted.groupBy("l_linenumber").agg(
        F.sum("lost_tags_id").alias("lost_ids"), F.sum("lost_tags_name").alias("lost_names")
    )


def q_declared_scan(spark, sf_dir):
    """Three declared columns of the orders; a column that is not stored is refused."""
    columns = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"
    try:
        read_table(spark, sf_dir, "orders.parquet", schema=f"{columns}, o_nothing int")
    except ValueError:
        return read_table(spark, sf_dir, "orders.parquet", schema=columns)
    raise AssertionError("a column that is not there was read")


QUERIES = {
    "top_n": q_top_n,
    "filter_join_sort": q_filter_join_sort,
    "filter_join_sort_distinct": partial(q_filter_join_sort, distinct=True),
    "group_count": q_group_count,
    "filter_join_group_sum": q_filter_join_group_sum,
    "join_group_avg": q_join_group_avg,
    "orphan_rows": q_orphan_rows,
    "json_array_parse": q_json_array_parse,
    "explode_bridge": q_explode_bridge,
    "json_object_field": q_json_object_field,
    "csv_scan": q_csv_scan,
    "csv_scan_in_splits": q_csv_scan_in_splits,
    "csv_scan_whole_files": partial(q_csv_scan, split_records=False),
    "csv_scan_single_line": q_csv_scan_single_line,
    "csv_scan_irregular": q_csv_scan_irregular,
    "lenient_cast": q_lenient_cast,
    "fact_select": q_fact_select,
    "table_roundtrip": q_table_roundtrip,
    "overwrite_idempotent": q_overwrite_idempotent,
    "missing_inputs": q_missing_inputs,
    "preview_n": q_preview_n,
    "literal_rows": q_literal_rows,
    "curate_run": q_curate_run,
    "curation_report": q_curation_report,
    "atomic_replace": q_atomic_replace,
    "version_set": q_version_set,
    "lost_elements": q_lost_elements,
    "declared_scan": q_declared_scan,
    **{f"curated_{n}": partial(run_output, layer="curated", name=n) for n in CURATED_TABLES},
    **{f"answer_{n}": partial(run_output, layer="analytics", name=n) for n in PREVIEW_ROWS},
}
