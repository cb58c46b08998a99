"""Casts and JSON parsing, value by value."""

import random

import pytest
from pyspark.sql import functions as F

from marquee.functions import lenient, lenient_double, lenient_int, lenient_long
from marquee.operators import explode_bridge, fact_select, loss_names, parse_json_arrays, with_losses

TEXTS = [
    None, "162", "162.0", "162.7", "-1.5", " 7 ", "\t7.9\n", "", " ", "abc", "3000000000", "1e3",
    ".5", "-.5", ".", "+.", "+", "-", "+4.", "1.2.3", "1.x", "0x1", "1 2", "12 .5", "5d", "1_0",
    "2147483647.9", "2147483648", "-2147483648.5", "9007199254740993.9", "9223372036854775807",
    "9223372036854775808", "99999999999999999999.5", "007.0", "NaN", "Infinity", "٣",
]


def texts(spark, values):
    return spark.createDataFrame([(value,) for value in values], "raw string")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_edge_table(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    expected = {
        "162": (162, 162), "162.0": (162, 162), "162.7": (162, 162), "-1.5": (-1, -1),
        " 7 ": (7, 7), "": (None, None), "abc": (None, None), "3000000000": (None, 3000000000),
        "1e3": (None, None), ".5": (0, 0), "9007199254740993.9": (None, 9007199254740993),
        "2147483647.9": (2147483647, 2147483647), "-": (None, None), "1.2.3": (None, None),
    }
    got = texts(spark, expected).select("raw", lenient_int(F.col("raw")), lenient_long(F.col("raw")))
    assert {raw: (a, b) for raw, a, b in got.collect()} == expected


@pytest.mark.parametrize("kind, to", [("int", "int"), ("long", "bigint"), ("double", "double")])
def test_same_as_a_non_ansi_cast(spark, conf, kind, to):
    rng = random.Random(7)
    noise = ["".join(rng.choices("0123456789+-. ex", k=rng.randint(0, 7))) for _ in range(3000)]
    df = texts(spark, TEXTS + noise)
    got = [str(row[0]) for row in df.select(lenient(F.col("raw"), kind)).collect()]
    conf("spark.sql.ansi.enabled", "false")
    assert got == [str(row[0]) for row in df.select(F.col("raw").cast(to)).collect()]


def test_double_keeps_text_exactly(spark):
    got = texts(spark, ["150.437577", "1e3", " 2.5 ", "", "x"]).select(lenient_double(F.col("raw")))
    assert [row[0] for row in got.collect()] == [150.437577, 1000.0, 2.5, None, None]


JSON_ROWS = {
    "[]": [],
    "": None,
    "not json": None,
    "null": None,
    "[1,2]": None,
    '[{"id": 35, "name":': None,
    '{"id":1,"name":"x"}': [(1, "x")],
    '[{"id":1}]': [(1, None)],
    '[{"id":1,"name":"x","z":9}]': [(1, "x")],
    '[{"id":"a","name":"x"}]': [(None, "x")],
    '[{"id":1.5,"name":"x"}]': [(None, "x")],
    '[{"id":99999999999,"name":"x"}]': [(None, "x")],
    "[null]": [(None, None)],
    '[{"ID":1,"NAME":"x"}]': [(None, None)],
    "[{'id':3,'name':'q'}]": [(3, "q")],
    '[{"id":1,"name":"x"},{"id":1,"name":"x"}]': [(1, "x"), (1, "x")],
}


@pytest.mark.parametrize("text", JSON_ROWS)
def test_json_edge_table(spark, text):
    df = spark.createDataFrame([("5", text), ("6", None)], "key string, tags string")
    parsed = parse_json_arrays(df, {"tags": "array<struct<id:int,name:string>>"}, flag=True)
    expected = JSON_ROWS[text]
    flags = [row["corrupt_tags"] for row in parsed.sort("key").collect()]
    assert flags == [expected is None, False]
    bridge = explode_bridge(parsed, "key", "tags", [("id", "tag_id"), ("name", "tag_name")])
    assert bridge.columns == ["key", "tag_id", "tag_name"]
    assert [tuple(row) for row in bridge.collect()] == [("5", *item) for item in expected or []]


def test_bridge_has_a_row_per_element_and_restores_the_arrays(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    element = F.struct(F.col("l_suppkey").cast("int").alias("id"), F.col("l_returnflag").alias("name"))
    raw = lines.groupBy("l_orderkey").agg(F.to_json(F.collect_list(element)).alias("tags"))
    parsed = parse_json_arrays(raw, {"tags": "array<struct<id:int,name:string>>"})
    bridge = explode_bridge(parsed, "l_orderkey", "tags", [("id", "id"), ("name", "name")])
    source = lines.select("l_orderkey", F.col("l_suppkey").cast("int").alias("id"), F.col("l_returnflag").alias("name"))
    assert bridge.count() == parsed.agg(F.sum(F.size("tags"))).first()[0] == lines.count()
    assert bridge.exceptAll(source).isEmpty() and source.exceptAll(bridge).isEmpty()


def test_fact_select_ignores_other_columns(spark):
    raw = spark.createDataFrame([("x", "1.0", "9")], "name string, id string, extra string")
    fact = fact_select(raw, [("id", "key", "int"), ("name", "title", "string")])
    assert fact.dtypes == [("key", "int"), ("title", "string")]
    assert tuple(fact.first()) == (1, "x")


LOST = {
    # id and name lost per text
    '[{"id": 1, "name": "a"}]': (0, 0),
    '[{"id": "a", "name": "a"}, {"id": "7"}, {"id": 1.5}]': (3, 0),
    '[{"id": null}, null, {}, {"ID": 5}]': (0, 0),
    '[{"id": 99999999999, "name": {"x": 1}}, {"id": 2, "name": 3}]': (1, 0),
    '{"id": "x"}': (1, 0),
    '[{"id": [1, 2]}]': (1, 0),
    "[]": (0, 0),
    "": (0, 0),
    "not json": (0, 0),
    '[{"id": 1, "name":': (0, 0),
    None: (0, 0),
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_parsing_loses_are_counted(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    raw = spark.createDataFrame([(text,) for text in LOST], "raw string")
    counted = with_losses(raw, [], {"raw": "array<struct<id:int,name:string>>"})
    assert counted.columns == ["raw", *loss_names([], {"raw": "array<struct<id:int,name:string>>"})]
    got = {row["raw"]: (row["lost_raw_id"], row["lost_raw_name"]) for row in counted.collect()}
    # what the parser makes of a whole text that it refuses is counted as corrupt, not here
    assert got == LOST


def test_texts_that_casts_lose_are_counted(spark):
    raw = spark.createDataFrame([("1.5", "x"), ("n/a", None), (None, "2"), ("  ", ""), ("1e3", "y")], "a string, b string")
    counted = with_losses(raw, [("a", "whole", "int"), ("a", "real", "double"), ("b", "text", "string")], {})
    assert counted.columns == ["a", "b", "lost_whole", "lost_real"]
    assert [(row.lost_whole, row.lost_real) for row in counted.collect()] == [(0, 0), (1, 1), (0, 0), (0, 0), (1, 0)]


def test_arrays_are_parsed_once_for_losses_and_result(spark):
    from pyspark.sql import Observation

    from marquee.plans.curation import _observed, shaped

    arrays = {"tags": "array<struct<id:int,name:string>>"}
    raw = spark.createDataFrame([('[{"id": "x", "name": "a"}, {"id": 2}]',), ("[{",), (None,)], "tags string")
    observation = Observation()
    observed = _observed(raw, (), arrays, observation)
    assert observed._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert observed.schema == shaped(raw, (), arrays).schema
    assert sorted(map(str, observed.collect())) == sorted(map(str, shaped(raw, (), arrays).collect()))
    assert observation.get == {"lost_tags_id": 1, "lost_tags_name": 0}
