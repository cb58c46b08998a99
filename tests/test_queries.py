"""Every registered query against its SQL on the same tables."""

import math
import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else f"{value:.9g}"
        return repr(value)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_matches_sql(spark, oracle, name):
    frame = contract.queries()[name](spark, SF_DIR)
    relation = oracle.sql(contract.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    got = multiset(frame.columns, frame.collect())
    want = multiset(relation.columns, relation.fetchall())
    assert len(got) == len(want)
    assert got == want
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
    types = dict(zip(relation.columns, map(str, relation.types)))
    for field in frame.schema:
        kind = field.dataType.simpleString()
        assert kinds.get(kind, types[field.name]) == types[field.name], field.name


def test_every_query_over_the_star_schema_has_sql():
    assert QUERIES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).columns == ["l_suppkey", "total_cents", "order_count"]
    assert contract.entry(spark).count() > 0
