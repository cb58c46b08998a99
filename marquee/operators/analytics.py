"""Parameterised questions over a fact table and its bridge tables.

Joins carry no hints: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits a hot join key
over many tasks. Each join is followed by an exchange on other columns, so that split
never costs an extra shuffle. Grouping combines map-side before it shuffles.
Duplicates are kept: a bridge row that occurs twice counts twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _descending(df: DataFrame, by: str, *ties: str) -> DataFrame:
    # ties make the order definite and let the range exchange divide equal values
    return df.orderBy(F.col(by).desc(), *(F.col(tie) for tie in ties if tie != by))


def filter_join_sort(
    bridge: DataFrame,
    fact: DataFrame,
    key: str,
    where: Column,
    columns: Sequence[str],
    order_by: str,
    spread: Sequence[str] = (),
    distinct: bool = False,
) -> DataFrame:
    """Facts reached through matching bridge rows, largest ``order_by`` first.

    A fact appears once per matching bridge row, or once at all with ``distinct``.
    ``spread`` names bridge columns that tell the copies of one fact apart: as last sort
    keys they keep a fact with very many copies from landing in one sort task.
    """
    hits = bridge.filter(where)
    facts = fact.select(*dict.fromkeys([key, *columns, order_by]))
    if distinct:
        # map-side, the keys of a hot fact shrink to one; the join reuses their exchange
        found, ties = facts.join(hits.select(key).distinct(), key, "left_semi"), [key]
    else:
        marks = [F.col(name).alias(f"_{name}") for name in spread]
        found = hits.select(key, *marks).join(facts, key)
        ties = [key, *(f"_{name}" for name in spread)]
    return _descending(found.repartition(*ties), order_by, *ties).select(*columns)


def top_n(
    df: DataFrame, columns: Sequence[str], order_by: str, n: int, ties: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` rows with the largest ``order_by``; each task keeps only its best ``n``."""
    wanted = df.select(*dict.fromkeys([*columns, order_by, *ties]))
    return _descending(wanted, order_by, *ties).limit(n).select(*columns)


def group_count(df: DataFrame, by: Sequence[str], count_as: str) -> DataFrame:
    """Rows per group, largest group first; NULL is a group of its own."""
    counted = df.groupBy(*by).agg(F.count("*").alias(count_as))
    return _descending(counted, count_as, *by)


def filter_join_group_sum(
    bridge: DataFrame,
    fact: DataFrame,
    key: str,
    where: Column,
    by: Sequence[str],
    measure: str,
    sum_as: str,
    count_as: str,
) -> DataFrame:
    """Sum of a fact measure over matching bridge rows, per bridge group."""
    summed = (
        bridge.filter(where)
        .select(key, *by)
        .join(fact.select(key, measure), key)
        .groupBy(*by)
        .agg(F.sum(measure).alias(sum_as), F.count(key).alias(count_as))
    )
    return _descending(summed, sum_as, *by)


def join_group_avg(
    bridge: DataFrame, fact: DataFrame, key: str, by: Sequence[str], measure: str, avg_as: str
) -> DataFrame:
    """Unweighted average of a fact measure over bridge rows, per bridge group."""
    averaged = (
        bridge.select(key, *by)
        .join(fact.select(key, measure), key)
        .groupBy(*by)
        .agg(F.avg(measure).alias(avg_as))
    )
    return _descending(averaged, avg_as, *by)
