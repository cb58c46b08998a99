"""Shards by a keyed permutation of global row numbers.

Rows get gapless numbers in a defined order. A Feistel network over an ``a`` by ``b`` grid, the
smallest near-square one that holds all row numbers, permutes them; a result beyond the last
row is permuted again (cycle walking), so that rows map one to one onto positions. Position
``p`` lies in shard ``p % shards`` at slot ``p // shards``. Anyone who knows row number, row
count and seed can compute both, and any shard prefix is a uniform sample.

All of it is DataFrame expressions. The sort moves order columns and what is asked for, not
the texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import fresh, prefix_offsets, written

ROUNDS = 6
STEPS = 64


def grid(rows: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid with a cell for every row."""
    a = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    return a, max(1, -(-rows // a))


def _network(number: Column, a: int, b: int, seed: int) -> Column:
    """One pass: sides take turns in being shifted by a keyed hash of the other."""

    def step(state: Column, turn: Column) -> Column:
        left, right = state["l"], state["r"]
        shift = lambda side, size: F.pmod(F.xxhash64(F.lit(seed), turn, side), F.lit(size))
        even = turn % 2 == 0
        return F.struct(
            F.when(even, (left + shift(right, a)) % a).otherwise(left).cast("long").alias("l"),
            F.when(even, right).otherwise((right + shift(left, b)) % b).cast("long").alias("r"),
        )

    start = F.struct((number % a).cast("long").alias("l"), F.floor(number / a).cast("long").alias("r"))
    turns = F.array(*(F.lit(turn) for turn in range(ROUNDS)))
    return F.aggregate(turns, start, step, lambda state: state["l"] + state["r"] * a)


def permuted(number: Column, rows: int, seed: int = 0) -> Column:
    """Where a row number below ``rows`` goes: a one-to-one map onto the numbers below ``rows``.

    Fewer than ``a`` cells of the grid are beyond the last row, so a walk ends within ``a`` steps: mostly
    within the 64 that are tried first, and if not, after as many more as there may be.
    """
    a, b = grid(rows)
    first = _network(number, a, b, seed)
    # a let-binding: the first pass is used several times below and computed once
    bound = F.transform(F.array(first), lambda once: _walked(once, rows, a, b, seed))
    return F.element_at(bound, 1)


def _walked(once: Column, rows: int, a: int, b: int, seed: int) -> Column:
    def walk(start: Column, steps: int) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(steps)),
            start,
            lambda at, _: F.when(at >= rows, _network(at, a, b, seed)).otherwise(at),
        )

    # steps by the 64, so that the longest walk there may be is no long array
    far = lambda start: F.aggregate(
        F.sequence(F.lit(1), F.lit(-(-a // STEPS))), start, lambda at, _: walk(at, STEPS)
    )
    ended = F.transform(F.array(walk(once, min(a, STEPS))), lambda end: F.when(end < rows, end).otherwise(far(end)))
    return F.when(once < rows, once).otherwise(F.element_at(ended, 1))


def number_rows(df: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """Gapless row numbers from 0 in the order of the given columns, and the number of rows.

    A distributed sort is written out once; a row's number is its place in its part of the sort
    plus the rows in all parts before. Nulls come first. Rows that are equal in all order columns
    get adjacent numbers in no defined order; the place in the input comes last in the sort key,
    so that the sort can divide any number of them. A column called ``name`` is replaced.
    """
    place, part, number = fresh(df, "place", "part", "number")
    placed = df.withColumn(place, F.monotonically_increasing_id())
    in_order = placed.orderBy(*order, place).withColumn(place, F.monotonically_increasing_id())
    kept = written(in_order, "numbered")
    counts = kept.groupBy(F.shiftright(place, 33).alias(part)).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows")).first()[0] or 0
    bases = prefix_offsets(counts, part, "rows").withColumnRenamed("base", number)
    local = F.col(place).bitwiseAND((1 << 33) - 1)
    numbered = kept.withColumn(part, F.shiftright(place, 33)).join(bases, part)
    numbered = numbered.withColumn(number, F.col(number) + local).drop(part, place)
    return (numbered if number == name else numbered.drop(name).withColumnRenamed(number, name)), total


def shard_rows(df: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """The frame with ``row_number``, ``shard`` and ``slot``.

    Shard sizes differ by one row at most and slots are gapless. Columns of these names in the
    input are replaced, all others kept. An empty table stays empty; null and repeated
    order values, null and long texts are values like any other.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    numbered, rows = number_rows(df, order)
    (at,) = fresh(numbered, "at")
    placed = numbered.withColumn(at, permuted(F.col("row_number"), rows, seed))
    return placed.withColumns(
        {"shard": (F.col(at) % shards).cast("int"), "slot": F.floor(F.col(at) / shards).cast("long")}
    ).drop(at)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows within a file by slot. A shard is spread over as many files as
    its rows need: the range exchange divides shards, too."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).mode("errorifexists").parquet(path)
