"""Ranked lexical search over classes of documents with equal bags.

A search item knows only the terms of its own text, so a document counts only by how often it has the
terms of the items (its bag) and by its length norm ``m``. Documents with equal bags and norms are one
class: they have the same score for every item. Classes are found by a hash and told apart by the bag
itself, each is scored once, and its members take its place in the ranking by ascending id.

Of a class no more members than the ranking is long can be ranked, and of an item's classes no more
than that either: of ``k`` classes ordered by score and least member, each holds a document that comes
before all members of the ones behind. So the least ``k`` members and the best ``k`` classes are kept
(both cut in each task before rows move), and a class of a third of all documents is no hot group.

Scores are exact 64-bit integers. Items come in blocks of bounded size; a block's terms are what a task
holds, and every block is a pass over all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.buffers import LOWER, flags, text_bytes, word_table
from marquee.llm.common import shared, ship, written
from marquee.llm.text import ragged, slices

# How many documents an item gets.
TOP = 10
# Items and bytes of text in a block, which a task holds as a whole.
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20
# Scores that a task works out at once: this bounds its memory, not the result.
SCORES = 1 << 21

# All ASCII but letters and digits parts terms.
_SEPARATOR = flags(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


@dataclass
class Postings:
    """Terms of a block of items, and for each term the items that have it and how often."""

    item_ids: list[int | None]
    terms: pa.Array
    offsets: np.ndarray
    items: np.ndarray
    repeats: np.ndarray


def terms_of(texts: pa.Array):
    """Terms of texts, A-Z lowered, as a word table."""
    data, offsets = text_bytes(texts)
    return word_table(LOWER[data], offsets, _SEPARATOR)


def build_postings(items: list[tuple[int | None, str]]) -> Postings:
    words = terms_of(pa.array([text for _, text in items], pa.string()))
    pairs, repeats = np.unique(
        words.codes.astype(np.int64) * max(len(items), 1) + words.texts, return_counts=True
    )
    term, item = np.divmod(pairs, max(len(items), 1))
    offsets = np.searchsorted(term, np.arange(len(words.vocabulary) + 1))
    return Postings([item_id for item_id, _ in items], words.vocabulary, offsets, item, repeats)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The distinct items with a text, in blocks of bounded size."""
    items = written(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null").distinct(),
        "items",
    )
    count, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(-(-count // BLOCK_ITEMS), -(-(size or 0) // BLOCK_BYTES))
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield [(row.item_id, row.text) for row in rows]


def bags(docs: DataFrame, postings) -> DataFrame:
    """``doc_id``, ``n`` terms and ``bag`` of every document with a term: the numbers and counts of the
    items' terms in it, by ascending number, as unsigned 32-bit integers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = postings.value.terms
        for batch in batches:
            for piece in slices(batch, size=2 << 20):
                words = terms_of(piece.column("text"))
                n = np.bincount(words.texts, minlength=piece.num_rows)
                known = pc.fill_null(pc.index_in(words.vocabulary, value_set=wanted), -1)
                term = known.to_numpy(zero_copy_only=False).astype(np.int64)[words.codes]
                pairs, times = np.unique(
                    words.texts[term >= 0] * max(len(wanted), 1) + term[term >= 0], return_counts=True
                )
                text, term = np.divmod(pairs, max(len(wanted), 1))
                held = np.stack([term, times], axis=1).astype("<u4")
                ends = 8 * np.cumsum(np.bincount(text, minlength=piece.num_rows))
                places = np.concatenate([[0], ends]).astype(np.int32)
                bag = pa.Array.from_buffers(
                    pa.binary(), piece.num_rows, [None, pa.py_buffer(places), pa.py_buffer(held)]
                )
                rows = pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(n, pa.int64()), bag], names=["doc_id", "n", "bag"]
                )
                yield rows.filter(pa.array(n > 0))

    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null")
    return frame.mapInArrow(count, "doc_id long, n long, bag binary")


def _pairs(bag: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of all that bags hold."""
    sizes = pc.binary_length(bag).to_numpy(zero_copy_only=False).astype(np.int64) // 8
    joined = b"".join(bag.to_pylist())
    held = np.frombuffer(joined, dtype="<u4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(bag)), sizes), held[:, 0], held[:, 1]


def document_counts(bagged: DataFrame, terms: int) -> list[int]:
    """Documents per term of the block; a row per term and no more comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_pairs(batch.column("bag"))[1], minlength=terms)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["term", "df"])

    rows = bagged.select("bag").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = [0] * terms
    for row in rows.collect():
        df[row.term] = row.df
    return df


def _by_id() -> Column:
    return F.col("doc_id").asc_nulls_last()


def classes(bagged: DataFrame, top: int = TOP) -> DataFrame:
    """``m``, ``bag`` and the least ``top`` ``members`` of each class of documents with equal bag and
    norm. The hash spreads the classes, the bag and the norm themselves decide."""
    keys = ["hash", "m", "bag"]
    hashed = bagged.withColumn("hash", F.xxhash64("bag", "m"))
    order = F.row_number().over(Window.partitionBy(*keys).orderBy(_by_id()))
    least = hashed.withColumn("place", order).filter(F.col("place") <= top)
    members = F.array_sort(F.collect_list(F.struct("place", "doc_id")))
    return (
        least.groupBy(*keys)
        .agg(members.alias("members"))
        .select("m", "bag", F.transform("members", lambda member: member["doc_id"]).alias("members"))
    )


@dataclass
class _Best:
    """The best classes of each item so far: parallel arrays, by item, score and least member."""

    top: int
    item: np.ndarray
    score: np.ndarray
    last: np.ndarray  # whether the least member is null, which comes last
    first: np.ndarray
    members: np.ndarray

    @classmethod
    def none(cls, top: int) -> _Best:
        empty = np.zeros(0, dtype=np.int64)
        return cls(top, empty, empty, empty.astype(bool), empty, np.zeros(0, dtype=object))

    def add(self, item, score, last, first, members) -> None:
        columns = [
            np.concatenate(pair)
            for pair in zip(
                (self.item, self.score, self.last, self.first, self.members), (item, score, last, first, members)
            )
        ]
        order = np.lexsort((columns[3], columns[2], -columns[1], columns[0]))
        sorted_item = columns[0][order]
        place = np.arange(len(order)) - np.searchsorted(sorted_item, sorted_item)
        order = order[place < self.top]
        self.item, self.score, self.last, self.first, self.members = (column[order] for column in columns)

    def floor(self, items: int) -> np.ndarray:
        """The score that a class needs to be among an item's best."""
        count = np.bincount(self.item, minlength=items)
        least = np.ones(items, dtype=np.int64)
        full = np.flatnonzero(count >= self.top)
        least[full] = self.score[np.cumsum(count)[full] - 1]
        return least


def score_bags(index: Postings, weights: np.ndarray, bag: pa.Array, m: np.ndarray) -> Iterator[tuple]:
    """Row, item and score above 0 of all rows with an item's term, a bounded number at a time."""
    row, term, tf = _pairs(bag)
    worth = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
    many = index.offsets[term + 1] - index.offsets[term]
    items = max(len(index.item_ids), 1)
    borders = np.searchsorted(row, np.arange(len(bag) + 1))
    done = np.concatenate([[0], np.cumsum(many)])[borders] + items * np.arange(len(bag) + 1)
    at = 0
    while at < len(bag):
        stop = max(at + 1, int(np.searchsorted(done, done[at] + SCORES, side="right")) - 1)
        own = slice(borders[at], borders[stop])
        posting = ragged(index.offsets[term[own]], many[own])
        value = np.repeat(worth[own], many[own]) * index.repeats[posting]
        cell = np.repeat(row[own] - at, many[own]) * items + index.items[posting]
        # sums of doubles below 2**53 are exact, so the halves of a value are summed apart
        low, high = (
            np.bincount(cell, weights=half, minlength=(stop - at) * items).astype(np.int64)
            for half in (value & 0x3FFFFFF, value >> 26)
        )
        score = (high << 26) + low
        hit = np.flatnonzero(score > 0)
        yield at + hit // items, hit % items, score[hit]
        at = stop


def best_classes(classed: DataFrame, postings, weights: list[int], top: int) -> DataFrame:
    """``item``, ``score``, ``members`` of the best classes of each item that each task has met."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weight = postings.value, np.array(weights, dtype=np.int64)
        best = _Best.none(top)
        for batch in batches:
            members = np.empty(batch.num_rows, dtype=object)
            members[:] = batch.column("members").to_pylist()
            last = np.array([own[0] is None for own in members], dtype=bool)
            first = np.array([own[0] or 0 for own in members], dtype=np.int64)
            m = batch.column("m").to_numpy()
            for row, item, value in score_bags(index, weight, batch.column("bag"), m):
                # an equal score may still come first by its least member
                good = value >= best.floor(len(index.item_ids))[item]
                row, item, value = row[good], item[good], value[good]
                best.add(item, value, last[row], first[row], members[row])
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item, pa.int64()), pa.array(best.score, pa.int64()),
             pa.array(best.members.tolist(), pa.list_(pa.int64()))], names=["item", "score", "members"]
        )

    return classed.mapInArrow(score, "item long, score long, members array<long>")


def _search_block(docs: DataFrame, block: list[tuple[int | None, str]], top: int) -> DataFrame | None:
    spark = docs.sparkSession
    index = build_postings(block)
    if not len(index.terms):
        return None
    postings = shared(spark, index)  # a block of bounded size
    bagged = written(bags(docs, postings), "bags")
    count, length = bagged.agg(F.count("*"), F.sum("n")).first()
    if not count:
        return None
    df = document_counts(bagged, len(index.terms))
    weights = [math.floor(1000 * math.log((2 * count + 2) / (2 * own + 1))) for own in df]
    norm = F.expr(f"25L + (75L * n * {count}L) div {length}L")
    classed = classes(bagged.filter("length(bag) > 0").select("doc_id", norm.alias("m"), "bag"), top)
    found = best_classes(classed, postings, weights, top)
    first = F.col("members")[0].asc_nulls_last()
    ahead = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), first))
    members = (
        found.withColumn("place", ahead)
        .filter(F.col("place") <= top)
        .select("item", "score", F.explode("members").alias("doc_id"))
    )
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), _by_id()))
    ranked = members.withColumn("rank", rank).filter(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(index.item_ids)), "item long, item_id long")
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``top`` best documents of each item.

    Null and empty texts, and those without a term, are no documents and no items. Rows of the benchmark
    with equal id and text are one item, with equal id and other texts several, each with ranks of its
    own. Every row of the documents counts and ranks by itself, also if rows are repeated; of equal
    scores a null id comes last. A long text is counted as a whole, which takes a task some 60 bytes for
    each of its bytes. Other columns are ignored. An empty table on either side gives no rows.
    """
    ship(docs.sparkSession)
    parts = [part for block in _blocks(benchmark) if (part := _search_block(docs, block, top)) is not None]
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts)
