"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

Codes are the signs of rotated vectors; the rotations are learned (ITQ: rotation and codes are
fitted to each other in turns) on a bounded sample of the vectors of one length. A code is cut into substrings of a byte, each
with an index of its own. Two codes within a Hamming radius ``r`` must, by the pigeonhole principle,
be within ``r // m`` (or one less, in all but the first ``r % m + 1``) in one of ``m`` substrings: so
probing all near values of every substring retrieves every code within the radius. What lies within
is ranked by exact cosine. How many rows are met on the way depends on the vectors: few where true neighbours
are near, nearly all where they are hardly nearer than others, as among random vectors of many dimensions,
which no such index can tell apart.

The radius comes from the sample, too: nearly all true neighbours lie within it. Vectors are dealt
into blocks, each indexed as a whole; the stated queries go to every block in blocks of their own,
so a task holds a bounded number of both. Equal vectors are indexed once. A query that finds too few
rows within the radius is compared with all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import ship, written

# Vectors that the rotations and the radius are learned from, at most, and of these the queries.
SAMPLE = 8_000
SAMPLE_QUERIES = 200
BITS = 128
COVERED = 0.98
BLOCK_ROWS = 8_192
BLOCK_QUERIES = 4_096

_NEAR: dict[int, list[np.ndarray]] = {}


@dataclass
class Codes:
    """Learned rotations, a block of columns per rotation, and the Hamming radius to search."""

    rotations: np.ndarray
    radius: int

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Bits packed into bytes, a byte per substring."""
        return np.packbits(vectors @ self.rotations > 0, axis=1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _itq(vectors: np.ndarray, rng: np.random.Generator, turns: int = 20) -> np.ndarray:
    rotation = np.linalg.qr(rng.normal(size=(vectors.shape[1],) * 2))[0]
    for _ in range(turns):
        signs = np.where(vectors @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(vectors.T @ signs)
        rotation = left @ right
    return rotation


def learn_codes(sample: np.ndarray, neighbours: int, bits: int = BITS, seed: int = 7) -> Codes:
    """Learn from some vectors. Rotations of the principal axes are repeated up to ``bits`` bits."""
    units, rng = _unit(sample), np.random.default_rng(seed)
    dim = units.shape[1]
    axes = np.linalg.eigh(units.T @ units)[1][:, ::-1]
    projected = units @ axes
    rotations = [axes @ _itq(projected, rng) for _ in range(-(-bits // dim))]
    codes = Codes(np.hstack(rotations)[:, :bits], bits)
    packed = codes.encode(units)
    queries = np.arange(0, len(units), max(1, len(units) // SAMPLE_QUERIES))
    likeness = units[queries] @ units.T
    likeness[np.arange(len(queries)), queries] = -2
    wanted = min(neighbours, len(units) - 1)
    if wanted > 0:
        best = np.argpartition(-likeness, wanted - 1, axis=1)[:, :wanted]
        distances = np.bitwise_count(packed[queries][:, None, :] ^ packed[best]).sum(axis=2)
        codes.radius = int(np.quantile(distances, COVERED, method="higher"))
    return codes


def near_values(radius: int) -> list[np.ndarray]:
    """Per byte value the byte values within a Hamming radius."""
    if radius not in _NEAR:
        values = np.arange(256, dtype=np.uint8)
        _NEAR[radius] = [np.flatnonzero(np.bitwise_count(values ^ v) <= radius) for v in values]
    return _NEAR[radius]


class SubstringIndex:
    """Rows of a block by the value of each substring of their codes."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed
        self.order = np.argsort(packed, axis=0, kind="stable")
        values = np.arange(257)
        self.starts = [
            np.searchsorted(packed[self.order[:, k], k], values, side="left") for k in range(packed.shape[1])
        ]

    def probe(self, code: np.ndarray, radius: int) -> np.ndarray:
        """The rows that some substring names: all within the radius, and others."""
        substrings = self.packed.shape[1]
        seen = np.zeros(len(self.packed), dtype=bool)
        for k in range(substrings):
            reach = radius // substrings - (k > radius % substrings)
            if reach < 0:
                continue
            values = near_values(reach)[code[k]]
            starts, order = self.starts[k], self.order[:, k]
            lengths = starts[values + 1] - starts[values]
            total = int(lengths.sum())
            if total:
                ends = np.cumsum(lengths)
                seen[order[np.arange(total) + np.repeat(starts[values] - ends + lengths, lengths)]] = True
        return np.flatnonzero(seen)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within the radius."""
        rows = self.probe(code, radius)
        near = np.bitwise_count(self.packed[rows] ^ code).sum(axis=1) <= radius
        return rows[near]


def _usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    vector = F.col(vector_column).cast("array<double>")
    frame = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return frame.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(finite & some)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _searched(queries: DataFrame, rows: DataFrame, codes, wanted: int, sizes: tuple[int, int]) -> DataFrame:
    """Per query class the best ``wanted`` row classes of each block: ``query``, ``class``, ``score``.

    ``codes`` is a broadcast of learned codes, or None to compare with all rows of the block.
    """
    row_blocks, query_blocks = (max(1, -(-n // size)) for n, size in zip(sizes, (BLOCK_ROWS, BLOCK_QUERIES)))
    schema = pa.schema([("query", pa.int64()), ("class", pa.int64()), ("score", pa.float64())])

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if queries.num_rows and rows.num_rows:
            ids, vectors = rows.column("class").to_numpy(), _matrix(rows.column("vector"))
            norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            asked = _matrix(queries.column("vector"))
            if codes is not None:
                index = SubstringIndex(codes.value.encode(vectors))
                packed = codes.value.encode(asked)
            for k, (query, vector) in enumerate(zip(queries.column("class").to_pylist(), asked)):
                found = np.arange(len(ids)) if codes is None else index.within(packed[k], codes.value.radius)
                if not len(found):
                    continue
                products = np.einsum("ij,j->i", vectors[found], vector)
                score = products / (norms[found] * np.sqrt(np.einsum("i,i->", vector, vector)))
                best = np.lexsort((ids[found], -score))[:wanted]
                out[0] += [query] * len(best)
                out[1] += ids[found[best]].tolist()
                out[2] += score[best].tolist()
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema)

    def spread(frame: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return frame.select(
            "class",
            "vector",
            F.pmod(F.xxhash64("class"), F.lit(blocks)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))).alias(other),
        )

    left = spread(queries, "query_block", query_blocks, "row_block", row_blocks)
    right = spread(rows, "row_block", row_blocks, "query_block", query_blocks)
    keys = ["row_block", "query_block"]
    return (
        left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query long, class long, score double")
    )


def nearest(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` rows of largest cosine for every row whose id is divisible by ``every``.

    Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, the cosine in double precision;
    ties go to the smaller id. Rows with a null id take no part, nor do vectors that are null, zero
    or hold null or non-finite components. Vectors are compared with those of their own length, each
    length with codes of its own. Rows that repeat an id and its vector count once. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    used = written(_usable(vectors, id_column, vector_column).distinct(), "vectors")
    asked = F.count_if(F.col("vec_id") % every == 0)
    lengths = used.groupBy(F.size("vector").alias("dim")).agg(asked.alias("asked")).filter("asked > 0")
    found = None
    for row in lengths.select("dim").orderBy("dim").collect():
        part = _nearest(used.filter(F.size("vector") == row.dim), k, every)
        found = part if found is None else found.unionByName(part)
    empty = "query_id long, rank int, vec_id long, score double"
    return spark.createDataFrame([], empty) if found is None else found


def _nearest(used: DataFrame, k: int, every: int) -> DataFrame:
    """``nearest`` among usable vectors of one length."""
    spark = used.sparkSession
    sample = used.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toPandas()["vector"]
    codes = spark.sparkContext.broadcast(learn_codes(np.stack(sample.to_list()), k))

    # equal vectors are a class, named by its least id; its first k + 1 ids can be among the nearest
    least = written(used.groupBy("vector").agg(F.min("vec_id").alias("class")), "vector-classes")
    order = Window.partitionBy("vector").orderBy("vec_id")
    firsts = used.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    members = written(firsts.join(least, "vector").select("class", "vec_id"), "members")
    asking = written(used.filter(F.col("vec_id") % every == 0).join(least, "vector").select("class", "vec_id"), "asking")
    queries = written(least.join(asking.select("class").distinct(), "class", "left_semi"), "queries")
    sizes = least.count(), queries.count()
    hits = written(_top(_searched(queries, least, codes, k + 1, sizes), "query", "class", k + 1), "hits")

    enough = min(k + 1, sizes[0])
    complete = hits.groupBy("query").agg(F.count("*").alias("found")).filter(F.col("found") >= enough)
    missing = written(queries.join(complete, queries["class"] == complete["query"], "left_anti"), "missing")
    if left := missing.count():
        full = _top(_searched(missing, least, None, k + 1, (sizes[0], left)), "query", "class", k + 1)
        hits = hits.join(missing, hits["query"] == missing["class"], "left_anti").unionByName(full)

    rows = (
        hits.join(members, "class")
        .join(asking.select(F.col("class").alias("query"), F.col("vec_id").alias("query_id")), "query")
        .filter("vec_id <> query_id")
        .select("query_id", "vec_id", "score")
    )
    return _top(rows, "query_id", "vec_id", k).select("query_id", "rank", "vec_id", "score")


def _top(hits: DataFrame, query: str, found: str, k: int) -> DataFrame:
    order = Window.partitionBy(query).orderBy(F.col("score").desc(), found)
    return hits.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
