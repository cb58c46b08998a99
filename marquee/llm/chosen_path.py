"""Near-duplicates of word shingles by a chosen-path similarity join.

Documents of one shingle set form a class; classes are joined. Each has a sketch of minwise
hash values of its set. A tree splits the classes by a minwise value at chosen places, and
nodes that stay large are split again, at places that the node's path chooses, into an expected
``1 / similarity`` children per class: so a pair at the threshold is expected to stay together in
one child, however deep the tree, while dissimilar classes part quickly. In small nodes
all pairs are compared by their sketches, and independent trees are repeated to the target recall.

That gives loose groups: classes connected by sketches that agree, or by staying in one node to the
last level of a tree. Every link lies inside one of them. Then the full shingle sets of each group
are compared, all with all; a group that is too large for one task is cut into blocks, and each two
blocks are a task. A task returns the components it found, as stars, not the pairs: a group of
thousands of near copies has millions of those.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.llm.common import ship, written
from marquee.llm.components import components
from marquee.llm.text import Words, filled, hash_words, lower_ascii, mix, ragged, slices

SHINGLE = 5
PERCENT = 85
PLACES = 128
TREES = 6
# Children per class at the root of each tree; below, 1 / similarity are expected.
ROOT_CHILDREN = 2
SMALL_NODE = 256
LEVELS = 3
# Sketches agree if their minwise values do in so many places: this many standard deviations below
# what a pair at the threshold is expected to share.
MARGIN = 4.5
# Classes in a block of a large group.
BLOCK = 512

# Unrelated odd factors per place in a shingle: related ones would confuse some orders of words.
_ODD = mix(np.arange(101, 101 + SHINGLE, dtype=np.uint64)) | np.uint64(1)
_FACTORS = mix(np.arange(1, PLACES + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its shingles; empty without words."""
    words = Words(lower_ascii(texts))
    hashes = hash_words(words.vocabulary)[words.codes]
    if len(hashes) >= SHINGLE:
        last = len(hashes) - SHINGLE + 1
        rolling = mix(sum(hashes[k : last + k] * _ODD[k] for k in range(SHINGLE)))
    else:
        rolling = hashes[:0]
    sets = []
    for begin, end in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
        count = end - begin
        if count >= SHINGLE:
            sets.append(np.unique(rolling[begin : end - SHINGLE + 1]))
        elif count:
            own = np.sum(hashes[begin:end] * _ODD[:count], dtype=np.uint64) + np.uint64(count)
            sets.append(mix(np.array([own], dtype=np.uint64)))
        else:
            sets.append(rolling[:0])
    return sets


def set_id(shingles: np.ndarray) -> bytes | None:
    """128 bits that name a set: sums of two scrambles of its elements."""
    if not len(shingles):
        return None
    sums = [np.sum(mix(shingles ^ np.uint64(key)), dtype=np.uint64) for key in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return np.array(sums, dtype=">u8").tobytes()


def sketch(shingles: np.ndarray) -> bytes:
    """The least of ``PLACES`` multiplicative 32-bit hashes of the set's elements."""
    least = np.full(PLACES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        products = shingles[at : at + 4096, None] * _FACTORS[None, :]
        least = np.minimum(least, products.min(axis=0))
    return (least >> np.uint64(32)).astype("<u4").tobytes()


def document_sets(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_id`` (null for no words), ``sketch`` and carried columns
    per document."""
    ship(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                sets = shingle_sets(filled(piece.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([set_id(x) for x in sets], pa.binary()),
                        pa.array([sketch(x) if len(x) else None for x in sets], pa.binary()),
                        *(piece.column(name) for name in carry),
                    ],
                    names=["doc_id", "n_shingles", "set_id", "sketch", *carry],
                )

    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    schema = StructType().add("doc_id", "long").add("n_shingles", "long").add("set_id", "binary").add("sketch", "binary")
    return frame.mapInArrow(measure, StructType([*schema.fields, *frame.select(*carry).schema.fields]))


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, PLACES).astype(np.uint64)


def _children(sketches: np.ndarray, nodes: np.ndarray, chosen: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of the children at the chosen places (one per row; below 0 for none), and their rows."""
    for places in chosen:
        rows = np.flatnonzero(places >= 0)
        at = places[rows]
        value = sketches[rows, at] | (at.astype(np.uint64) << np.uint64(32))
        yield mix(mix(nodes[rows]) + value).view(np.int64), rows


def _rows(keys: np.ndarray, ids: pa.Array, rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), ids.take(pa.array(rows))], names=["node", "set_id"])


def root_nodes(classes: DataFrame) -> DataFrame:
    """``node`` and ``set_id``: the first level of all trees."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sketches = _sketches(batch.column("sketch"))
            for tree in range(TREES):
                roots = np.full(len(sketches), tree + 1, dtype=np.uint64)
                chosen = [np.full(len(sketches), ROOT_CHILDREN * tree + k) for k in range(ROOT_CHILDREN)]
                for keys, rows in _children(sketches, roots, chosen):
                    yield _rows(keys, batch.column("set_id"), rows)

    return classes.select("set_id", "sketch").mapInArrow(split, "node long, set_id binary")


def child_nodes(members: DataFrame, similarity: float) -> DataFrame:
    """The next level of the nodes that ``node``, ``set_id``, ``sketch`` rows are in.

    A node chooses one place surely and a second one with the chance that makes ``1 / similarity``
    expected; all its classes split by the same places.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = batch.column("node").to_numpy().view(np.uint64)
            first = (mix(nodes + np.uint64(1)) % np.uint64(PLACES)).astype(np.int64)
            second = (first + 1 + (mix(nodes + np.uint64(2)) % np.uint64(PLACES - 1)).astype(np.int64)) % PLACES
            lucky = (mix(nodes + np.uint64(3)) >> np.uint64(11)) / 2.0**53 < 1 / similarity - 1
            for keys, rows in _children(
                _sketches(batch.column("sketch")), nodes, [first, np.where(lucky, second, -1)]
            ):
                yield _rows(keys, batch.column("set_id"), rows)

    return members.select("node", "set_id", "sketch").mapInArrow(split, "node long, set_id binary")


def _least_agreement(similarity: float) -> int:
    deviation = np.sqrt(PLACES * similarity * (1 - similarity))
    return max(1, int(PLACES * similarity - MARGIN * deviation))


def _connected(size: int, pairs: Iterator[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
    """Each element but the least of its component, after that least one. Links are given per
    element, with the larger ones it is linked to."""
    parent = list(range(size))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for left, partners in pairs:
        for right in partners.tolist():
            a, b = root(left), root(right)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(root(x), x) for x in range(size) if root(x) != x]


_EDGES = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _edges(pairs: list[tuple[bytes, bytes]]) -> pa.Table:
    columns = [pa.array([pair[k] for pair in pairs], pa.binary()) for k in (0, 1)]
    return pa.Table.from_arrays(columns, schema=_EDGES)


def small_node_edges(members: DataFrame, least: int, buckets: int) -> DataFrame:
    """Edges ``a``, ``b`` that connect the classes of each small node whose sketches agree in
    ``least`` places, directly or over others of the node.

    Nodes are dealt into buckets, so that a task call holds whole nodes of bounded size.
    """

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by([("node", "ascending"), ("set_id", "ascending")]).combine_chunks()
        nodes = group.column("node").to_numpy()
        ids = group.column("set_id").to_pylist()
        sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), "<u4").reshape(-1, PLACES)
        starts = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
        found = set()
        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(nodes)]):
            block = sketches[begin:end]
            agree = (block[:, None, :] == block[None, :, :]).sum(axis=2) >= least
            partners = ((k, k + 1 + np.flatnonzero(agree[k, k + 1 :])) for k in range(end - begin))
            found.update((ids[begin + i], ids[begin + j]) for i, j in _connected(end - begin, partners))
        return _edges(list(found))

    bucketed = members.select("node", "set_id", "sketch", F.pmod(F.xxhash64("node"), F.lit(buckets)).alias("bucket"))
    return bucketed.groupBy("bucket").applyInArrow(compare, "a binary, b binary")


def _sized(nodes: DataFrame) -> DataFrame:
    """Rows of nodes with two classes at least, with the node's ``size``.

    The sizes are a written table, so that a node with very many rows can be divided in the join.
    """
    sizes = written(nodes.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1"), "node-sizes")
    return nodes.join(sizes, "node")


def loose_edges(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges that connect all classes that may be linked. ``classes`` is a written table of
    ``set_id`` and ``sketch``."""
    similarity = percent / 100
    nodes = written(root_nodes(classes), "nodes")
    small = None
    for level in range(1, LEVELS + 1):
        sized = written(_sized(nodes), "sized-nodes")
        few = sized.filter(F.col("size") <= SMALL_NODE).select("node", "set_id")
        small = few if small is None else small.unionByName(few)
        large = sized.filter(F.col("size") > SMALL_NODE).select("node", "set_id")
        if level == LEVELS or large.isEmpty():
            break
        nodes = written(child_nodes(large.join(classes, "set_id"), similarity), "nodes")
    # buckets of some 20,000 rows
    rows = small.count()
    partitions = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = small.join(classes, "set_id")
    edges = small_node_edges(members, _least_agreement(similarity), max(partitions, rows // 20_000))
    leaders = written(large.groupBy("node").agg(F.min("set_id").alias("a")), "leaders")
    stars = large.join(leaders, "node").filter("set_id > a").select("a", F.col("set_id").alias("b"))
    return edges.unionByName(stars)


def linked_sets(sets: list[np.ndarray], percent: int, across: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Each set but the first of its component, after that first one. With ``across``, only links between sets
    of different marks are looked for."""
    sizes = np.array([len(x) for x in sets])
    values = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    ranked, owners = values[order], owners[order]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    lengths = np.diff(np.append(starts, len(ranked)))
    number = np.empty(len(values), dtype=np.int64)
    number[order] = np.repeat(np.arange(len(starts)), lengths)
    ends = np.cumsum(sizes)

    def partners(k: int) -> np.ndarray:
        own = number[ends[k] - sizes[k] : ends[k]]
        own = own[lengths[own] > 1]
        common = np.bincount(owners[ragged(starts[own], lengths[own])], minlength=len(sets))
        linked = 100 * common >= percent * (sizes + sizes[k] - common)
        linked[: k + 1] = False
        if across is not None:
            linked &= across != across[k]
        return np.flatnonzero(linked)

    return _connected(len(sets), ((k, partners(k)) for k in range(len(sets))))


def confirmed_links(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges ``a``, ``b`` between classes that connect all that are linked.

    ``members`` is a written table of loose groups: ``root``, ``set_id``, ``shingles``. Groups of one
    block are dealt into units of bounded size; of a larger group each two blocks are a unit.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    sizes = written(members.groupBy("root").agg(F.count("*").alias("size")).withColumn("blocks", blocks), "group-sizes")
    rows = sizes.agg(F.sum("size")).first()[0] or 0
    partitions = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = max(partitions, rows // BLOCK)
    placed = members.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root",
        "set_id",
        "shingles",
        "block",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(units)))
        .otherwise(F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other")))
        .alias("unit"),
    )

    def link(group: pa.Table) -> pa.Table:
        group = group.sort_by([(x, "ascending") for x in ("root", "low", "high", "set_id")]).combine_chunks()
        ids, blocks = group.column("set_id").to_pylist(), group.column("block").to_numpy()
        keys = list(zip(group.column("root").to_pylist(), group.column("low").to_pylist(), group.column("high").to_pylist()))
        shingles = group.column("shingles")
        found, begin = [], 0
        while begin < len(keys):
            end = begin
            while end < len(keys) and keys[end] == keys[begin]:
                end += 1
            sets = [np.frombuffer(shingles[k].as_buffer(), dtype="<u8") for k in range(begin, end)]
            across = blocks[begin:end] if keys[begin][1] != keys[begin][2] else None
            found += [(ids[begin + i], ids[begin + j]) for i, j in linked_sets(sets, percent, across)]
            begin = end
        return _edges(found)

    return paired.groupBy("unit").applyInArrow(link, "a binary, b binary")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``set_id`` and ``shingles`` of the documents whose ids are in ``wanted``, once per document."""
    ship(docs.sparkSession)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                sets = [x for x in shingle_sets(filled(piece.column("text"))) if len(x)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_id(x) for x in sets], pa.binary()),
                        pa.array([x.astype("<u8").tobytes() for x in sets], pa.binary()),
                    ],
                    names=["set_id", "shingles"],
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = chosen.join(wanted, chosen["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi").select("text")
    return chosen.mapInArrow(collect, "set_id binary, shingles binary")


def class_links(docs: DataFrame, firsts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between classes: enough of them to connect all that are connected."""
    groups = written(components(loose_edges(classes, percent)), "loose-groups")
    wanted = written(
        firsts.join(groups.select(F.col("vertex").alias("set_id")), "set_id", "left_semi").select(
            F.col("first_id").alias("doc_id")
        ),
        "wanted",
    )
    # of documents that repeat an id, only the sets asked for, each once
    sets = full_sets(docs, wanted).dropDuplicates(["set_id"])
    members = sets.join(groups, sets["set_id"] == groups["vertex"]).select("root", "set_id", "shingles")
    return confirmed_links(written(members, "group-sets"), percent)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, carry: Sequence[str] = ()) -> DataFrame:
    """Per document ``doc_id``, ``n_shingles``, ``component_id``, ``kept`` and the columns ``carry``.

    Documents are linked if 100 times the shingles they share reach ``percent`` times the
    shingles either has; components are those of the links. ``component_id`` is the least
    ``doc_id`` of a component and ``kept`` marks the rows that have it. A text with fewer words than
    a shingle counts as one shingle; null and empty texts have none, are linked with nothing and
    kept. Null ids come into no minimum; a component of null ids only has a null id, and its rows
    are kept. Rows that repeat a kept id are kept, too. Long texts are taken whole, some 60 bytes in memory for
    each of their bytes. Other columns are ignored. An empty table gives no rows.
    """
    measured = written(document_sets(docs, carry), "document-sets")
    worded = measured.filter("set_id is not null")
    # rows of a class have equal sketches
    first = [F.min("doc_id").alias("first_id"), F.any_value("sketch").alias("sketch")]
    classes = written(worded.groupBy("set_id").agg(*first), "classes")
    firsts = classes.select("set_id", "first_id")
    links = class_links(docs, firsts, classes.select("set_id", "sketch"), percent)
    roots = written(components(links), "roots")
    with_root = firsts.join(roots, firsts.set_id == roots.vertex, "left").select(
        "set_id", "first_id", F.coalesce("root", "set_id").alias("root")
    )
    least = with_root.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(with_root.join(least, "root").select("set_id", "component_id"), "class-components")
    linked = worded.join(named, "set_id").select("doc_id", "n_shingles", "component_id", *carry)
    alone = measured.filter("set_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *carry
    )
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return linked.unionByName(alone).select("doc_id", "n_shingles", "component_id", kept, *carry)
