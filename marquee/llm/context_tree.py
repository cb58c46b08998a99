"""Code lengths of texts under a context tree weighted over all depths, learned from the corpus.

A text is the bytes of its words (A-Z lowered) with single spaces between, and an end. Each byte is
coded in eight binary decisions; a decision's context is the byte's bits so far and the last 0 to
``DEPTH`` bytes. A node (context and bits so far) has counts of zeros and ones in the training texts and
thereby a Krichevsky-Trofimov estimate. Bottom up, context tree weighting gives each node the
weight of its own estimate against its children's; top down, a decision's probability is
the mixture along its path, down to the deepest node met in training.

The counts of all nodes follow from those of ``DEPTH + 1`` bytes in a row. Tasks count these per part of
the corpus (some megabytes of text) and send them, sorted and packed, to buckets by the three nearest
bytes of the context, so a bucket holds whole subtrees. Buckets fill the tree from the leaves
up to depth 2; the rest of it, bounded by the alphabet, is put together on the driver and sent to the
buckets, which answer every part with the code lengths of just the byte sequences that occur in it.
With those, a part scores its texts. Word counts for the base score go the same way. So nothing
of the corpus's size is held in one place, and what is moved grows with the distinct
sequences per part, not with the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import held_out_part, ship, written
from marquee.llm.text import Words, filled, hash_words, lower_ascii, mix, slices

DEPTH = 6
# Bytes of text in a part, and the most parts whose counts one task call puts together.
PART_BYTES = 10 << 20
FAN_IN = 128
# Bytes of text that a task works on at a time.
STEP_BYTES = 2 << 20
LEAST_BUCKETS = 64
# Levels above this depth are put together on the driver: at most 2**16 contexts of 255 nodes.
TOP = 2

TEXT, GRAMS, WORDS = 0, 1, 2
BLOCK = "kind int, bucket long, part long, a binary, b binary, c binary"
_BLOCK_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int64()), ("part", pa.int64())] + [(x, pa.binary()) for x in "abc"]
)
# Code lengths are sent as 32-bit floats without this many of their last bits: to one part in 2**17.
_DROPPED = np.uint32(7)
_END = "\n"
_NODE_BITS = np.uint64(8)


# --- packed arrays ---------------------------------------------------------------------------


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """An array as bytes: differences if ascending, byte planes, zstandard."""
    import zstandard

    if ascending and len(values):
        values = np.diff(values, prepend=values[:1] * 0)
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype, ascending: bool = False) -> np.ndarray:
    import zstandard

    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(size, -1)
    values = np.ascontiguousarray(planes.T).view(dtype).ravel()
    return np.cumsum(values, dtype=dtype) if ascending else values


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = _runs(key)
    return key[first], np.add.reduceat(count[order], first) if len(first) else count


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def short_floats(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 up as integers that take three bytes, small ones as finely as large ones."""
    whole = np.maximum(values, 0).astype(np.float32).view(np.uint32)
    return (whole + (np.uint32(1) << (_DROPPED - np.uint32(1)))) >> _DROPPED


def long_floats(values: np.ndarray) -> np.ndarray:
    """The numbers that ``short_floats`` was given, to one part in 2**17."""
    return (values << _DROPPED).view(np.float32).astype(np.float64)


# --- texts -----------------------------------------------------------------------------------


def normalized(texts: pa.Array) -> pa.Array:
    spaced = pc.replace_substring_regex(lower_ascii(texts), r"[\x09-\x0D\x20]+", " ")
    return pc.ascii_trim(spaced, characters=" ")


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the normalized texts and for their ends, it and the ``DEPTH`` bytes before,
    as one number; and the text each belongs to. Before a text's start come ends."""
    framed = pc.binary_join_element_wise(pa.scalar(_END * DEPTH), texts, pa.scalar(_END), pa.scalar(""))
    offsets = np.frombuffer(framed.buffers()[1], dtype=np.int32)[: len(framed) + 1].astype(np.int64)
    data = np.frombuffer(framed.buffers()[2], dtype=np.uint8)[: offsets[-1]].astype(np.uint64)
    rolling = data[DEPTH:].copy()
    for k in range(1, DEPTH + 1):
        rolling |= data[DEPTH - k : len(data) - k] << np.uint64(8 * k)
    lengths = np.diff(offsets) - DEPTH
    rows = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    places = np.arange(len(rows)) + DEPTH * rows
    return rolling[places], rows


class PartCounts:
    """Distinct byte sequences and words of some texts, with their counts in training texts; of
    those that occur in held-out texts only, the count is 0."""

    def __init__(self) -> None:
        self.parts: dict[int, tuple[list, list]] = {GRAMS: ([], []), WORDS: ([], [])}

    def add(self, texts: pa.Array, held_out: np.ndarray) -> None:
        keys, rows = grams(texts)
        # the lowest bit tells training from held-out occurrences
        marked = keys << np.uint64(1) | (~held_out[rows]).astype(np.uint64)
        marked.sort()
        first = _runs(marked >> np.uint64(1))
        self._hold(GRAMS, (marked >> np.uint64(1))[first], np.add.reduceat(marked & np.uint64(1), first))
        words = Words(texts)
        learnt = np.repeat(~held_out, np.diff(words.offsets))
        hashes = np.append(hash_words(words.vocabulary), _end_hash())
        counts = np.bincount(words.codes[learnt], minlength=len(hashes))
        counts[-1] = np.count_nonzero(~held_out)
        self._hold(WORDS, hashes, counts)

    def _hold(self, kind: int, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts[kind][0].append(keys)
        self.parts[kind][1].append(counts.astype(np.int32))

    def by_bucket(self, kind: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys and counts by bucket, ascending in each, and where each bucket ends. Forgets them."""
        keys, counts = summed(*self.parts.pop(kind))
        bucket = _bucket(kind, keys, buckets)
        order = np.argsort(bucket, kind="stable")
        return keys[order], counts[order], np.cumsum(np.bincount(bucket, minlength=buckets))


def counted_parts(docs: DataFrame, buckets: int) -> DataFrame:
    """Blocks of all parts: their texts, and their counts of byte sequences and words by bucket."""
    ship(docs.sparkSession)

    def flush(part: int, texts: list[pa.Array], ids: list, flags: list, held: PartCounts) -> Iterator[pa.RecordBatch]:
        import zstandard

        body = pc.binary_join(pa.ListArray.from_arrays([0, sum(map(len, texts))], pa.concat_arrays(texts)), _END)
        texts.clear()
        whole = {
            "kind": TEXT,
            "bucket": -1,
            "part": part,
            "a": zstandard.ZstdCompressor(level=3).compress(body[0].as_buffer()),
            "b": np.concatenate(ids).astype("<i8").tobytes(),
            "c": np.concatenate(flags).astype(np.uint8).tobytes(),
        }
        del body
        yield pa.RecordBatch.from_pylist([whole], _BLOCK_SCHEMA)
        for kind in (GRAMS, WORDS):
            keys, counts, ends = held.by_bucket(kind, buckets)
            rows, begin = [], 0
            for bucket, end in enumerate(ends.tolist()):
                if end > begin:
                    a, b = pack(keys[begin:end], ascending=True), pack(counts[begin:end].astype(np.int64))
                    rows.append({"kind": kind, "bucket": bucket, "part": part, "a": a, "b": b, "c": None})
                begin = end
            yield pa.RecordBatch.from_pylist(rows, _BLOCK_SCHEMA)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 24
        texts, ids, flags, size, held = [], [], [], 0, PartCounts()
        for batch in batches:
            for piece in slices(batch, size=STEP_BYTES):
                own = normalized(filled(piece.column("text")))
                held_out = piece.column("held_out").to_numpy(zero_copy_only=False)
                doc_ids = piece.column("doc_id")
                texts.append(own)
                ids.append(doc_ids.fill_null(0).to_numpy(zero_copy_only=False))
                flags.append(held_out + 2 * doc_ids.is_null().to_numpy(zero_copy_only=False))
                held.add(own, held_out)
                size += pc.sum(pc.binary_length(own)).as_py() or 0
                if size >= PART_BYTES:
                    yield from flush(part, texts, ids, flags, held)
                    part += 1
                    texts, ids, flags, size, held = [], [], [], 0, PartCounts()
        if texts:
            yield from flush(part, texts, ids, flags, held)

    return docs.mapInArrow(count, BLOCK)


def _end_hash() -> np.uint64:
    return hash_words(pa.array([_END]))[0]


def _bucket(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the three nearest bytes of the context, or by word."""
    near = keys >> np.uint64(8) & np.uint64(0xFFFFFF) if kind == GRAMS else keys
    return (mix(near + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


# --- the tree --------------------------------------------------------------------------------

_SMALL = np.array([0.0] * 2 + [math.lgamma(k / 2) for k in range(2, 600)])
_SMALL[1] = math.lgamma(0.5)


def _lgamma_half(twice: np.ndarray) -> np.ndarray:
    """Log-gamma of ``twice / 2`` for whole numbers from 1."""
    z = np.maximum(twice / 2.0, 50.0)
    series = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3)
    return np.where(twice < len(_SMALL), _SMALL[np.minimum(twice, len(_SMALL) - 1)], series)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return (
        _lgamma_half(2 * zeros + 1) + _lgamma_half(2 * ones + 1) - _lgamma_half(2 * (zeros + ones) + 2)
    ) - math.log(math.pi)


class Nodes:
    """The nodes of one depth and bit level: sorted ``keys`` (context, then a one and the bits so
    far), their counts, and what the tree makes of them."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray):
        self.keys, self.zeros, self.ones = keys, zeros.astype(np.int64), ones.astype(np.int64)
        self.own = log_kt(self.zeros, self.ones)
        self.log_weighted = self.own
        self.weight = np.ones(len(keys))

    def weigh(self, children: np.ndarray) -> None:
        """Mix with the children's summed log probabilities, half and half."""
        both = np.logaddexp(self.own, children)
        self.log_weighted = both - math.log(2)
        self.weight = np.exp(self.own - both)

    def descend(self, above: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        """Of the chance of a one: ``fixed + free * (what the child says)``, and ``here``, the
        chance if the path ends here. A node not met in training says what its parent does."""
        fixed, free, here = above
        one = (self.ones + 0.5) / (self.zeros + self.ones + 1.0)
        seen = self.zeros + self.ones > 0
        self.path = (fixed + free * self.weight * one, free * (1 - self.weight), np.where(seen, fixed + free * one, here))


def _parents(keys: np.ndarray, depth: int) -> np.ndarray:
    """Keys of the nodes one context byte shorter, for nodes of a depth."""
    return keys & np.uint64((1 << 8 * depth) - 1)


def _subtrees(keys: np.ndarray, counts: np.ndarray) -> tuple[dict, np.ndarray]:
    """Nodes by (depth, bit level) for depths over ``TOP``, weighted bottom up; and for each key and
    bit level its deepest node."""
    nodes: dict[tuple[int, int], Nodes] = {}
    leaf = np.zeros((8, len(keys)), dtype=np.int64)
    for depth in range(DEPTH, TOP, -1):
        if depth == DEPTH:
            own, n = keys, counts
        else:
            own, n = summed([keys & np.uint64((1 << 8 * (depth + 1)) - 1)], [counts])
        context, byte = own >> _NODE_BITS << _NODE_BITS, own & np.uint64(255)
        for level in range(8):
            ids = context | np.uint64(1 << level) | byte >> np.uint64(8 - level)
            first = _runs(ids)
            one = (byte >> np.uint64(7 - level) & np.uint64(1)).astype(np.int64)
            total, ones = np.add.reduceat(n, first), np.add.reduceat(n * one, first)
            here = nodes[depth, level] = Nodes(ids[first], total - ones, ones)
            if depth == DEPTH:
                leaf[level] = np.cumsum(np.append(False, ids[1:] != ids[:-1]))
            else:
                below = nodes[depth + 1, level]
                at = np.searchsorted(here.keys, _parents(below.keys, depth + 1))
                here.weigh(np.bincount(at, below.log_weighted, minlength=len(here.keys)))
    return nodes, leaf


def top_sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """What a bucket adds to the nodes of depth ``TOP``: keys, zeros, ones, children's log
    probabilities."""
    nodes, _ = _subtrees(keys, counts)
    parts = [nodes[TOP + 1, level] for level in range(8)]
    parents = np.concatenate([_parents(x.keys, TOP + 1) for x in parts])
    found, at = np.unique(parents, return_inverse=True)
    add = lambda values: np.bincount(at, np.concatenate(values), minlength=len(found))
    return (
        found,
        add([x.zeros for x in parts]).astype(np.int64),
        add([x.ones for x in parts]).astype(np.int64),
        add([x.log_weighted for x in parts]),
    )


def top_paths(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Rows ``fixed``, ``free``, ``here`` of the nodes of depth ``TOP`` (see ``Nodes.descend``)."""
    levels, links = [], []
    here = Nodes(keys, zeros, ones)
    here.weigh(children)
    levels.append(here)
    for depth in range(TOP, 0, -1):
        found, at = np.unique(_parents(here.keys, depth), return_inverse=True)
        add = lambda values: np.bincount(at, values, minlength=len(found))  # noqa: B023, E731
        above = Nodes(found, add(here.zeros), add(here.ones))
        above.weigh(add(here.log_weighted))
        levels.append(above)
        links.append(at)
        here = above
    nothing = np.zeros(len(here.keys))
    here.descend((nothing, nothing + 1, nothing + 0.5))
    for child, at in zip(levels[-2::-1], links[::-1]):
        child.descend(tuple(x[at] for x in here.path))
        here = child
    return np.stack(here.path)


def code_lengths(keys: np.ndarray, counts: np.ndarray, top_keys: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Bits for the last byte of each sequence after the bytes before it."""
    nodes, leaf = _subtrees(keys, counts)
    byte, bits = keys & np.uint64(255), np.zeros(len(keys))
    for level in range(8):
        above = None
        for depth in range(TOP + 1, DEPTH + 1):
            here = nodes[depth, level]
            parents = _parents(here.keys, depth)
            if above is None:
                at = np.searchsorted(top_keys, parents)
                here.descend(tuple(x[at] for x in top))
            else:
                at = np.searchsorted(above.keys, parents)
                here.descend(tuple(x[at] for x in above.path))
            above = here
        one = above.path[2][leaf[level]]
        bits -= np.log2(np.where(byte >> np.uint64(7 - level) & np.uint64(1), one, 1 - one))
    return bits


# --- the jobs --------------------------------------------------------------------------------


def _merged(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return summed(
        [unpack(x, np.uint64, ascending=True) for x in rows.column("a").to_pylist()],
        [unpack(x, np.int64) for x in rows.column("b").to_pylist()],
    )


def _model(blocks: DataFrame) -> DataFrame:
    """One block of summed counts per kind and bucket. Many parts are put together in rounds."""

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        keys, counts = _merged(rows)
        out = {"kind": key[0].as_py(), "bucket": key[1].as_py(), "part": key[2].as_py()}
        return pa.Table.from_pylist([out | {"a": pack(keys, ascending=True), "b": pack(counts)}], _BLOCK_SCHEMA)

    counts = blocks.filter(F.col("kind") != TEXT)
    most = counts.groupBy("kind", "bucket").count().agg(F.max("count")).first()[0] or 0
    while True:
        groups = -(-most // FAN_IN)
        group = F.pmod(F.xxhash64("part"), F.lit(max(1, groups)))
        counts = written(
            counts.withColumn("part", group).groupBy("kind", "bucket", "part").applyInArrow(merge, BLOCK), "model"
        )
        if groups <= 1:
            return counts
        most = groups


def _top_table(model: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and paths of the nodes of depth ``TOP``: a bounded number of rows comes back."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                keys, zeros, ones, children = top_sums(unpack(a, np.uint64, ascending=True), unpack(b, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (keys.astype(np.int64), zeros, ones, children)],
                    names=["node", "zeros", "ones", "children"],
                )

    added = model.filter(F.col("kind") == GRAMS).mapInArrow(sums, "node long, zeros long, ones long, children double")
    total = added.groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("children")).orderBy("node").toArrow()
    node, zeros, ones, children = (total.column(k).to_numpy() for k in range(4))
    return node.astype(np.uint64), top_paths(node.astype(np.uint64), zeros, ones, children)


def _word_totals(model: DataFrame) -> tuple[int, int]:
    """Tokens and distinct tokens of the training texts."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [unpack(b, np.int64) for b in batch.column("b").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(x.sum()) for x in counts], pa.int64()),
                 pa.array([int(np.count_nonzero(x)) for x in counts], pa.int64())], names=["tokens", "distinct"]
            )

    added = model.filter(F.col("kind") == WORDS).mapInArrow(sums, "tokens long, distinct long")
    tokens, distinct = added.agg(F.sum("tokens"), F.sum("distinct")).first()
    return tokens or 0, distinct or 0


def _answers(blocks: DataFrame, model: DataFrame, parts: int, top) -> DataFrame:
    """For every part and bucket the code lengths of its byte sequences or the counts of its words, in
    the order it asked. A model block goes to each group of ``FAN_IN`` parts."""
    groups = max(1, -(-parts // FAN_IN))

    def answer(asking: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        if asking.num_rows and known.num_rows:
            kind, bucket = known.column("kind")[0].as_py(), known.column("bucket")[0].as_py()
            keys, counts = _merged(known)
            values = counts
            if kind == GRAMS:
                values = short_floats(code_lengths(keys, counts, *top.value))
            for part, a in zip(asking.column("part").to_pylist(), asking.column("a").to_pylist()):
                own = values[np.searchsorted(keys, unpack(a, np.uint64, ascending=True))]
                out.append({"kind": kind, "bucket": bucket, "part": part, "a": None, "b": pack(own), "c": None})
        return pa.Table.from_pylist(out, _BLOCK_SCHEMA)

    left = blocks.filter(F.col("kind") != TEXT).withColumn("spread", F.pmod(F.xxhash64("part"), F.lit(groups)))
    right = model.withColumn("spread", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    keys = ["kind", "bucket", "spread"]
    return left.drop("b", "c").groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(answer, BLOCK)


def _table(asked: PartCounts, kind: int, buckets: int, answers: pa.Table, dtype) -> tuple[np.ndarray, np.ndarray]:
    """A part's keys, ascending, and what the buckets answered for them."""
    keys, _, _ = asked.by_bucket(kind, buckets)
    own = answers.filter(pc.equal(answers.column("kind"), kind)).sort_by("bucket")
    values = np.concatenate([unpack(x, dtype) for x in own.column("b").to_pylist()])
    order = np.argsort(keys)
    return keys[order], values[order]


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
    "score double, n_bytes long, bits_per_byte double"
)


def _scored(tokens: int, distinct: int, buckets: int):
    def score(text: pa.Table, answers: pa.Table) -> pa.Table:
        import zstandard

        body = zstandard.ZstdDecompressor().decompress(text.column("a")[0].as_py())
        ids = np.frombuffer(text.column("b")[0].as_py(), dtype="<i8")
        flags = np.frombuffer(text.column("c")[0].as_py(), dtype=np.uint8)
        texts = pa.array(body.decode().split(_END))
        asked = PartCounts()
        for piece in slices(pa.record_batch([texts], names=["text"]), size=STEP_BYTES):
            asked.add(piece.column("text"), np.ones(piece.num_rows, dtype=bool))
        known, lengths = _table(asked, GRAMS, buckets, answers, np.uint32)
        lengths = long_floats(lengths)
        words_known, word_counts = _table(asked, WORDS, buckets, answers, np.int64)
        bits, base = np.zeros(len(ids)), np.zeros(len(ids))
        n_tokens, n_known = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
        logs = np.log10((word_counts + 1.0) / (tokens + distinct + 1.0))
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ids):
            # a text's number fits the byte above the sequence
            reach = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + STEP_BYTES, side="right"))
            stop = min(max(at + 1, reach), at + 256, len(ids))
            own = texts.slice(at, stop - at)
            keys, rows = grams(own)
            packed = np.sort(keys << np.uint64(8) | rows.astype(np.uint64))
            first = _runs(packed)
            times = np.diff(np.append(first, len(packed)))
            packed = packed[first]
            cost = lengths[np.searchsorted(known, packed >> np.uint64(8))]
            bits[at:stop] = np.bincount((packed & np.uint64(255)).astype(np.int64), cost * times, minlength=stop - at)
            words = Words(own)
            number = np.searchsorted(words_known, np.append(hash_words(words.vocabulary), _end_hash()))
            per_text = np.diff(words.offsets)
            rows = np.repeat(np.arange(stop - at), per_text)
            base[at:stop] = np.bincount(rows, logs[number][words.codes], minlength=stop - at) + logs[number[-1]]
            met = (word_counts[number] > 0).astype(np.int64)
            n_known[at:stop] = np.bincount(rows, met[words.codes], minlength=stop - at) + met[-1]
            n_tokens[at:stop] = per_text + 1
            at = stop
        n_bytes = np.diff(sizes, prepend=0) + 1
        return pa.table(
            {
                "doc_id": pa.array(ids, mask=flags >= 2),
                "held_out": pa.array(flags % 2 == 1),
                "n_tokens": n_tokens,
                "n_known": n_known,
                "train_tokens": np.full(len(ids), tokens, dtype=np.int64),
                "base_score": base,
                "score": -bits * math.log10(2),
                "n_bytes": n_bytes,
                "bits_per_byte": bits / n_bytes,
            }
        )

    return score


def score_texts(docs: DataFrame, held_out: Column) -> DataFrame:
    """Score all texts by a model of those that are not ``held_out``.

    Returns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (tokens met in
    training), ``train_tokens``, ``base_score`` (log10 probability under add-one word frequencies),
    ``score`` (log10 probability under the context tree), ``n_bytes`` and ``bits_per_byte``. Both are
    probabilities of the sequence of words, their letters A-Z lowered. Null texts count as empty:
    they have an end only. Repeated rows are learnt from and scored each; an empty table gives no
    rows; with nothing to learn from, every bit of a text costs a bit. Words are counted by 64-bit
    hashes; code lengths of bytes, and so the scores, are right to one part in 2**17. Long texts are counted
    whole, some 70 bytes in memory for each of their bytes. Other columns are ignored.
    """
    spark = docs.sparkSession
    buckets = max(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    frame = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    blocks = written(counted_parts(frame, buckets), "parts")
    texts = blocks.filter(F.col("kind") == TEXT)
    parts = texts.count()
    if not parts:
        return spark.createDataFrame([], SCORES)
    model = _model(blocks)
    top = spark.sparkContext.broadcast(_top_table(model))  # at most 2**16 * 255 nodes
    tokens, distinct = _word_totals(model)
    answers = _answers(blocks, model, parts, top)
    return texts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_scored(tokens, distinct, buckets), SCORES)


def language_model_scores(docs: DataFrame) -> DataFrame:
    """Scores of all documents; a seventh of them, by a checksum of the id, is held out."""
    return score_texts(docs, held_out_part("doc_id", 7, 2))
