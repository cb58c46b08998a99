"""Packing token streams into fixed windows by order-preserving dynamic programming.

Documents in ascending order of id form a stream. Cuts may fall at document ends (free), at
sentence ends (a small penalty) and inside runs without sentence ends (a larger one). Over these
cut points the cheapest sequence of windows minimises padding plus penalties: with tokens
``P[j]`` up to cut ``j``, ``cost[j] = min over P[j] - P[i] <= size of (cost[i] + P[i]) + size - P[j]
+ penalty[j]``. The minimum slides with ``j``, so a monotone queue gives it in constant time.

Each task packs its range of the stream, block by block; the last windows of a block are
packed again with the next, so that block borders cost nothing. Only a task's last
window can be far from full; as a window of a power of two needs no padding, the rest is cut into
such windows where that is cheaper.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ship
from marquee.llm.text import filled, slices
from marquee.llm.tokens import encoder, with_end

SIZE = 4096
SENTENCE_CUT = 8
HARD_CUT = 64
# Runs of more tokens than this without a sentence end have cut points inside, so far apart.
HARD_RUN = 128
HARD_STRIDE = 16
# A block of the dynamic program has at least so many windows; all but its last two are final.
BLOCK_WINDOWS = 64

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, `offset` long"
)
PIECE_SCHEMA = pa.schema([(column.split()[0].strip("`"), pa.int64()) for column in PIECES.split(", ")])


def _union(*places: np.ndarray) -> np.ndarray:
    merged = np.sort(np.concatenate(places))
    return merged[np.append(True, merged[1:] != merged[:-1])] if len(merged) else merged


def _among(places: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which places occur in an ascending array."""
    if not len(ascending):
        return np.zeros(len(places), dtype=bool)
    at = np.minimum(np.searchsorted(ascending, places), len(ascending) - 1)
    return ascending[at] == places


def cut_points(offsets: np.ndarray, ends: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Places where the stream of ids may be cut, ascending, and the penalty of each.

    ``offsets`` are document borders from 0 to the number of ids, ``ends`` the places after
    sentence ends, both ascending. No two cut points in a row are more than ``size`` apart.
    """
    run, stride = min(HARD_RUN, size), min(HARD_STRIDE, size)
    soft = _union(offsets, ends)
    gaps = np.diff(soft)
    wide = gaps > run
    per_gap = (gaps[wide] - 1) // stride
    inner = np.repeat(soft[:-1][wide], per_gap) + stride * (
        np.arange(int(per_gap.sum())) - np.repeat(np.cumsum(per_gap) - per_gap, per_gap) + 1
    )
    points = _union(soft, inner)
    points = points[points > 0]
    penalty = np.full(len(points), HARD_CUT)
    penalty[_among(points, ends)] = SENTENCE_CUT
    penalty[_among(points, offsets)] = 0
    return points, penalty


def best_cuts(points: np.ndarray, penalty: np.ndarray, size: int = SIZE) -> list[int]:
    """The cheapest cuts of a stream that starts at 0 and ends at the last point."""
    places = [0, *points.tolist()]
    fines = [0, *penalty.tolist()]
    cost, before = [0] * len(places), [0] * len(places)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost + place, index), cheapest first
    for j in range(1, len(places)):
        here = places[j]
        while here - places[queue[0][1]] > size:
            queue.popleft()
        value, i = queue[0]
        total = value + size - here + fines[j]
        cost[j], before[j] = total, i
        value = total + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [], len(places) - 1
    while j:
        cuts.append(places[j])
        j = before[j]
    return cuts[::-1]


def tail_lengths(rest: int, size: int = SIZE, penalty: int = HARD_CUT) -> list[int]:
    """How to cut a last, unfilled window: powers of two first, as long as that is cheaper."""
    if not rest:
        return []
    lengths, best, taken, cost = [rest], None, [], 0
    while True:
        padding = 0 if rest & (rest - 1) == 0 else size - rest
        if best is None or cost + padding < best:
            best, lengths = cost + padding, [*taken, rest]
        if padding == 0:
            return lengths
        power = 1 << (rest.bit_length() - 1)
        taken, rest, cost = [*taken, power], rest - power, cost + penalty


class _Stream:
    """The part of a task's stream that is not packed yet."""

    def __init__(self, size: int, first_sequence: int):
        self.size, self.sequence = size, first_sequence
        self.ids = np.zeros(0, dtype=np.uint32)
        self.ends = np.zeros(0, dtype=np.int64)
        # of the documents in reach: id, whether null, tokens, and where they begin (below 0 if cut)
        self.docs = np.zeros((4, 0), dtype=np.int64)

    def add(self, doc_ids, null, offsets, ids, ends) -> None:
        at = len(self.ids)
        self.docs = np.hstack([self.docs, np.stack([doc_ids, null, np.diff(offsets), offsets[:-1] + at])])
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, ends + at])

    def pack(self, last: bool) -> pa.RecordBatch | None:
        if not len(self.ids) or (not last and len(self.ids) < BLOCK_WINDOWS * self.size):
            return None
        starts = self.docs[3]
        borders = np.append(np.maximum(starts, 0), len(self.ids))
        cuts = best_cuts(*cut_points(borders, self.ends, self.size), self.size)
        if not last:
            cuts = cuts[:-2]
        elif (rest := cuts[-1] - (cuts[-2] if len(cuts) > 1 else 0)) < self.size:
            begin = cuts[-1] - rest
            cuts = cuts[:-1] + (begin + np.cumsum(tail_lengths(rest, self.size))).tolist()
        if not cuts:
            return None
        return self._pieces(np.array(cuts))

    def _pieces(self, cuts: np.ndarray) -> pa.RecordBatch:
        end = cuts[-1]
        doc_ids, null, tokens, starts = self.docs
        inside = starts[(starts >= 0) & (starts < end)]
        begins = _union([0], cuts[:-1], inside)
        lengths = np.diff(np.append(begins, end))
        doc = np.searchsorted(starts, begins, side="right") - 1
        window = np.searchsorted(cuts, begins, side="right")
        window_begins = np.concatenate([[0], cuts[:-1]])[window]
        flat = np.ascontiguousarray(self.ids, dtype="<u4")
        view = memoryview(flat).cast("B") if len(flat) else memoryview(b"")
        crcs = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(begins.tolist(), lengths.tolist())]
        columns = [
            pa.array(doc_ids[doc], mask=null[doc].astype(bool)),
            begins - starts[doc],
            lengths,
            crcs,
            tokens[doc],
            self.sequence + window,
            begins - window_begins,
        ]
        out = pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], schema=PIECE_SCHEMA)
        self.sequence += len(cuts)
        self.ids = self.ids[end:]
        self.ends = self.ends[self.ends > end] - end
        reach = starts + tokens > end
        self.docs = self.docs[:, reach]
        self.docs[3] -= end
        return out


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end: int,
    size: int = SIZE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of all documents, each in its place in a sequence of at most ``size`` tokens.

    Returns ``doc_id``, ``start`` (ids of the document before the piece), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset`` (place in the sequence). Null
    texts count as empty, every document has its end id; repeated ids are documents of their own
    and null ids come first. An empty table gives no pieces; other columns are ignored. Long texts are
    encoded whole, some 50 bytes in memory for each of their bytes.
    ``sequence_id`` is unique and ascends with the stream, not gapless.
    """
    ship(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(size, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for piece in slices(batch):
                offsets, ids, ends = encoder(tokenizer).encode(filled(piece.column("text")))
                # the end id of each text moves the places after it
                places = np.flatnonzero(ends) + 1
                places += np.searchsorted(offsets, places, side="left") - 1
                offsets, ids = with_end(offsets, ids, end)
                doc_ids = piece.column("doc_id")
                stream.add(
                    doc_ids.fill_null(0).to_numpy(zero_copy_only=False),
                    doc_ids.is_null().to_numpy(zero_copy_only=False),
                    offsets,
                    ids,
                    places,
                )
                if (out := stream.pack(last=False)) is not None:
                    yield out
        if (out := stream.pack(last=True)) is not None:
            yield out

    return (
        docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
        .withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "place")
        .sortWithinPartitions("doc_id", "place")
        .select("doc_id", "text")
        .mapInArrow(pack, PIECES)
    )
