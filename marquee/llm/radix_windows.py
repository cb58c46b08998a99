"""Repeated strings of a given length, found by a depth-limited radix sort of suffixes.

A suffix need only be ordered by its first ``length`` bytes (its window): suffixes that are still
together then are exactly the repeats. The sort goes by digits. Each pass parts what is together by the next digit, and
whatever stands alone leaves, so that deeper passes see ever fewer suffixes.

First pass. Of all windows' places one is chosen by content: the least, by hash, of the grams of
``GRAM`` bytes within the window. Equal windows agree in it, so that gram is the first digit, and one row stands for
the run of windows that share the place (their region: all bytes of these windows). Windows whose gram is met
once are no repeats.

Second pass, by the whole region. Equal regions are equal window by window: all of these are repeats. If a gram
has regions of one kind only, it is done.

Further passes, for grams with several kinds of regions: one region of each kind is unrolled to its windows,
these are parted by the bytes of their first half and then by those of the second. The regions of a gram
go to one task for that as they are, and are only unrolled there. A gram with more than ``KINDS`` kinds is no
work for one task: its windows are rows of their own, which are parted by shuffles that count first.

Digits are 64-bit hashes of the bytes and each window has been compared by 128 bits in the end. Texts that
occur twice as a whole are known beforehand by 128 bits of hashes and not searched. Counting repeats
combines map-side; a hot digit is one row where it is joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.buffers import text_bytes
from marquee.llm.common import shared, ship, written
from marquee.llm.text import mix, ragged, slices

LENGTH = 200
# Bytes of the first digit. Longer ones are met less often by chance, shorter ones give fewer rows.
GRAM = 64
# Text that a task works on at once, if no text is longer.
SLICE = 1 << 20

# The filter that spares the second pass rows: bits per gram, greatest size in 64-bit cells, hashes.
BITS = 16
MOST_CELLS = 1 << 21
HASHES = 3

# So many kinds of regions of a gram are ordered in one task.
KINDS = 10_000

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 2**64)
_KEY = ["key_1", "key_2"]


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` with null as empty, and 128 bits that stand for the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumns(
        {"key_1": F.xxhash64("text"), "key_2": F.xxhash64(F.lit(13), "text")}
    )


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each byte on: differences of a running polynomial."""
    powers = np.ones(len(data) + 1, dtype=np.uint64)
    powers[1:] = _FACTOR
    inverse = np.ones(len(data) + 1, dtype=np.uint64)
    inverse[1:] = _INVERSE
    powers, inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)
    running = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * inverse[:-1], out=running[1:])
    return mix((running[gram:] - running[:-gram]) * powers[: len(data) + 1 - gram])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: len(values) - width + 1], ahead[width - 1 : len(values)])


def regions(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Hash of the chosen gram, text, and first and last window's start of every region.

    Of equal hashes the one that comes first is chosen, which depends on the window alone, too.
    """
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return empty.astype(np.uint64), empty, empty, empty
    hashes = gram_hashes(data, gram)
    order = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    chosen = (_sliding_least(order, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    starts = ragged(offsets[:-1], sizes)
    texts = np.repeat(np.arange(len(sizes)), sizes)
    chosen = chosen[starts]
    first = np.flatnonzero(np.append(True, (chosen[1:] != chosen[:-1]) | (texts[1:] != texts[:-1]))[: len(starts)])
    last = np.append(first[1:], len(starts)) - 1
    return hashes[chosen[first]], texts[first], starts[first], starts[last[: len(first)]]


def _once(piece: pa.RecordBatch) -> pa.RecordBatch:
    """Rows whose text no earlier row of the piece has. Texts that occur twice are known as copies, and
    are searched only to be compared with."""
    keys = np.stack([piece.column(name).to_numpy() for name in _KEY], axis=1)
    first = np.sort(np.unique(keys, axis=0, return_index=True)[1])
    return piece if len(first) == piece.num_rows else piece.take(pa.array(first))


def _region_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    held, digest = data.tobytes(), xxhash.xxh3_64_intdigest
    pairs = zip(first.tolist(), (last + length).tolist())
    return np.array([digest(held[a:b]) for a, b in pairs], dtype=np.uint64)


def gram_kinds(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``gram``, its number ``n`` of regions, and the least and largest hash of these."""
    names = ["gram", "n", "least", "most"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in map(_once, slices(batch, size=SLICE)):
                data, offsets = text_bytes(piece.column("text"))
                grams, _, first, last = regions(data, offsets, length, gram)
                if not len(grams):
                    continue
                own = _region_hashes(data, first, last, length).view(np.int64)
                order = np.argsort(grams, kind="stable")
                grams, own = grams[order], own[order]
                at = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[at].view(np.int64)), pa.array(np.diff(np.append(at, len(grams)))),
                     pa.array(np.minimum.reduceat(own, at)), pa.array(np.maximum.reduceat(own, at))], names=names
                )

    rows = texts.select("text", *_KEY).mapInArrow(count, "gram long, n long, least long, most long")
    return rows.groupBy("gram").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))


def _places(keys: np.ndarray, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for which in range(HASHES):
        place = mix(keys + np.uint64((which + 1) * _FACTOR % 2**64))
        yield (place >> np.uint64(6)) & np.uint64(cells - 1), np.uint64(1) << (place & np.uint64(63))


def gram_filter(grams: DataFrame) -> np.ndarray:
    """A Bloom filter of grams. It grows with them up to ``MOST_CELLS`` cells, which is the most that comes to
    the driver; a fuller one only lets more rows through to the join."""
    wanted = max(grams.count() * BITS // 64, 64)
    cells = min(MOST_CELLS, 1 << int(wanted - 1).bit_length())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, bit in _places(batch.column("gram").to_numpy().view(np.uint64), cells):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int64)), pa.array(bit.view(np.int64))], names=["cell", "bits"]
                )

    placed = grams.select("gram").mapInArrow(place, "cell long, bits long").groupBy("cell")
    got = placed.agg(F.bit_or("bits").alias("bits")).toArrow()
    filled = np.zeros(cells, dtype=np.uint64)
    filled[got.column("cell").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return filled


def found_regions(texts: DataFrame, cells, length: int, gram: int) -> DataFrame:
    """``gram``, ``region``, the text's key and its first and last window of all regions whose gram passes the
    filter; starts are counted from the text's first byte."""
    names = ["gram", "region", *_KEY, "first", "last"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in map(_once, slices(batch, size=SLICE)):
                data, offsets = text_bytes(piece.column("text"))
                grams, text, first, last = regions(data, offsets, length, gram)
                known = np.ones(len(grams), dtype=bool)
                for cell, bit in _places(grams, len(cells.value)):
                    known &= cells.value[cell] & bit != 0
                grams, text, first, last = grams[known], text[known], first[known], last[known]
                if not len(grams):
                    continue
                rows, begin = pa.array(text), offsets[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams.view(np.int64)),
                     pa.array(_region_hashes(data, first, last, length).view(np.int64)),
                     *(piece.column(name).take(rows) for name in _KEY),
                     pa.array((first - begin).astype(np.int32)), pa.array((last - begin).astype(np.int32))], names=names
                )

    schema = "gram long, region long, key_1 long, key_2 long, first int, last int"
    return texts.select("text", *_KEY).mapInArrow(find, schema)


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``row``, the key, the compressed ``text`` and the ``spans`` of the texts that have some.

    A written table: it fixes the row numbers. Copies of a text are one row, merged first in each task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece in slices(batch, size=4 << 20):
                held = [press.compress(text.encode()) for text in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(name) for name in _KEY), pa.array(held, pa.binary())], names=[*_KEY, "packed"]
                )

    packed = texts.select("text", *_KEY).mapInArrow(pack, "key_1 long, key_2 long, packed binary")
    per_text = spans.groupBy(*_KEY).agg(F.collect_set(F.struct(*_SPAN)).alias("spans"))
    joined = packed.dropDuplicates(_KEY).join(per_text, _KEY).withColumn("row", F.monotonically_increasing_id())
    return written(joined, "texts")


# What is known of the windows of a region: all repeated; to be decided; only there to be compared with.
REPEATED, OPEN, PARTNER = 0, 1, 2


def _unresolved(batch: pa.RecordBatch, hot: bool) -> Iterator[tuple[Any, bytes, list[dict]]]:
    """Row, text and the spans that are open or partners, of grams with many kinds of regions or few."""
    plain = zstandard.ZstdDecompressor()
    for row, packed, spans in zip(*(batch.column(name) for name in ("row", "packed", "spans"))):
        own = [span for span in spans.as_py() if span["kind"] != REPEATED and span["hot"] == hot]
        if own:
            yield row, plain.decompress(packed.as_py()), own


def windows(spanned: DataFrame, length: int) -> DataFrame:
    """``row``, ``start``, ``open`` and the digits of the windows of grams with many kinds of regions."""
    names = ["row", "start", "open", "digit_1", "digit_2"]
    half = length // 2

    def unroll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for row, text, spans in _unresolved(batch, hot=True):
                sizes = np.array([own["last"] - own["first"] + 1 for own in spans])
                starts = ragged(np.array([own["first"] for own in spans]), sizes)
                is_open = np.repeat([own["kind"] == OPEN for own in spans], sizes)
                at = starts.tolist()
                digits = [
                    np.array([digest(text[a + low : a + high]) for a in at], dtype=np.uint64).view(np.int64)
                    for low, high in ((0, half), (half, length))
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(row, len(at)), pa.array(starts.astype(np.int32)),
                     pa.array(is_open), *map(pa.array, digits)], names=names
                )

    rows = spanned.select("row", "packed", "spans")
    return rows.mapInArrow(unroll, "row long, start int, open boolean, digit_1 long, digit_2 long")


def region_bytes(spanned: DataFrame, length: int) -> DataFrame:
    """``gram``, ``row``, ``first``, ``open`` and ``bytes`` of the regions of grams with few kinds of them."""
    names = ["gram", "row", "first", "open", "bytes"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, spans in _unresolved(batch, hot=False):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own["gram"] for own in spans], pa.int64()), pa.repeat(row, len(spans)),
                     pa.array([own["first"] for own in spans], pa.int32()),
                     pa.array([own["kind"] == OPEN for own in spans]),
                     pa.array([text[own["first"] : own["last"] + length] for own in spans], pa.binary())], names=names
                )

    rows = spanned.select("row", "packed", "spans")
    return rows.mapInArrow(cut, "gram long, row long, first int, open boolean, bytes binary")


def together(keys: list[np.ndarray]) -> np.ndarray:
    """Which of some rows have equal keys with another, after a sort by one key after the other."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order) + 1, dtype=bool)
    new[1:-1] = False
    for key in keys:
        new[1:-1] |= key[order[1:]] != key[order[:-1]]
    # alone is what begins anew and is followed by what does
    alone = np.zeros(len(order), dtype=bool)
    alone[order] = new[:-1] & new[1:]
    return ~alone


def order_regions(rows: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Region, and first and last window in it, of the runs of windows in open regions that are repeated. The
    table holds all regions of its grams."""
    binary = rows.column("bytes").combine_chunks()
    binary = binary.chunk(0) if isinstance(binary, pa.ChunkedArray) else binary
    data, offsets = text_bytes(binary.cast(pa.binary()).view(pa.string()))
    half = (length + 1) // 2
    hashes = gram_hashes(data, half)
    sizes = np.diff(offsets) - length + 1
    starts = ragged(offsets[:-1], sizes)
    region = np.repeat(np.arange(len(sizes)), sizes)
    grams = rows.column("gram").to_numpy()
    is_open = rows.column("open").to_numpy()
    left = np.arange(len(starts))
    # by the bytes of the first half, then by those of the second
    for depth in (0, length - half):
        keys = [grams[region[left]], hashes[starts[left]], hashes[starts[left] + depth]]
        left = left[together(keys[: 3 if depth else 2])]
    left = left[is_open[region[left]]]
    owner, place = region[left], starts[left] - offsets[region[left]]
    new = np.ones(len(left), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(left)) - 1 if len(left) else first
    return owner[first], place[first], place[last]


def ordered_in_tasks(regions_of_grams: DataFrame, length: int) -> DataFrame:
    """``row``, ``first`` and ``last`` of repeated windows in open regions; each gram is one task's work."""
    names = ["row", "first", "last"]

    def ordered(table: pa.Table) -> pa.RecordBatch:
        owner, first, last = order_regions(table, length)
        begin = table.column("first").to_numpy()[owner]
        return pa.RecordBatch.from_arrays(
            [table.column("row").combine_chunks().take(pa.array(owner)).cast(pa.int64()),
             pa.array((begin + first).astype(np.int32)), pa.array((begin + last).astype(np.int32))], names=names
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            grams = table.column("gram").to_numpy()
            borders = np.flatnonzero(grams[1:] != grams[:-1]) + 1
            sizes = pc.binary_length(table.column("bytes")).to_numpy().astype(np.int64)
            done, begin = np.concatenate([[0], np.cumsum(sizes)]), 0
            for k, border in enumerate(borders.tolist()):
                # whole grams, some SLICE bytes at once
                if k + 1 == len(borders) or done[borders[k + 1]] - done[begin] > SLICE:
                    yield ordered(table.slice(begin, border - begin))
                    begin = border
            held = table.slice(begin).to_batches()
        if held:
            yield ordered(pa.Table.from_batches(held))

    spread = regions_of_grams.repartition("gram").sortWithinPartitions("gram")
    return spread.mapInArrow(work, "row long, first int, last int")


def radix_pass(suffixes: DataFrame, digits: list[str]) -> DataFrame:
    """What is still together with another suffix when ordered by these digits."""
    together = suffixes.groupBy(*digits).agg(F.count("*").alias("n")).filter("n > 1").select(*digits)
    return suffixes.join(together, digits, "left_semi")


_SPAN = ["kind", "first", "last", "gram", "hot"]


def _spans(rows: DataFrame, kind: int) -> DataFrame:
    """Regions as spans; what is decided needs no gram."""
    known = kind == REPEATED
    gram = F.lit(0).cast("long").alias("gram") if known else F.col("gram")
    hot = F.lit(False).alias("hot") if known else F.col("hot")
    return rows.select(*_KEY, F.lit(kind).alias("kind"), "first", "last", gram, hot)


def repeated_spans(texts: DataFrame, copied: DataFrame, length: int, gram: int) -> DataFrame:
    """The passes over grams and regions: per text key its regions that are repeated, open or partners."""
    repeated = written(
        gram_kinds(texts, length, gram)
        .filter("n > 1")
        .select("gram", (F.col("least") != F.col("most")).alias("mixed")),
        "grams",
    )
    cells = shared(texts.sparkSession, gram_filter(repeated))  # at most MOST_CELLS cells
    found = written(found_regions(texts, cells, length, gram).join(repeated, "gram"), "regions")
    mixed = found.filter("mixed")
    one = F.min(F.struct(*_KEY, "first", "last")).alias("one")
    kinds = written(mixed.groupBy("gram", "region").agg(F.count("*").alias("n"), one), "kinds")
    several = kinds.filter("n > 1").select("gram", "region")
    many = kinds.groupBy("gram").agg(F.count("*").alias("kinds")).filter(F.col("kinds") > KINDS)
    marked = kinds.join(many, "gram", "left").select("gram", "n", "one.*", F.col("kinds").isNotNull().alias("hot"))
    own = _spans(found.filter("not mixed"), REPEATED).unionByName(
        _spans(mixed.join(several, ["gram", "region"], "left_semi"), REPEATED)
    )
    # texts that occur twice are repeated as a whole, and only there to be compared with
    copies = copied.select(*_KEY, F.lit(True).alias("copy"))
    decided = own.unionByName(_spans(marked.filter("n = 1"), OPEN)).join(copies, _KEY, "left")
    kept = decided.filter((F.col("kind") != REPEATED) | F.col("copy").isNull())
    kind = F.when(F.col("copy").isNotNull(), PARTNER).otherwise(F.col("kind")).alias("kind")
    partners = _spans(marked.filter("n > 1"), PARTNER)
    return kept.select(*_KEY, kind, *_SPAN[1:]).unionByName(partners)


def _kept(spanned: DataFrame, hits: DataFrame, length: int) -> DataFrame:
    """``key_1``, ``key_2``, ``n_removed``, ``n_spans``, ``kept_sha256`` of texts with repeats."""
    from hashlib import sha256

    names = [*_KEY, "n_removed", "n_spans", "kept_sha256"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            made = []
            for k in range(batch.num_rows):
                text = np.frombuffer(plain.decompress(batch.column("packed")[k].as_py()), dtype=np.uint8)
                runs = [own for own in batch.column("spans")[k].as_py() if own["kind"] == REPEATED]
                runs += batch.column("hits")[k].as_py() or []
                starts = np.array([own["first"] for own in runs], dtype=np.int64)
                ends = np.array([own["last"] for own in runs], dtype=np.int64) + length
                border = np.zeros(len(text) + 1, dtype=np.int32)
                np.add.at(border, starts, 1)
                np.add.at(border, ends, -1)
                removed = np.cumsum(border[:-1]) > 0
                spans = int(removed[:1].sum() + np.count_nonzero(removed[1:] & ~removed[:-1]))
                made.append((int(removed.sum()), spans, sha256(text[~removed].tobytes()).hexdigest()))
            n, spans, digest = zip(*made) if made else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in _KEY), pa.array(n, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digest, pa.string())], names=names
            )

    per_row = hits.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("hits"))
    joined = spanned.join(per_row, "row", "left").select(*_KEY, "packed", "spans", "hits")
    schema = "key_1 long, key_2 long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(cut, schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int | None = None) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` for every document.

    Every byte goes that is covered by a string of ``length`` bytes which also starts anywhere else in the
    texts, overlapping itself or not. Null texts are empty; a text shorter than ``length`` stays. Rows that
    repeat an id and a text are copies like others and each has a result. Null ids are kept. Long texts are
    worked on whole, some 60 bytes in memory for each of their bytes, and are no longer than 4 GB. Other
    columns are ignored; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    gram = min(gram or GRAM, length)
    named = keyed(docs)
    rows = named.select("doc_id", *_KEY, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    texts = named.filter(F.octet_length("text") >= length)
    copied = written(texts.groupBy(*_KEY).agg(F.count("*").alias("copies")).filter("copies > 1"), "copied")
    spans = repeated_spans(texts, copied, length, gram)
    spanned = with_spans(texts, spans)
    hot = written(radix_pass(written(windows(spanned, length), "windows"), ["digit_1"]), "pass")
    single = radix_pass(hot, ["digit_1", "digit_2"]).filter("open")
    hits = ordered_in_tasks(region_bytes(spanned, length), length).unionByName(
        single.select("row", F.col("start").alias("first"), F.col("start").alias("last"))
    )
    cut = written(_kept(spanned, hits, length), "cut")
    copy = F.col("copies").isNotNull()
    result = rows.join(copied, _KEY, "left").join(cut, _KEY, "left")
    nothing = F.sha2(F.lit(""), 256)

    def either(all_of_it: Column, part: str, none: Column) -> Column:
        return F.when(copy, all_of_it).otherwise(F.coalesce(F.col(part), none))

    return result.select(
        "doc_id",
        "n_bytes",
        either(F.col("n_bytes"), "n_removed", F.lit(0).cast("long")).alias("n_removed"),
        either(F.lit(1).cast("long"), "n_spans", F.lit(0).cast("long")).alias("n_spans"),
        either(nothing, "kept_sha256", F.col("whole")).alias("kept_sha256"),
    )
