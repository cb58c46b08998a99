"""Benchmark passages in documents: edit distance by random-walk embedding and bit-sampling.

Items and texts are sequences of words. The CGK embedding walks along a sequence, three steps per word: each step
writes the current word and moves on or stays as a random bit of walk, step and word says. After an edit two
walks soon fall into step again, so a small edit distance becomes a small Hamming distance between what
they write. Bit-sampling hashes a few neighbouring places of the embedding, in every stretch of ``SPAN``
steps of an item's walks, so that no part of an item has to be free of edits: walks go forward from its head
and backward from its end, and are repeated until an item and a passage within the distance, edited to the full
bound and in the worst way, share a bucket with ``RECALL`` (the tests measure that against an exact
finder). The first walk samples its first steps, which an exact copy never fails.

Windows of an item's size begin and end at every word of a text, and each has its walks. The random bits
take turns every ``SPAN`` steps, so what a window's walk writes in a stretch depends only on the word at which
it begins the stretch. So buckets are looked up once per word, for all windows whose walks come by, and
a word whose bucket an item shares, at some place of its own, names the window that has the item's place there.
What a bucket brings together is confirmed by the exact edit distance between the item and any part
of the text near by.

A passage can only be within ``d`` edits of an item of ``n`` words if at least ``n - d`` words
around it are words of the benchmark, and as many of its rare words (found in few items) as it has,
less ``d``. Windows that fail these counts are skipped, which loses nothing. Items are embedded in
tasks, and their buckets go to the tasks that hold documents in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import shared, ship, written
from marquee.llm.text import Words, filled, hash_words, lower_ascii, mix, ragged, slices

# Edits per item, as a share of its words, rounded down.
EDITS = 0.2
# The recall that the walks are for, and the walks of either direction.
RECALL = 0.98
WALKS = 4
# Steps of a stretch, and the steps that each walk samples of it.
SPAN = 6
STEPS = 3
# A word in at most so many items is rare.
RARE = 2
# Items and bytes of text in a block, which a task holds as a whole.
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20

# Words of candidates that are looked at at once: this bounds a task's memory, not the result.
CHECKED = 1 << 20

_KEY = np.dtype([("walk", "u1"), ("place", "<i4"), ("key", "<u8")])


@dataclass(frozen=True)
class Walk:
    """A walk by its number, the steps of a stretch that are sampled, and whether it starts at the head."""

    number: int
    sampled: tuple[int, ...]
    forward: bool

    def bits(self, step: int, words: np.ndarray) -> np.ndarray:
        """Whether the walk moves on in a step of a stretch, for each of some word hashes."""
        seed = np.uint64((self.number * 1_000_003 + step + 1) * 0x9E3779B97F4A7C15 % 2**64)
        return (mix(words ^ seed) & np.uint64(1)).astype(np.int64)


def walks() -> list[Walk]:
    """All walks. The last two are for items of one and two words, whose three first steps lead out of them."""
    rng = np.random.default_rng(4)
    made = []
    for forward in (True, False):
        for number in range(WALKS):
            later = range(1, 3) if not number else sorted(rng.choice(np.arange(1, SPAN), 2, replace=False).tolist())
            made.append(Walk(len(made), (0, *later), forward))
    return [*made, Walk(len(made), (0,), True), Walk(len(made) + 1, (0, 1), True)]


def _walks_of(size: int) -> list[Walk]:
    return walks()[:-2] if size > 2 else [walks()[size - 3]]


def embed_item(words: np.ndarray) -> np.ndarray:
    """Walk, place in the item and key of every sampled stretch that lies inside the item. Backward
    walks count places from the end.

    Where a walk stayed so much that it sampled a single word, which texts are full of, there is no key,
    unless the item had none at all.
    """
    found, single = [], []
    for walk in _walks_of(len(words)):
        own = words if walk.forward else words[::-1]
        moves = [walk.bits(step, own).tolist() for step in range(SPAN)]
        place = 0
        for _ in range(-(-STEPS * len(own) // SPAN)):
            begin, read = place, []
            for step in range(SPAN):
                if place < len(own):
                    if step in walk.sampled:
                        read.append(place)
                    place += moves[step][place]
            # a word that no step leaves would hold the walk to its end
            place += place == begin
            if len(read) == len(walk.sampled):
                kept = found if read[0] < read[-1] else single
                kept.append((walk.number, begin, _key(walk, own[read])))
            if place >= len(own):
                break
    return np.array(found or single, dtype=_KEY)


def _key(walk: Walk, read: np.ndarray) -> np.uint64:
    key = np.uint64(walk.number + 1)
    for word in read:
        key = mix(np.atleast_1d(key * np.uint64(31) + word))
    return key[0]


def met_places(
    walk: Walk, codes: np.ndarray, known: np.ndarray, wanted: np.ndarray, at: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The places, of ``at``, whose stretch has all that is sampled in the benchmark's words, and their keys.

    ``codes`` tell the word of each place, ``known`` the hash of each word and ``wanted`` whether it is in
    the benchmark; the last word stands for what lies beyond either end.
    """
    place, turn = at, 1 if walk.forward else -1
    key = np.full(len(at), walk.number + 1, dtype=np.uint64)
    for step in range(walk.sampled[-1] + 1):
        word = codes[place]
        if step in walk.sampled:
            if step:
                inside = wanted[word]
                at, place, word, key = at[inside], place[inside], word[inside], key[inside]
            key = mix(key * np.uint64(31) + known[word])
        if step < walk.sampled[-1]:
            place = place + turn * walk.bits(step, known)[word]
    return at, key


@dataclass
class Buckets:
    """Keys of a walk, sorted, and of each the item and the place in it; and which low bits of keys occur."""

    keys: np.ndarray
    items: np.ndarray
    places: np.ndarray
    low_bits: np.ndarray

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``keys`` and bucket entries that are equal."""
        row = np.flatnonzero(self.low_bits[(keys & np.uint64(len(self.low_bits) - 1)).astype(np.int64)])
        first = np.searchsorted(self.keys, keys[row], side="left")
        many = np.searchsorted(self.keys, keys[row], side="right") - first
        return np.repeat(row, many), ragged(first, many)


@dataclass
class Index:
    items: list[tuple[int, np.ndarray]]  # item id and word hashes
    held: np.ndarray  # a bit for each hash of an item and a word of it
    sizes: np.ndarray  # its words
    edits: np.ndarray  # the edits allowed
    least_rare: np.ndarray  # rare words that a passage within them has at least
    vocabulary: np.ndarray
    rare: np.ndarray
    buckets: dict[int, Buckets]  # by walk


def embed_items(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per text with a word: its row, its word hashes, and its keys."""
    words = Words(lower_ascii(texts))
    hashes = hash_words(words.vocabulary)[words.codes] if len(words.codes) else np.zeros(0, dtype=np.uint64)
    for row, (begin, end) in enumerate(zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist())):
        if end > begin:
            yield row, hashes[begin:end], embed_item(hashes[begin:end])


def _pair_places(items: np.ndarray, words: np.ndarray, size: int) -> np.ndarray:
    """Where a pair of item and word has its bit."""
    pair = mix(words ^ (items.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    return (pair & np.uint64(size - 1)).astype(np.int64)


def _held(owned: list[np.ndarray]) -> np.ndarray:
    """Which words items have, by hash: what is not set is not there."""
    total = sum(len(own) for own in owned)
    held = np.zeros(1 << max(10, (16 * total).bit_length()), dtype=bool)
    for item, own in enumerate(owned):
        held[_pair_places(np.full(len(own), item), own, len(held))] = True
    return held


def build_index(embedded: list[tuple[int, np.ndarray, np.ndarray]]) -> Index:
    """The buckets of items, each given by its id, word hashes and keys."""
    kept = sorted(embedded, key=lambda item: (len(item[1]), item[0], item[1].tobytes()))
    owned = [own for _, own, _ in kept]
    each = np.concatenate([np.unique(own) for own in owned]) if kept else np.zeros(0, dtype=np.uint64)
    vocabulary, items_with = np.unique(each, return_counts=True)
    rare = vocabulary[items_with <= RARE]
    sizes = np.array([len(own) for own in owned], dtype=np.int64)
    edits = (EDITS * sizes).astype(np.int64)
    least_rare = np.array([np.isin(own, rare).sum() for own in owned], dtype=np.int64) - edits
    keys = np.concatenate([own for _, _, own in kept]) if kept else np.zeros(0, dtype=_KEY)
    owners = np.repeat(np.arange(len(kept)), [len(own) for _, _, own in kept]).astype(np.int64)
    buckets = {}
    for number in np.unique(keys["walk"]).tolist():
        own = np.flatnonzero(keys["walk"] == number)
        own = own[np.argsort(keys["key"][own], kind="stable")]
        flat = keys["key"][own]
        low_bits = np.zeros(1 << max(10, (16 * len(flat)).bit_length()), dtype=bool)
        low_bits[(flat & np.uint64(len(low_bits) - 1)).astype(np.int64)] = True
        buckets[number] = Buckets(flat, owners[own], keys["place"][own].astype(np.int64), low_bits)
    return Index(
        [(item, own) for item, own, _ in kept],
        _held(owned),
        sizes,
        edits,
        least_rare,
        vocabulary,
        rare,
        buckets,
    )


def _column(item: np.ndarray, words: np.ndarray, anywhere: bool) -> Iterator[int]:
    """After each word the least edits between the item and the words up to there: all of them, or
    if ``anywhere`` those from any word on. Bit-parallel dynamic programming, a column per word."""
    size = len(item)
    masks: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        masks[word] = masks.get(word, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score, first = full, 0, size, int(not anywhere)
    for word in words.tolist():
        equal = masks.get(word, 0)
        across = equal | down
        diagonal = (((equal & up) + up) ^ up) | equal
        more = down | (full & ~(diagonal | up))
        less = up & diagonal
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        more = (more << 1 | first) & full
        less = less << 1 & full
        up = less | (full & ~(across | more))
        down = more & across
        yield score


def edit_distance(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Least edits of words from the item to a prefix of ``words``, and that prefix's length.

    Of equal distances the longest prefix not longer than the item, else the shortest, is taken.
    """
    best, length = len(item), 0
    for j, score in enumerate(_column(item, words, anywhere=False), 1):
        if score < best or (score == best and j <= len(item)):
            best, length = score, j
    return best, length


def least_start(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Least edits between the item and any part of the words, and the first word such a part
    begins at."""
    scores = list(_column(item[::-1], words[::-1], anywhere=True))[::-1]
    start = int(np.argmin(scores))
    return scores[start], start


def find_passages(index: Index, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Text, item, least distance, first word and number of words of the best match per pair that shares a
    bucket, and the item's number of words."""
    words = Words(lower_ascii(texts))
    known = np.append(hash_words(words.vocabulary), np.uint64(0))
    wanted = np.append(np.isin(known[:-1], index.vocabulary), False)
    hashes = known[words.codes] if len(words.codes) else np.zeros(0, dtype=np.uint64)

    def running(flags: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(flags[words.codes])]) if len(hashes) else np.zeros(1)

    covered, rare = running(wanted), running(np.isin(known, index.rare))
    text_of = np.repeat(np.arange(len(texts)), np.diff(words.offsets))
    # beyond either end is a word that no item has; a walk stays where it is, or reads into the next text
    beyond = np.full(SPAN, len(known) - 1)
    codes = np.concatenate([beyond, words.codes, beyond]).astype(np.int64)
    at = np.flatnonzero(wanted[codes])
    met: list[np.ndarray] = [np.zeros(0, dtype=np.int64)]
    span = len(hashes) + 1
    for walk in walks():
        if walk.number not in index.buckets or not len(at):
            continue
        buckets = index.buckets[walk.number]
        place, key = met_places(walk, codes, known, wanted, at)
        row, entry = buckets.find(key)
        near, item = place[row] - SPAN, buckets.items[entry]
        begin = near - buckets.places[entry]
        if not walk.forward:
            begin = near + buckets.places[entry] + 1 - index.sizes[item]
        # a window that would begin before its text begins with it
        begin = np.maximum(begin, words.offsets[text_of[near]])
        low, high = _around(index, words.offsets, text_of, begin, item)
        least = index.sizes[item] - index.edits[item]
        enough = (covered[high] - covered[low] >= least) & (rare[high] - rare[low] >= index.least_rare[item])
        met.append(np.unique(item[enough] * span + begin[enough]))
    item, begin = np.divmod(np.unique(np.concatenate(met)), span)
    enough = _own_words(index, hashes, item, *_around(index, words.offsets, text_of, begin, item))
    enough = enough >= index.sizes[item] - index.edits[item]
    item, begin = item[enough], begin[enough]
    text = text_of[begin]
    borders = np.flatnonzero((np.diff(item) != 0) | (np.diff(text) != 0)) + 1
    for group in np.split(np.arange(len(item)), borders) if len(item) else []:
        number = int(item[group[0]])
        name, own = index.items[number]
        within, most = int(text[group[0]]), int(index.edits[number])
        first, end = int(words.offsets[within]), int(words.offsets[within + 1])
        found = None
        # a passage begins within ``most`` words of where a window says; what overlaps is read once
        breaks = np.flatnonzero(np.diff(begin[group]) > 2 * most + 1) + 1
        for starts in np.split(begin[group], breaks):
            low, high = max(first, int(starts[0]) - most), int(starts[-1]) + len(own) + 2 * most
            distance, start = least_start(own, hashes[low : min(high, end)])
            if distance <= most and (found is None or distance < found[0]):
                found = distance, low + start
                if not distance:
                    break
        if found:
            distance, start = found
            length = edit_distance(own, hashes[start : min(start + len(own) + most, end)])[1]
            yield within, name, distance, start - first, length, len(own)


def _around(index, offsets, text_of, begin, item) -> tuple[np.ndarray, np.ndarray]:
    """The words among which a passage of the item lies, if it begins about there."""
    edits, text = index.edits[item], text_of[begin]
    low = np.maximum(begin - edits, offsets[text])
    return low, np.minimum(begin + index.sizes[item] + 2 * edits, offsets[text + 1])


def _own_words(index, hashes, item, low, high) -> np.ndarray:
    """How many words from ``low`` to ``high`` are, but for chance equality of hashes, words of the item."""
    count = np.zeros(len(item), dtype=np.int64)
    done = np.concatenate([[0], np.cumsum(high - low)])
    first = 0
    while first < len(item):
        stop = max(first + 1, int(np.searchsorted(done, done[first] + CHECKED, side="right")) - 1)
        lengths = (high - low)[first:stop]
        own = np.repeat(item[first:stop], lengths)
        words = hashes[ragged(low[first:stop], lengths)]
        hit = index.held[_pair_places(own, words, len(index.held))]
        # every window has a word at least
        count[first:stop] = np.add.reduceat(hit, np.cumsum(lengths) - lengths, dtype=np.int64)
        first = stop
    return count


def embedded_items(benchmark: DataFrame) -> DataFrame:
    """``item_id`` (null as -1), ``words`` and ``keys`` of the distinct items with a word, in bytes."""
    names = ["item_id", "words", "keys"]

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, size=1 << 20):
                rows = list(embed_items(piece.column("text")))
                if rows:
                    row, own, keys = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("item_id").take(pa.array(row)),
                         *(pa.array([x.tobytes() for x in part], pa.binary()) for part in (own, keys))], names=names
                    )

    item_id = F.coalesce(F.col("item_id").cast("long"), F.lit(-1).cast("long")).alias("item_id")
    items = benchmark.select(item_id, "text").filter("text is not null").distinct()
    return items.mapInArrow(embed, "item_id long, words binary, keys binary")


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """The embedded items in blocks of bounded size."""
    items = written(embedded_items(benchmark), "items")
    count, size = items.agg(F.count("*"), F.sum(F.octet_length("words"))).first()
    blocks = max(1, -(-count // BLOCK_ITEMS), -(-(size or 0) // BLOCK_BYTES))
    spread = F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks))
    for block in range(blocks):
        rows = items.filter(spread == block).collect()
        yield [
            (row.item_id, np.frombuffer(row.words, dtype=np.uint64), np.frombuffer(row["keys"], dtype=_KEY))
            for row in rows
        ]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows ``doc_id``, ``item_id``, ``distance``, ``first_word``, ``n_words``, ``item_words``: the best place
    found of each benchmark item in each document that holds it, within ``EDITS`` of its words.

    Words are runs of anything but ASCII white space, with A-Z lowered. Items of any length are matched, those of
    fewer than five words as they are, without edits; null and empty texts match nothing. Exact copies are always
    found, edited ones with ``RECALL``. A null item id is given as -1;
    repeated rows are matched each and reported once per ``doc_id`` and item. Long texts are matched as a whole,
    some 60 bytes in memory for each of their bytes. Other columns are
    ignored. An empty table on either side gives no rows.
    """
    ship(docs.sparkSession)
    found = None
    for block in _blocks(benchmark):
        part = _matched(docs, shared(docs.sparkSession, build_index(block)))  # one bounded block
        found = part if found is None else found.unionByName(part)
    least = F.struct("distance", "first_word", "n_words", "item_words")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.min(least).alias("least"))
        .select("doc_id", "item_id", "least.*")
    )


def _matched(docs: DataFrame, index) -> DataFrame:
    names = ["doc_id", "item_id", "distance", "first_word", "n_words", "item_words"]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, size=2 << 20):
                rows = list(find_passages(index.value, filled(piece.column("text"))))
                if rows:
                    text, *rest = (np.array(x, dtype=np.int64) for x in zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("doc_id").take(pa.array(text)), *map(pa.array, rest)], names=names
                    )

    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return frame.mapInArrow(match, ", ".join(f"{name} long" for name in names))
