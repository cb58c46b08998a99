"""Language identification by bit-sliced Bloom filters over n-grams.

One filter serves all languages: a cell holds a bit per language, and the cells of an n-gram,
and-ed, are the set of all languages that have it. A text's languages are then counted bit by bit;
each count is corrected for the false positives that the filter's fill lets expect, and the
language of the largest corrected count wins.

N-grams are four bytes of the UTF-8 text in which A-Z are lowered and all ASCII but letters is a
space. A language has an n-gram if its rate there is at least a tenth of the highest rate in
any language: a few quoted or mislabelled texts do not put n-grams into a language.

Counts are made in tasks, summed by a shuffle of distinct n-grams, and or-ed into cells by
another. The filter holds all of them: it grows with the n-grams of the richest language, so that at most half of
its bits are set. What a process holds is bounded all the same: a filter of more than ``MOST_CELLS`` is made, sent and
looked up in parts, to which its n-grams are dealt by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import held_out_part, shared, ship, training_part, written
from marquee.llm.text import filled, mix, slices

# Cells of 8 bytes for each 64 languages: at least, and at most in a part (all planes together); hash functions;
# cells for each n-gram of a language, by which half of its bits are set.
CELLS = 1 << 20
MOST_CELLS = 1 << 24
HASHES = 3
CELLS_PER_GRAM = 4
SHARE = 0.1
UNKNOWN = "und"

_SPACES = 0x20202020
# letters lowered, other ASCII a space, all else as it is
_BYTES = np.array(
    [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], dtype=np.uint8
)
# distinct n-grams a counting task holds before it passes them on
_HELD = 1 << 21


# N-grams that a task works on at once, also of one long text.
BLOCK = 1 << 20
# Text for which a task reads the parts of a filter that is in several.
PARTS_SLICE = 1 << 24


def ngram_blocks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, slice]]:
    """The n-gram that begins at each byte of the texts, a block at a time: the n-grams, where in the block
    each text begins, and which texts these are. A text that began earlier begins at 0.

    Three spaces go before every text and after the last, so no n-gram reaches across texts and
    even a text of one letter has some.
    """
    if not len(texts):
        return
    framed = pc.binary_join_element_wise(pa.scalar("   "), texts, pa.scalar(""))
    starts = np.frombuffer(framed.buffers()[1], dtype=np.int32)[: len(framed) + 1].astype(np.int64)
    data = np.frombuffer(framed.buffers()[2], dtype=np.uint8)[: starts[-1]]
    for low in range(0, len(data), BLOCK):
        high = min(low + BLOCK, len(data))
        plain = np.full(high - low + 3, 32, dtype=np.uint8)
        own = _BYTES[data[low : high + 3]]
        plain[: len(own)] = own
        grams = plain[3:].astype(np.uint32)
        for step in range(3):
            grams |= plain[step : step + high - low].astype(np.uint32) << np.uint32(24 - 8 * step)
        first = int(np.searchsorted(starts, low, side="right")) - 1
        last = int(np.searchsorted(starts, high, side="left"))
        yield grams, np.maximum(starts[first:last] - low, 0), slice(first, last)


def _counted(grams: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        grams = np.sort(grams)
        first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else grams.astype(int)
        return grams[first], np.diff(np.append(first, len(grams))).astype(np.int64)
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    return grams[first], np.add.reduceat(counts, first)


def ngram_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``gram`` and ``n`` over all texts with a language."""
    ship(docs.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                grams, counts = _counted(*(np.concatenate(x) for x in zip(*parts)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]).take(pa.array(np.zeros(len(grams), dtype=np.int32))),
                     pa.array(grams.astype(np.int64)), pa.array(counts)], schema=schema
                )

        for batch in batches:
            for piece in slices(batch, size=BLOCK):
                langs = piece.column("lang")
                for lang in pc.unique(langs).to_pylist():
                    for grams, _, _ in ngram_blocks(piece.column("text").filter(pc.equal(langs, lang))):
                        held.setdefault(lang, []).append(_counted(grams[grams != _SPACES]))
                        size += len(held[lang][-1][0])
                if size > _HELD:
                    held = {k: [_counted(*(np.concatenate(x) for x in zip(*v)))] for k, v in held.items()}
                    size = sum(len(v[0][0]) for v in held.values())
                    if size > _HELD // 2:
                        yield from passed_on()
                        held, size = {}, 0
        yield from passed_on()

    usable = docs.filter("text is not null and lang is not null").select("text", "lang")
    counted = usable.mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class LanguageFilter:
    """In a part, ``cells[plane, position]`` has bit ``i % 64`` of plane ``i // 64`` for language ``i``. One part is an
    array here and broadcast in tasks; several are broadcast, and no process holds more than one of them."""

    languages: list[str]
    parts: Sequence[np.ndarray | Broadcast]
    false_positives: np.ndarray

    @property
    def cells(self) -> np.ndarray:
        """Those of the first part."""
        return self.cells_of(0)

    def cells_of(self, part: int) -> np.ndarray:
        held = self.parts[part]
        if isinstance(held, np.ndarray):
            return held
        cells = held.value
        if len(self.parts) > 1 and getattr(held, "_path", None):
            vars(held).pop("_value", None)  # kept as long as the process lives, though its file can be read again
        return cells

    def identify(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language per text, and the corrected share of its n-grams that are that
        language's. Ties go to the language with more training text."""
        count = len(self.languages)
        found = np.zeros((count, len(texts)), dtype=np.int64)
        total = np.zeros(len(texts), dtype=np.int64)
        for part in range(len(self.parts)):
            self._count(part, texts, found, total)
        best, share = np.zeros(len(texts), dtype=np.int64), np.full(len(texts), -1.0)
        for k, false in enumerate(self.false_positives):
            corrected = (found[k] / np.maximum(total, 1) - false) / max(1 - false, 1e-9)
            better = corrected > share
            best[better], share[better] = k, corrected[better]
        return best, np.clip(share, 0.0, 1.0)

    def _count(self, part: int, texts: pa.Array, found: np.ndarray, total: np.ndarray) -> None:
        """Add the n-grams of a part: by language those that it has, and all."""
        whole, alone = self.cells_of(part), len(self.parts) == 1
        for grams, starts, own in ngram_blocks(texts):
            mine = grams != _SPACES
            if not alone:
                mine &= part_of(grams, len(self.parts)) == part
            total[own] += np.add.reduceat(mine, starts, dtype=np.int64)
            picked = grams if alone else grams[mine]  # nearly all are of a part that is alone
            places = [positions(picked, k, whole.shape[1]) for k in range(HASHES)]
            for plane, cells in enumerate(whole):
                sets = cells[places[0]]
                for place in places[1:]:
                    sets &= cells[place]
                if alone:
                    sets[~mine] = 0
                else:
                    seen, sets = sets, np.zeros(len(grams), dtype=np.uint64)
                    sets[mine] = seen
                for bit in range(min(64, len(found) - 64 * plane)):
                    has = (sets >> np.uint64(bit)).astype(np.uint8) & 1
                    found[64 * plane + bit, own] += np.add.reduceat(has, starts, dtype=np.int64)


def positions(grams: np.ndarray, which: int, cells: int = CELLS) -> np.ndarray:
    """Cells of n-grams under one of the hash functions; ``cells`` is a power of two."""
    seed = np.uint64(0x9E3779B97F4A7C15 * (which + 1) % 2**64)
    return (mix(grams.astype(np.uint64) + seed) >> np.uint64(24)).astype(np.uint32) & np.uint32(cells - 1)


def part_of(grams: np.ndarray, parts: int) -> np.ndarray:
    """The part of the filter that an n-gram is in; ``parts`` is a power of two."""
    return positions(grams, HASHES, parts)


def _parts_and_size(bits: DataFrame, planes: int) -> tuple[int, int]:
    """How many parts the filter has, and the cells of each. A row per language comes to the driver."""
    grams = [row["count"] for row in bits.groupBy("number").count().collect()]
    wanted = size = max(CELLS, 1 << (CELLS_PER_GRAM * max(grams, default=1) - 1).bit_length())
    while size * planes > max(MOST_CELLS, CELLS * planes):
        size //= 2
    return wanted // size, size


def _fill(cells: np.ndarray, languages: int) -> np.ndarray:
    """The share of its bits that each language has set, counted a block at a time."""
    found = np.zeros(languages)
    for number in range(languages):
        own, bit = cells[number // 64], np.uint64(1 << number % 64)
        found[number] = sum(np.count_nonzero(own[at : at + BLOCK] & bit) for at in range(0, len(own), BLOCK))
    return found / cells.shape[1]


def learn_filter(docs: DataFrame, share: float = SHARE) -> LanguageFilter:
    """Learn from all texts with a language. Collects a row per language and, a part of the filter at a time, at most
    one per cell."""
    counts = written(ngram_counts(docs), "ngrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rows = sorted(totals.collect(), key=lambda row: (-row["total"], row["lang"]))
    languages = [row["lang"] for row in rows]
    planes = max(1, -(-len(languages) // 64))
    if not languages:
        return LanguageFilter([], [np.zeros((planes, CELLS), dtype=np.uint64)], np.zeros(0))
    known = counts.sparkSession.createDataFrame(
        [(row["lang"], i, row["total"]) for i, row in enumerate(rows)], "lang string, number int, total long"
    )
    rated = counts.join(known, "lang").withColumn("rate", F.col("n") / F.col("total"))
    top = F.max("rate").over(Window.partitionBy("gram"))  # a row per language at most
    bits = written(
        rated.withColumn("top", top)
        .filter(F.col("rate") >= share * F.col("top"))
        .select(
            "gram",
            "number",
            F.floor(F.col("number") / 64).cast("int").alias("plane"),
            F.expr("number % 64").alias("bit"),
        ),
        "bits",
    )
    count, size = _parts_and_size(bits, planes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("gram").to_numpy().astype(np.uint64)
            bit = np.uint64(1) << batch.column("bit").to_numpy().astype(np.uint64)
            part = pa.array(part_of(grams, count).astype(np.int32))
            for which in range(HASHES):
                yield pa.RecordBatch.from_arrays(
                    [part, batch.column("plane"), pa.array(positions(grams, which, size).astype(np.int64)),
                     pa.array(bit.view(np.int64))],
                    names=["part", "plane", "cell", "bits"],
                )

    placed = bits.mapInArrow(place, "part int, plane int, cell long, bits long")
    filled_cells = placed.groupBy("part", "plane", "cell").agg(F.bit_or("bits").alias("bits"))
    if count > 1:
        filled_cells = written(filled_cells, "cells")
    parts: list[np.ndarray | Broadcast] = []
    false_positives = np.zeros(len(languages))
    for part in range(count):
        cells = np.zeros((planes, size), dtype=np.uint64)
        for batch in filled_cells.filter(F.col("part") == part).drop("part").toArrow().to_batches():
            plane, cell, value = (batch.column(k).to_numpy() for k in range(3))
            cells[plane, cell] = value.view(np.uint64)
        # an n-gram is as likely in any part
        false_positives += _fill(cells, len(languages)) ** HASHES / count
        parts.append(shared(counts.sparkSession, cells) if count > 1 else cells)
    return LanguageFilter(languages, parts, false_positives)


def identify_languages(
    docs: DataFrame,
    model: LanguageFilter,
    keep: Sequence[str] = ("doc_id",),
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The columns ``keep`` with language and score under ``names``.

    Only the text is used. Other columns are ignored, kept ones of these names give way. The score is the share of the text's n-grams that the language has,
    corrected for false positives. A null text and one without a letter is ``und`` with score 0, and
    so is every text if nothing was learnt; repeated rows get equal results. Long texts are counted whole, a block
    of their n-grams at a time. A filter in parts is read from the executor's disk, part by part, for each 16 MB of text.
    """
    keep = [column for column in keep if column not in names]
    ship(docs.sparkSession)
    languages, false_positives = model.languages, model.false_positives
    # each at most MOST_CELLS * 8 bytes for 64 languages
    sent = [shared(docs.sparkSession, x) if isinstance(x, np.ndarray) else x for x in model.parts]
    size = BLOCK if len(sent) == 1 else PARTS_SLICE
    frame = docs.select(*keep, *([] if "text" in keep else ["text"]))

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = LanguageFilter(languages, sent, false_positives)
        values = pa.array([*learnt.languages, UNKNOWN])
        for batch in batches:
            for piece in slices(batch, size=size):
                texts = filled(piece.column("text"))
                lettered = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)
                if learnt.languages:
                    best, share = learnt.identify(texts)
                else:
                    best, share = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
                best[~lettered], share[~lettered] = len(learnt.languages), 0.0
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(name) for name in keep), values.take(pa.array(best)), pa.array(share)],
                    names=[*keep, *names],
                )

    schema = frame.select(*keep).schema.add(names[0], "string").add(names[1], "double")
    return frame.mapInArrow(identify, schema)


def language_id(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` for every document."""
    model = learn_filter(docs.filter(training_part("doc_id", 4, 2)))
    return identify_languages(docs, model).select(
        "doc_id", held_out_part("doc_id", 4, 2).alias("held_out"), "lang_pred", "score"
    )
