"""An exact finder of benchmark passages, to hold the operator against: no passage is missed.

Items and texts are sequences of words. An item within which ``d`` edits are allowed is cut into
``d + 1`` pieces of five words at most: wherever the edits are, one piece has none, and stands in
the text at most ``d`` words from its place in the passage. So the texts' runs of words are looked up
among the pieces, and no passage within the distance is missed. What a piece names is confirmed by
the exact edit distance between the item and any part of the text that begins near by.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from marquee.llm.decontamination import EDITS, RARE, edit_distance, least_start
from marquee.llm.text import Words, hash_words, lower_ascii, mix, ragged

# Candidates that are checked at once, which bounds a task's memory, not the result.
CANDIDATES = 1 << 20


@dataclass
class Pieces:
    """Pieces of equal length, sorted by key: the item of each, and where in the item it begins."""

    keys: np.ndarray
    items: np.ndarray
    places: np.ndarray


@dataclass
class Index:
    items: list[tuple[int, np.ndarray]]  # item id and word hashes
    sets: list[set[int]]  # the distinct words of each
    sizes: np.ndarray  # its words
    edits: np.ndarray  # the edits allowed
    least_rare: np.ndarray  # rare words that a passage within them has at least
    vocabulary: np.ndarray
    rare: np.ndarray
    pieces: dict[int, Pieces]  # by their length


def run_keys(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A key per run of so many words from each start on."""
    key = np.full(len(starts), length, dtype=np.uint64)
    for step in range(length):
        key = mix(key * np.uint64(31) + words[starts + step])
    return key


def build_index(items: list[tuple[int, str]], shortest: int = 1) -> Index:
    """Items of ``shortest`` words at least, and their pieces."""
    words = Words(lower_ascii(pa.array([text for _, text in items], pa.string())))
    hashes = hash_words(words.vocabulary)[words.codes] if len(words.codes) else np.zeros(0, dtype=np.uint64)
    bounds = list(zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()))
    kept = [(item, hashes[a:b], a) for (item, _), (a, b) in zip(items, bounds) if b - a >= max(shortest, 1)]
    owned = [own for _, own, _ in kept]
    each = np.concatenate([np.unique(own) for own in owned]) if kept else hashes[:0]
    vocabulary, items_with = np.unique(each, return_counts=True)
    rare = vocabulary[items_with <= RARE]
    sizes = np.array([len(own) for own in owned], dtype=np.int64)
    edits = (EDITS * sizes).astype(np.int64)
    owner = np.repeat(np.arange(len(kept)), edits + 1)
    number = ragged(np.zeros(len(kept), dtype=np.int64), edits + 1)
    place = number * sizes[owner] // (edits[owner] + 1)
    length = (number + 1) * sizes[owner] // (edits[owner] + 1) - place
    begin = np.array([a for _, _, a in kept], dtype=np.int64)[owner] + place
    pieces = {}
    for size in np.unique(length).tolist():
        own = np.flatnonzero(length == size)
        keys = run_keys(hashes, begin[own], size)
        order = np.argsort(keys, kind="stable")
        pieces[size] = Pieces(keys[order], owner[own][order], place[own][order])
    least_rare = np.array([np.isin(own, rare).sum() for own in owned], dtype=np.int64) - edits
    return Index(
        [(item, own) for item, own, _ in kept],
        [set(own.tolist()) for own in owned],
        sizes,
        edits,
        least_rare,
        vocabulary,
        rare,
        pieces,
    )


def find_passages(index: Index, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    """Text, item, least distance, first word and number of words of the best match per pair."""
    words = Words(lower_ascii(texts))
    known = hash_words(words.vocabulary)
    hashes = known[words.codes] if len(words.codes) else np.zeros(0, dtype=np.uint64)

    def running(some: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(np.isin(known, some)[words.codes])]) if len(hashes) else np.zeros(1)

    covered, rare = running(index.vocabulary), running(index.rare)
    text_of = np.repeat(np.arange(len(texts)), np.diff(words.offsets))
    ends = words.offsets[1:][text_of]
    met: list[np.ndarray] = [np.zeros((0, 3), dtype=np.int64)]
    for length, pieces in index.pieces.items():
        at = np.arange(len(hashes) - length + 1)
        at = at[(at + length <= ends[at]) & (covered[at + length] - covered[at] == length)]
        key = run_keys(hashes, at, length)
        low = np.searchsorted(pieces.keys, key, side="left")
        many = np.searchsorted(pieces.keys, key, side="right") - low
        at, low, many = at[many > 0], low[many > 0], many[many > 0]
        done = np.cumsum(many)
        first = 0
        while first < len(at):
            before = done[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(done, before + CANDIDATES, side="right")))
            named = ragged(low[first:stop], many[first:stop])
            near = np.repeat(at[first:stop], many[first:stop])
            met.append(_possible(index, words.offsets, covered, rare, text_of, near, pieces, named))
            first = stop
    pairs = np.unique(np.concatenate(met), axis=0)
    borders = np.flatnonzero(np.any(np.diff(pairs[:, :2], axis=0), axis=1)) + 1
    for group in np.split(pairs, borders) if len(pairs) else []:
        text, item = int(group[0, 0]), int(group[0, 1])
        name, own = index.items[item]
        most, first, end = int(index.edits[item]), int(words.offsets[text]), int(words.offsets[text + 1])
        found = None
        # a passage begins within ``most`` words of where a piece says; what overlaps is read once
        breaks = np.flatnonzero(np.diff(group[:, 2]) > 2 * most + 1) + 1
        for starts in np.split(group[:, 2], breaks):
            low, high = max(first, int(starts[0]) - most), int(starts[-1]) + len(own) + 2 * most
            reach = hashes[low : min(high, end)]
            if sum(word in index.sets[item] for word in reach.tolist()) < len(own) - most:
                continue
            distance, start = least_start(own, reach)
            if distance <= most and (found is None or distance < found[0]):
                found = distance, low + start
                if not distance:
                    break
        if found:
            distance, start = found
            length = edit_distance(own, hashes[start : min(start + len(own) + most, end)])[1]
            yield text, name, distance, start - first, length


def _possible(index, offsets, covered, rare, text_of, near, pieces, named) -> np.ndarray:
    """Text, item and supposed first word of the candidates with words enough around them; ``near``
    is where in the texts the piece ``named`` was met."""
    item, text = pieces.items[named], text_of[near]
    begin, edits = near - pieces.places[named], index.edits[item]
    low = np.maximum(begin - edits, offsets[text])
    high = np.minimum(begin + index.sizes[item] + edits, offsets[text + 1])
    enough = covered[high] - covered[low] >= index.sizes[item] - edits
    enough &= rare[high] - rare[low] >= index.least_rare[item]
    return np.unique(np.stack([text[enough], item[enough], begin[enough]], axis=1), axis=0)
