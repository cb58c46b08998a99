"""Texts of an Arrow batch as one run of bytes, and the words in it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from marquee.llm.text import filled

# A-Z to a-z, all other bytes as they are; bytes of longer UTF-8 characters are 128 and more
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins (and the last ends).
    Null texts are empty."""
    texts = filled(texts)
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    buffers = texts.buffers()
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(buffers[1], dtype=width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if buffers[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class WordTable:
    """Words in order: ``codes`` into ``vocabulary``, the byte each starts at, and its text."""

    codes: np.ndarray
    vocabulary: pa.Array
    starts: np.ndarray
    texts: np.ndarray


def word_table(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> WordTable:
    """Maximal runs of bytes that are not separators (a flag per byte value); none crosses texts."""
    letter = ~separator[data]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = letter[edges]
    starts = np.flatnonzero(begins)
    packed = data[letter]
    places = np.append(np.cumsum(letter, dtype=np.int32)[starts] - 1, len(packed)).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(packed)])
    coded = words.dictionary_encode()
    return WordTable(
        coded.indices.to_numpy(zero_copy_only=False),
        coded.dictionary,
        starts,
        np.searchsorted(offsets, starts, side="right") - 1,
    )


def flags(values: bytes) -> np.ndarray:
    """True at each of the byte values."""
    table = np.zeros(256, dtype=bool)
    table[list(values)] = True
    return table
