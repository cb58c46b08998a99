"""Arrow and numpy helpers for texts inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in slices of about so many bytes: this bounds a task's memory, not the result.
SLICE_BYTES = 6 << 20


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of about ``size`` text bytes, one row at least; texts stay whole."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def filled(texts: pa.Array) -> pa.Array:
    """Null texts as empty ones."""
    return pc.fill_null(texts, "")


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some texts: ``codes`` into ``vocabulary``; the words of
    text ``i`` are ``codes[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(texts)
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.dictionary_encode(split.flatten())
        codes = coded.indices.to_numpy(zero_copy_only=False)
        self.vocabulary: pa.Array = coded.dictionary
        # white space at either end gives an empty word
        empty = pc.index(self.vocabulary, "").as_py() if len(self.vocabulary) else -1
        if empty >= 0:
            real = codes != empty
            rows = np.repeat(np.arange(len(texts)), counts)[real]
            counts, codes = np.bincount(rows, minlength=len(texts)), codes[real]
        self.codes = codes
        self.offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def lower_ascii(texts: pa.Array) -> pa.Array:
    """A-Z lowered; no other letter changes."""
    return pc.ascii_lower(texts)


def hash_words(vocabulary: pa.Array) -> np.ndarray:
    """A 64-bit hash per word, equal on every machine."""
    if not len(vocabulary):
        return np.zeros(0, dtype=np.uint64)
    return pd.util.hash_array(vocabulary.to_numpy(zero_copy_only=False), categorize=False)


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``start .. start + length - 1`` of all runs, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - ends + lengths, lengths)
