"""Token ids of whole texts, from a public tokenizer file, in tasks.

A tokenizer that drops white space and never joins across it gives a text the ids of its words
one after the other. So each distinct word is encoded once per Python worker, and ids are
gathered per text. Words of letters alone are encoded together: each gives one run of
ids, of which only the last ends a word in the vocabulary. Texts for which that might differ (with combining marks, which can
compose with what a split cuts off, or with a ``<|`` that could be a special token) are encoded whole. So
is every text if the tokenizer's settings are others than the ones that this is known of.
"""

from __future__ import annotations

import json
import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marquee.llm.text import Words, ragged

# Words remembered by a Python worker; beyond that only those met again are kept. This bounds
# memory, not the result.
REMEMBERED = 600_000
# Words of letters that are encoded in one go.
LINE_WORDS = 1_000

# Settings of a tokenizer by which a text's ids are those of its words.
WORD_BY_WORD = {
    "normalizer": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
    "split": {
        "type": "Split",
        "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
}


def goes_word_by_word(settings: dict) -> bool:
    """Whether a tokenizer of these settings (its file) gives a text the ids of its words."""
    normalizers = (settings.get("normalizer") or {}).get("normalizers")
    splits = (settings.get("pre_tokenizer") or {}).get("pretokenizers") or [None]
    return (
        normalizers == WORD_BY_WORD["normalizer"]
        and splits[0] == WORD_BY_WORD["split"]
        and not settings["model"].get("dropout")
        and settings.get("truncation") is None
        and settings.get("padding") is None
        and all(token["content"].startswith("<|") for token in settings.get("added_tokens", []))
    )


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = goes_word_by_word(json.loads(self.tokenizer.to_str()))
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if suffix:
            self.ends_word[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
        self._start()

    def _start(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.ends_sentence = array("I"), array("q", [0]), array("b")

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _remember(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        base = len(self.known)
        self.known.update(zip(words, range(base, base + len(words))))
        ends = len(self.ids) + np.cumsum(lengths, dtype=np.int64)
        self.ids.frombytes(ids.astype(np.uint32).tobytes())
        self.starts.frombytes(ends.tobytes())
        self.ends_sentence.extend(word[-1:] in ".!?" for word in words)

    def _forget_all_but(self, words: list[str]) -> None:
        kept = [word for word in words if word in self.known]
        numbers = np.array([self.known[word] for word in kept], dtype=np.int64)
        starts = np.array(self.starts, dtype=np.int64)
        lengths = starts[numbers + 1] - starts[numbers]
        ids = np.array(self.ids, dtype=np.uint32)[ragged(starts[numbers], lengths)]
        self._start()
        self._remember(kept, ids, lengths)

    def _learn_apart(self, words: list[str]) -> None:
        encoded = self.whole(words)
        flat = np.array([number for ids in encoded for number in ids], dtype=np.uint32)
        self._remember(words, flat, np.array([len(ids) for ids in encoded], dtype=np.int64))

    def _learn(self, words: list[str]) -> None:
        """Encode words of letters in long lines, cut after each id that ends a word."""
        if not words:
            return
        lines = [" ".join(words[at : at + LINE_WORDS]) for at in range(0, len(words), LINE_WORDS)]
        ids = np.concatenate([np.array(x, dtype=np.uint32) for x in self.whole(lines)])
        ends = np.flatnonzero(self.ends_word[ids])
        if len(ends) != len(words) or ends[-1] != len(ids) - 1:
            self._learn_apart(words)
        else:
            self._remember(words, ids, np.diff(np.append(-1, ends)))

    def _numbers(self, vocabulary: pa.Array) -> np.ndarray:
        words = vocabulary.to_pylist()
        if len(self.known) + len(words) > REMEMBERED:
            self._forget_all_but(words)
        numbers = np.fromiter((self.known.get(word, -1) for word in words), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            unknown = vocabulary.take(pa.array(new))
            plain = pc.match_substring_regex(unknown, r"^\pL+$")
            self._learn(unknown.filter(plain).to_pylist())
            odd = unknown.filter(pc.invert(plain)).to_pylist()
            if odd:
                self._learn_apart(odd)
            numbers[new] = [self.known[word] for word in unknown.to_pylist()]
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``offsets`` (one more than texts), ``ids``, and which ids end a sentence (of texts that are
        encoded whole, none is known to)."""
        if not self.by_words:
            encoded = self.whole(texts.to_pylist())
            ids = np.array([number for own in encoded for number in own], dtype=np.uint32)
            return np.concatenate([[0], np.cumsum([len(own) for own in encoded])]).astype(np.int64), ids, ids < 0
        odd = pc.or_(pc.match_substring_regex(texts, r"\pM"), pc.match_substring(texts, "<|"))
        odd_rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        plain = pc.if_else(odd, "", texts) if len(odd_rows) else texts
        # letters and the punctuation after them are encoded apart anyway; so there are fewer words
        spaced = pc.replace_substring_regex(pc.ascii_lower(plain), r"(\pL)([.,;:!?])", r"\1 \2")
        words = Words(spaced)
        numbers = self._numbers(words.vocabulary)
        all_starts = np.frombuffer(self.starts, dtype=np.int64)
        starts, lengths = all_starts[numbers], all_starts[numbers + 1] - all_starts[numbers]
        closing = np.frombuffer(self.ends_sentence, dtype=np.int8)[numbers] if len(numbers) else numbers
        per_word = lengths[words.codes]
        ids = np.frombuffer(self.ids, dtype=np.uint32)[ragged(starts[words.codes], per_word)]
        ends = np.zeros(len(ids), dtype=bool)
        last = np.cumsum(per_word) - 1
        ends[last[(closing[words.codes] == 1) & (per_word > 0)]] = True
        offsets = np.concatenate([[0], np.cumsum(per_word)])[words.offsets]
        if len(odd_rows):
            return self._with_odd(texts, odd_rows, offsets, ids, ends)
        return offsets, ids, ends

    def _with_odd(self, texts, odd_rows, offsets, ids, ends):
        encoded = dict(zip(odd_rows.tolist(), self.whole(texts.take(pa.array(odd_rows)).to_pylist())))
        all_ids, all_ends, sizes = [], [], []
        for row in range(len(texts)):
            if row in encoded:
                all_ids.append(np.array(encoded[row], dtype=np.uint32))
                all_ends.append(np.zeros(len(encoded[row]), dtype=bool))
            else:
                all_ids.append(ids[offsets[row] : offsets[row + 1]])
                all_ends.append(ends[offsets[row] : offsets[row + 1]])
            sizes.append(len(all_ids[-1]))
        return np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(all_ids), np.concatenate(all_ends)


def with_end(offsets: np.ndarray, ids: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with ``end`` appended to each text, and their offsets."""
    return offsets + np.arange(len(offsets)), np.insert(ids, offsets[1:], np.uint32(end)).astype(np.uint32)
