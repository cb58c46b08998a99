"""Toxicity by a convolutional text classifier, trained in numpy.

Words (runs of ASCII letters and digits and of other letters, A-Z lowered) have an embedding that
is a sum of hashed rows: two each for the word and for its beginnings, by which it resembles other
forms of its stem. Two hash functions make it rare that words are confused. Filters of several widths run over the whole text; each filter's maximum, rectified, goes into a logistic output. A small word model of the training texts guesses the language, and the score is shifted so
that each language's own best threshold lies at ``threshold``.

The network is fitted on all labelled training documents. Each pass is a job: every task starts from
the same network, takes the steps of its own documents and returns what they changed, by blocks of
parameters that are averaged in tasks, over those that changed them. Words by language and the best thresholds are counted over
all labelled documents, too. What little fits the driver is fitted there in one go. Scoring runs over all rows in tasks. A
task computes each distinct word's product with all filters once and adds them up by position.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import held_out_part, shared, ship, training_part, written
from marquee.llm.text import Words, filled, hash_words, slices

# At most so many labelled documents of either label are in a sample, none longer than that.
SAMPLE_PER_LABEL = 4_000
SAMPLE_BYTES = 50_000
# Labelled text up to that is fitted on the driver, more of it in tasks.
LOCAL_BYTES = 16 << 20
# Passes over all learning documents, on the driver or in tasks, and the most networks that are averaged after one.
EPOCHS = 8
TRAINERS = 64
# Rows of a parameter that are averaged together.
BLOCK = 1 << 13
# Logits are counted in bins of that width to find the thresholds.
LOGIT_BIN = 1 / 256
# Bits of the filter of labelled ids, 2 MB; a multiple of the 32,768 of a bitmap.
ID_BITS = 1 << 24
# Text that a task scores at once, if no text is longer, and the driver.
SLICE = 2 << 20
LOCAL_SLICE = 256 << 10

ROWS = 1 << 17
DIM = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
LANGUAGE_ROWS = 1 << 15
PAD = max(WIDTHS)
# Letters of a word's beginnings.
BEGINNINGS = (4, 5)


# A-Z lowered, other ASCII but letters and digits a space, all else as it is
_BYTES = np.array(
    [b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)],
    dtype=np.uint8,
)


def _spaced(texts: pa.Array) -> pa.Array:
    """The texts with lowered letters and spaces for all that is in no word; none is null."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if data is None:
        return texts
    starts = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1]
    plain = _BYTES[np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]]]
    return pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer(starts - starts[0]), pa.py_buffer(plain)])


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words and their beginnings (a row each); per position the index of its word, the number of words for
    padding; where each text starts. Every text ends in padding of the widest window."""
    words = Words(_spaced(texts))
    forms = [words.vocabulary, *(pc.utf8_slice_codeunits(words.vocabulary, 0, n) for n in BEGINNINGS)]
    hashes = np.stack([hash_words(form) for form in forms])
    counts = np.diff(words.offsets)
    starts = words.offsets[:-1] + PAD * np.arange(len(counts))
    codes = np.full(len(words.codes) + PAD * len(counts), hashes.shape[1], dtype=np.int64)
    rows = np.repeat(np.arange(len(counts)), counts)
    codes[np.arange(len(words.codes)) + PAD * rows] = words.codes
    return hashes, codes, starts


def coded_runs(texts: pa.Array, run: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What ``word_codes`` gives for each ``run`` of the texts, but for the order of its words; a word of several runs is hashed once."""
    hashes, codes, starts = word_codes(texts)
    for at in range(0, len(starts), run):
        own = starts[at : at + run]
        stop = starts[at + run] if at + run < len(starts) else len(codes)
        words, places = np.unique(codes[own[0] : stop], return_inverse=True)
        yield hashes[:, words[:-1]], places, own - own[0]  # padding is the last


def inner_stops(starts: np.ndarray, size: int) -> np.ndarray:
    """Where the windows of each text stop that do not reach into the next one."""
    return np.append(starts[1:], size) - (PAD - 1)


@dataclass
class Network:
    seed: int = 10
    tables: list[np.ndarray] = field(init=False)
    filters: dict[int, np.ndarray] = field(init=False)
    biases: dict[int, np.ndarray] = field(init=False)
    out: np.ndarray = field(init=False)
    base: float = 0.0
    languages: list[str] = field(default_factory=list)
    language_weights: np.ndarray | None = None
    thresholds: np.ndarray | None = None

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        self.tables = [rng.normal(0, 0.01, (ROWS, DIM)).astype(np.float32) for _ in range(2 * (1 + len(BEGINNINGS)))]
        self.filters = {w: rng.normal(0, 0.4, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.biases = {w: np.zeros(FILTERS, dtype=np.float32) for w in WIDTHS}
        self.out = rng.normal(0.3, 0.1, FILTERS * len(WIDTHS)).astype(np.float32)

    def rows(self, hashes: np.ndarray) -> list[np.ndarray]:
        """The row in each table, per word."""
        return [(form >> np.uint64(shift) & np.uint64(ROWS - 1)).astype(np.int64) for form in hashes for shift in (0, 40)]

    def embedded(self, hashes: np.ndarray) -> np.ndarray:
        """A vector per distinct word and a zero one for padding."""
        vectors = sum(table[rows] for table, rows in zip(self.tables, self.rows(hashes)))
        return np.vstack([vectors, np.zeros((1, DIM), dtype=np.float32)])

    def responses(self, vectors: np.ndarray, codes: np.ndarray, width: int) -> np.ndarray:
        """Per position and filter the response of the window that starts there."""
        padding = len(vectors) - 1
        total = np.broadcast_to(self.biases[width], (len(codes), FILTERS)).copy()
        for at in range(width):
            products = vectors @ self.filters[width][at]
            total += products[codes if not at else np.append(codes[at:], np.full(at, padding))]
        return total

    def logits(self, hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        vectors = self.embedded(hashes)
        bounds = np.stack([starts, inner_stops(starts, len(codes))], axis=1).ravel()
        pooled = [np.maximum.reduceat(self.responses(vectors, codes, w), bounds, axis=0)[::2] for w in WIDTHS]
        return np.maximum(np.hstack(pooled), 0) @ self.out + self.base

    def guessed_languages(self, hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if self.language_weights is None:
            return np.zeros(len(starts), dtype=np.int64)
        rows = np.append((hashes[0] % np.uint64(LANGUAGE_ROWS)).astype(np.int64), LANGUAGE_ROWS)
        return np.add.reduceat(self.language_weights[rows][codes], starts, axis=0).argmax(axis=1)

    def scores(self, texts: pa.Array, threshold: float) -> np.ndarray:
        """Probability-like scores; each language's best threshold is at ``threshold``."""
        coded = word_codes(texts)
        shift = self.thresholds[self.guessed_languages(*coded)] if self.thresholds is not None else 0.0
        logits = self.logits(*coded) - shift + np.log(threshold / (1 - threshold))
        return 1 / (1 + np.exp(-np.clip(logits, -50, 50).astype(np.float64)))


# Adagrad's sums before the first step.
FIRST_SUM = np.float32(1e-6)


class _Adagrad:
    def __init__(self, rate: float):
        self.rate, self.sums = rate, {}

    def step(self, key, value: np.ndarray, gradient: np.ndarray, rows: np.ndarray | None = None) -> None:
        if key not in self.sums:
            self.sums[key] = np.full(value.shape, FIRST_SUM)
        sums = self.sums[key]
        at = slice(None) if rows is None else rows
        sums[at] += gradient * gradient
        value[at] -= self.rate * gradient / np.sqrt(sums[at])


def _learn(network: Network, adagrad: _Adagrad, coded: tuple[np.ndarray, ...], toxic: np.ndarray, weight: np.ndarray) -> None:
    """One step on some texts, as from ``word_codes``. Gradients reach only the windows that gave the maxima."""
    hashes, codes, starts = coded
    vectors = network.embedded(hashes)
    rows = [np.append(r, 0) for r in network.rows(hashes)]
    stops = inner_stops(starts, len(codes))
    best, pooled = {}, []
    for w in WIDTHS:
        z = network.responses(vectors, codes, w)
        best[w] = np.stack([a + z[a:b].argmax(axis=0) for a, b in zip(starts, stops)])
        pooled.append(z[best[w], np.arange(FILTERS)])
    hidden = np.maximum(np.hstack(pooled), 0)
    logits = hidden @ network.out + network.base
    error = ((1 / (1 + np.exp(-np.clip(logits, -30, 30))) - toxic) * weight / len(toxic)).astype(np.float32)
    to_hidden = error[:, None] * network.out * (hidden > 0)
    touched, moves = [], []
    steps = []
    padded = np.append(codes, np.full(PAD, hashes.shape[1]))
    for k, w in enumerate(WIDTHS):
        part = to_hidden[:, k * FILTERS : (k + 1) * FILTERS]
        gradient = np.empty_like(network.filters[w])
        for at in range(w):
            words = padded[best[w] + at]
            gradient[at] = np.einsum("nfd,nf->df", vectors[words], part)
            touched.append(words.ravel())
            moves.append((part[:, :, None] * network.filters[w][at].T[None]).reshape(-1, DIM))
        steps.append((("filter", w), network.filters[w], gradient))
        steps.append((("bias", w), network.biases[w], part.sum(axis=0)))
    steps.append(("out", network.out, hidden.T @ error))
    words, moves = np.concatenate(touched), np.concatenate(moves)
    real = words < hashes.shape[1]
    for which, table in enumerate(network.tables):
        unique, inverse = np.unique(rows[which][words[real]], return_inverse=True)
        gradient = np.zeros((len(unique), DIM), dtype=np.float32)
        np.add.at(gradient, inverse, moves[real])
        adagrad.step(("table", which), table, gradient, unique)
    for key, value, gradient in steps:
        adagrad.step(key, value, gradient)
    base = np.array([network.base], dtype=np.float32)
    adagrad.step("base", base, np.array([error.sum()]))
    network.base = float(base[0])


def _best_threshold(logits: np.ndarray, toxic: np.ndarray, rows: np.ndarray | None = None) -> float:
    """Where F1 is largest: midway to the next lower logit, or 1 above a clean lot. With ``rows``, a logit stands
    for so many documents, of which ``toxic`` are so."""
    if not toxic.any():
        return float(logits.max()) + 1 if len(logits) else 0.0
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(toxic[order])
    taken = np.arange(1, len(order) + 1) if rows is None else np.cumsum(rows[order])
    f1 = 2 * hits / (taken + toxic.sum())
    at = int(f1.argmax())
    here = logits[order[at]]
    below = logits[order[at + 1]] if at + 1 < len(order) else here - 2
    return float((here + below) / 2)


def fit(sample: pd.DataFrame | DataFrame, epochs: int = EPOCHS, batch: int = 32, seed: int = 10) -> Network:
    """Fit on columns ``text``, ``toxic``, ``lang``. A quarter of the rows sets the thresholds.

    A Spark frame, as from ``labelled_rows``, is learnt from in tasks, whatever its size, in as many passes. Without any
    rows the network scores everything alike, below the threshold.
    """
    if isinstance(sample, DataFrame):
        return fit_rows(sample, epochs, batch, seed)
    columns = [pa.array(sample[name].astype(object), pa.string(), from_pandas=True) for name in ("text", "lang")]
    return _fit_here(filled(columns[0]), sample["toxic"].to_numpy(dtype=np.float32), columns[1], epochs, batch, seed)


def _fit_here(texts: pa.Array, toxic: np.ndarray, langs: pa.Array, epochs: int, batch: int, seed: int) -> Network:
    """Fit on texts that this process holds; what it derives from them, a slice at a time."""
    network = Network(seed)
    if not len(texts):
        network.base = -3.0
        return network
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    calibrating, learning = order[::4], np.array([i for k, i in enumerate(order) if k % 4 or len(order) < 8])
    share = min(max(toxic[learning].mean(), 0.01), 0.99)
    weights = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))
    adagrad = _Adagrad(0.1)
    for _ in range(epochs):
        rng.shuffle(learning)
        for at in range(0, len(learning), batch):
            rows = learning[at : at + batch]
            _learn(network, adagrad, word_codes(texts.take(pa.array(rows))), toxic[rows], weights[rows])
    rows = pa.RecordBatch.from_arrays([texts, langs], names=["text", "lang"])
    _weigh_languages(network, _counts_by_language([rows], LOCAL_SLICE))
    judged = []
    for piece in slices(rows.select(["text"]).take(pa.array(calibrating)), size=LOCAL_SLICE):
        coded = word_codes(piece.column("text"))
        judged.append((network.logits(*coded), network.guessed_languages(*coded)))
    logits, guessed = (np.concatenate(parts) for parts in zip(*judged))
    own = toxic[calibrating]
    overall = _best_threshold(logits, own)
    network.thresholds = np.array(
        [
            _best_threshold(logits[guessed == k], own[guessed == k]) if own[guessed == k].sum() >= 20 else overall
            for k in range(max(1, len(network.languages)))
        ],
        dtype=np.float32,
    )
    return network


def _language_counts(texts: pa.Array) -> np.ndarray:
    """Words by the row that they are hashed to."""
    hashes, codes, _ = word_codes(texts)
    words = codes[codes < hashes.shape[1]]
    return np.bincount((hashes[0] % np.uint64(LANGUAGE_ROWS)).astype(np.int64)[words], minlength=LANGUAGE_ROWS)


def _counts_by_language(batches: Iterable[pa.RecordBatch], size: int) -> dict[str, np.ndarray]:
    """Words by language and hashed row, of the rows with a language; ``size`` bytes of text at a time."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for piece in slices(batch, size=size):
            texts, langs = filled(piece.column("text")), piece.column("lang")
            for language in pc.unique(langs.drop_null()).to_pylist():
                found = _language_counts(texts.filter(pc.equal(langs, pa.scalar(language, langs.type))))
                counts[language] = counts.get(language, 0) + found
    return counts


def _weigh_languages(network: Network, found: dict[str, np.ndarray]) -> None:
    """Log-likelihoods of hashed words by language, relative to their mean over languages."""
    network.languages = sorted(found)
    if not network.languages:
        return
    counts = np.stack([found[language] + 0.5 for language in network.languages], axis=1)
    logs = np.log(counts / counts.sum(axis=0))
    weights = (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)
    network.language_weights = np.vstack([weights, np.zeros((1, weights.shape[1]), dtype=np.float32)])


def _parameters(network: Network) -> dict[str, tuple[object, np.ndarray]]:
    """All that is learnt, by name: its key in Adagrad and a view with a row for each row of it."""
    found = {f"table {k}": (("table", k), table) for k, table in enumerate(network.tables)}
    for w in WIDTHS:
        found[f"filter {w}"] = (("filter", w), network.filters[w].reshape(-1, FILTERS))
        found[f"bias {w}"] = (("bias", w), network.biases[w].reshape(-1, 1))
    return found | {"out": ("out", network.out.reshape(-1, 1))}


_CHANGES = "name string, block int, part int, at binary, moves binary, sums binary"


def _changes(old: Network, old_sums: dict, new: Network, new_sums: dict, part: int) -> Iterator[pa.RecordBatch]:
    """What one task changed, by parameter and block of its rows."""
    before, after = _parameters(old), _parameters(new)
    rows = [("base", 0, np.zeros(1, np.int32), np.array([new.base - old.base], np.float32), new_sums["base"] - old_sums["base"])]
    for name, (key, value) in after.items():
        moved = value - before[name][1]
        grown = (new_sums[key] - old_sums[key]).reshape(moved.shape)
        changed = np.flatnonzero(grown.any(axis=1) | moved.any(axis=1))
        for block in np.unique(changed // BLOCK).tolist():
            at = changed[changed // BLOCK == block]
            rows.append((name, block, (at % BLOCK).astype(np.int32), moved[at], grown[at]))
    for name, block, *arrays in rows:
        columns = [pa.array([name]), pa.array([block], pa.int32()), pa.array([part], pa.int32())]
        columns += [pa.array([x.tobytes()], pa.binary()) for x in arrays]
        yield pa.RecordBatch.from_arrays(columns, names=["name", "block", "part", "at", "moves", "sums"])


def _averaged(group: pa.Table) -> pa.Table:
    """The mean change of each row of a block, over the tasks that changed it."""
    group = group.sort_by("part")
    places = [np.frombuffer(x.as_buffer(), np.int32) for x in group.column("at")]
    at, inverse, times = np.unique(np.concatenate(places), return_inverse=True, return_counts=True)
    means = []
    for name in ("moves", "sums"):
        values = [np.frombuffer(x.as_buffer(), np.float32) for x in group.column(name)]
        values = np.concatenate(values).reshape(len(inverse), -1)
        total = np.zeros((len(at), values.shape[1]))
        np.add.at(total, inverse, values)
        means.append((total / times[:, None]).astype(np.float32))
    columns = [group.column(name).combine_chunks().slice(0, 1) for name in ("name", "block", "part")]
    columns += [pa.array([x.tobytes()], pa.binary()) for x in (at, *means)]
    return pa.Table.from_arrays(columns, names=["name", "block", "part", "at", "moves", "sums"])


def _fresh_sums(network: Network) -> dict:
    """Adagrad's sums before the first step."""
    shapes = {("table", k): x.shape for k, x in enumerate(network.tables)}
    shapes |= {("filter", w): x.shape for w, x in network.filters.items()}
    shapes |= {("bias", w): x.shape for w, x in network.biases.items()} | {"out": network.out.shape, "base": (1,)}
    return {key: np.full(shape, FIRST_SUM) for key, shape in shapes.items()}


def _add_changes(network: Network, sums: dict, changes: Iterable[tuple[str, int, bytes, bytes, bytes]]) -> None:
    views = _parameters(network)
    for name, block, *data in changes:
        at = np.frombuffer(data[0], np.int32) + block * BLOCK
        moves, grown = (np.frombuffer(x, np.float32).reshape(len(at), -1) for x in data[1:])
        if name == "base":
            network.base += float(moves[0, 0])
            sums["base"] += grown[0]
            continue
        key, value = views[name]
        value[at] += moves
        sums[key].reshape(value.shape)[at] += grown


def _one_pass(network: Network, sums: dict, learning: DataFrame, share: float, batch: int) -> None:
    """Every learning document takes part in a step of the task that it is in; the network becomes the mean."""
    # what is drawn from the seed is drawn again in the tasks, only what was learnt is sent
    start = Network(network.seed)
    learnt = [
        tuple(batch.column(x)[0].as_py() for x in ("name", "block", "at", "moves", "sums"))
        for batch in _changes(start, dict.fromkeys(sums, FIRST_SUM), network, sums, 0)
    ]
    seed, model = network.seed, learning.sparkSession.sparkContext.broadcast(learnt)
    del start, learnt  # sent; the driver keeps neither during the pass

    def begun() -> tuple[Network, dict]:
        own = Network(seed)
        grown = _fresh_sums(own)
        _add_changes(own, grown, model.value)
        return own, grown

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, adagrad = None, _Adagrad(0.1)
        for rows in batches:
            for piece in slices(rows, size=SLICE):
                if own is None:
                    own, adagrad.sums = begun()
                texts, toxic = filled(piece.column("text")), piece.column("toxic").to_numpy().astype(np.float32)
                weights = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share))
                for at, coded in zip(range(0, len(toxic), batch), coded_runs(texts, batch)):
                    _learn(own, adagrad, coded, toxic[at : at + batch], weights[at : at + batch])
        if own is not None:
            yield from _changes(*begun(), own, adagrad.sums, TaskContext.get().partitionId())

    try:
        changes = learning.mapInArrow(train, _CHANGES)
        found = changes.groupBy("name", "block").applyInArrow(_averaged, _CHANGES).toArrow()
    finally:
        model.destroy()  # the files of each pass would add up
    for rows in found.to_batches():
        data = ([x.as_buffer() for x in rows.column(name)] for name in ("at", "moves", "sums"))
        _add_changes(network, sums, zip(rows.column("name").to_pylist(), rows.column("block").to_pylist(), *data))


def fit_rows(rows: DataFrame, passes: int = EPOCHS, batch: int = 32, seed: int = 10, local: int = LOCAL_BYTES) -> Network:
    """Fit on all rows of a written table of ``doc_id``, ``text``, ``toxic``, ``lang``, in its order, all of them in each pass.

    Up to ``local`` bytes of text are fitted on the driver. More is never there: it holds the network, some 60 MB
    with the sums of its steps, twice that while it sends or adds what a pass has changed, words by language and row, and
    logits by language and bin. When it ends, only the network is left.
    """
    size = F.sum(F.octet_length("text"))
    try:
        if (rows.agg(size).first()[0] or 0) > local:
            return _fit_in_tasks(rows, passes, batch, seed)
        held = rows.toArrow().sort_by([("doc_id", "ascending"), ("toxic", "ascending")]).combine_chunks()
        texts, toxic, langs = (held.column(name).combine_chunks() for name in ("text", "toxic", "lang"))
        del held
        toxic = toxic.cast(pa.float32()).to_numpy(zero_copy_only=False)
        return _fit_here(filled(texts), toxic, langs, passes, batch, seed)
    finally:
        # Arrow keeps what is freed for its next arrays; the driver's next ones are small
        pa.default_memory_pool().release_unused()


def _fit_in_tasks(rows: DataFrame, passes: int, batch: int, seed: int) -> Network:
    ship(rows.sparkSession)
    network = Network(seed)
    calibrates = F.pmod(F.xxhash64(F.lit("calibrating"), "doc_id"), F.lit(4)) == 0
    # never more tasks than networks that are averaged; a task holds a slice of its rows at a time
    learning = rows.filter(~calibrates).select("text", "toxic").coalesce(TRAINERS)
    share = min(max(learning.agg(F.avg("toxic")).first()[0] or 0.0, 0.01), 0.99)
    sums = _fresh_sums(network)
    for _ in range(passes):
        _one_pass(network, sums, learning, share, batch)
    _weigh_languages(network, _counted_languages(rows))
    bins = _binned_logits(rows.filter(calibrates), network)
    overall = _best_of(bins.groupby("bin", as_index=False)[["n", "toxic"]].sum())
    by_language = {k: own for k, own in bins.groupby("language") if own["toxic"].sum() >= 20}
    network.thresholds = np.array(
        [_best_of(by_language[k]) if k in by_language else overall for k in range(max(1, len(network.languages)))],
        dtype=np.float32,
    )
    return network


def _best_of(bins: pd.DataFrame) -> float:
    return _best_threshold(bins["bin"].to_numpy() * LOGIT_BIN, bins["toxic"].to_numpy(), bins["n"].to_numpy())


def _counted_languages(rows: DataFrame) -> dict[str, np.ndarray]:
    """Words by language and hashed row, of all rows with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for language, found in _counts_by_language(batches, SLICE).items():
            at = np.flatnonzero(found)
            columns = [pa.array([language] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(found[at])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "row", "n"])

    known = rows.filter("lang is not null")
    counted = known.select("text", "lang").mapInArrow(count, "lang string, row int, n long")
    counts = {language: np.zeros(LANGUAGE_ROWS) for (language,) in known.select("lang").distinct().collect()}
    # in Arrow: as Python rows this takes ten times the memory
    found = counted.groupBy("lang", "row").agg(F.sum("n").alias("n")).toArrow()
    for own in found.to_batches():
        for language in pc.unique(own.column("lang")).to_pylist():
            part = own.filter(pc.equal(own.column("lang"), language))
            counts[language][part.column("row").to_numpy()] = part.column("n").to_numpy()
    return counts


def _binned_logits(rows: DataFrame, network: Network) -> pd.DataFrame:
    """Documents and toxic ones among them, by guessed language and bin of their logit."""
    model = shared(rows.sparkSession, network)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, size=SLICE):
                coded = word_codes(filled(piece.column("text")))
                bins = np.floor(np.clip(model.value.logits(*coded), -50, 50) / LOGIT_BIN).astype(np.int32)
                languages = model.value.guessed_languages(*coded).astype(np.int32)
                columns = [pa.array(languages), pa.array(bins), piece.column("toxic")]
                yield pa.RecordBatch.from_arrays(columns, names=["language", "bin", "toxic"])

    judged = rows.select("text", F.col("toxic").cast("int").alias("toxic"))
    found = judged.mapInArrow(judge, "language int, bin int, toxic int").groupBy("language", "bin")
    return found.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).orderBy("language", "bin").toArrow().to_pandas()


def _known(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labels that may be learnt from, and those by id: of several the toxic one holds."""
    marked = labels.filter(training_part("doc_id", 4, 2) & F.col("toxic").isin(0, 1))
    return marked, marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def _warn_if_useless(empty: bool, marked: DataFrame) -> None:
    if empty and not marked.isEmpty():
        warnings.warn("no labelled document can be learnt from; every text gets the same score", stacklevel=3)


def _perhaps_among(docs: DataFrame, known: DataFrame) -> DataFrame:
    """The documents but most of those whose id is not in ``known``, so that a join moves few texts for nothing.

    A filter of fixed size: a bit per hash of an id, in bitmaps of 4 kB.
    """
    slot = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(ID_BITS))
    set_bits = known.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
    bitmaps = set_bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    placed = docs.withColumns({"bucket": F.bitmap_bucket_number(slot), "bit": F.bitmap_bit_position(slot)})
    byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    is_set = F.expr("pow(2, bit % 8)").cast("int").bitwiseAND(byte) != 0
    return placed.join(F.broadcast(bitmaps), "bucket").filter(is_set).select(*docs.columns)


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All labelled training documents with a text, as a written table of ``doc_id``, ``text``, ``toxic``, ``lang``.

    An id is one document: of several labels the toxic one holds, of several texts the least. The rows of a
    file are in an order given by a hash of their id. Labels none of which can be used give a warning.
    """
    usable = docs.filter(training_part("doc_id", 4, 2) & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    marked, known = _known(labels)
    one = F.min(F.struct("text", "lang")).alias("one")
    found = _perhaps_among(usable.select("doc_id", "text", "lang"), known).join(known, "doc_id").groupBy("doc_id", "toxic").agg(one)
    rows = found.select("doc_id", "one.text", "toxic", "one.lang")
    rows = written(rows.sortWithinPartitions(F.xxhash64("doc_id"), "doc_id"), "labelled")
    _warn_if_useless(rows.isEmpty(), marked)
    return rows


def labelled_sample(
    docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, max_bytes: int = SAMPLE_BYTES
) -> pd.DataFrame:
    """Up to ``per_label`` labelled training documents of either label, in an order given by a
    hash of their id; documents over ``max_bytes`` bytes are not learnt from. A bound of some
    ``2 * per_label * max_bytes`` bytes on the driver, whatever the input.

    Only labels of documents that can be learnt from are counted. An id is one document: of several labels
    the toxic one holds, of several texts the least. Labels none of which can be used give a warning.
    """
    usable = docs.filter(
        training_part("doc_id", 4, 2) & F.col("doc_id").isNotNull() & (F.octet_length("text") <= max_bytes)
    )
    marked, known = _known(labels)
    # which documents there are is found by their ids; texts are fetched for the chosen ones only
    labelled = written(known.join(usable.select("doc_id"), "doc_id", "left_semi"), "labelled")

    def some(label: int) -> DataFrame:
        own = labelled.filter(F.col("toxic") == label)
        return own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)

    chosen = written(some(0).unionByName(some(1)), "chosen")
    texts = usable.select("doc_id", "text", "lang").join(chosen, "doc_id")
    one = F.min(F.struct("text", "lang")).alias("one")
    sample = texts.groupBy("doc_id", "toxic").agg(one).select("doc_id", "one.text", "toxic", "one.lang").toPandas()
    _warn_if_useless(not len(sample), marked)
    return sample.sort_values(["doc_id", "toxic"], ignore_index=True)


def score_documents(
    docs: DataFrame,
    network: Network,
    threshold: float = 0.3,
    keep: Sequence[str] = ("doc_id",),
    names: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """The columns ``keep`` with the score and the prediction under ``names``.

    Only the text is used. Other columns are ignored, kept ones of these names give way. Null and empty texts get the score of a text without words; repeated
    rows get equal scores; an empty table gives no rows. Long texts are scored whole, some 60 bytes in memory for
    each of their bytes.
    """
    keep = [column for column in keep if column not in names]
    ship(docs.sparkSession)
    model = shared(docs.sparkSession, network)  # some 30 MB by construction
    frame = docs.select(*keep, *([] if "text" in keep else ["text"]))
    kept = frame.select(*keep).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, size=SLICE):
                scores = model.value.scores(filled(piece.column("text")), threshold)
                columns = [piece.column(name) for name in keep]
                columns += [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    schema = kept.add(names[0], "double").add(names[1], "integer")
    return frame.mapInArrow(score, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every document."""
    network = fit(labelled_rows(docs, labels))
    scored = score_documents(docs, network, threshold)
    return scored.select("doc_id", held_out_part("doc_id", 4, 2).alias("held_out"), "score", "predicted")
