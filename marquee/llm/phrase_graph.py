"""Phrases that stand out, mined from a weighted de Bruijn graph of words.

The edges of the graph are the longest grams (five words), its nodes the grams one word shorter; an edge
leads from its first four words to its last four and weighs as often as it occurs. Only edges are
counted in the texts, with the tails: at the end of a piece of text, grams get too short to be edges, so
every position there gives what is left. A node's count is the weight that flows out of it plus its
tails, and so are the counts of three, two and one words, each from those of one word more.

A node whose whole flow comes in by one edge and leaves by one is unary: it says nothing that its
edges do not. Unary paths are compacted by pointer doubling, so that a passage that is repeated as a
whole is one path, however long. Phrases of five words are read off the paths; shorter phrases are the
nodes whose flow does not all go on by one edge or come from one.

A phrase can only be frequent if its words are, and its pairs of words. Frequent words are found first, then
frequent pairs of these, and put into a Bloom filter each; pieces are cut where a pair is not in it. The cut
parts are pieces like others, so every count of a frequent phrase stays exact, and what a filter lets
through by mistake is merely counted in vain. A filter grows with what is frequent up to a fixed size,
beyond which it lets more through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.buffers import LOWER, flags, text_bytes, word_table
from marquee.llm.common import shared, ship, written
from marquee.llm.text import hash_words, mix, slices

LONGEST = 5
LEAST = 100
TOP = 2000
NO_LANGUAGE = "und"

# Bits of the filter per frequent word or pair, its greatest size in 64-bit cells, and its hashes.
BITS = 16
MOST_CELLS = 1 << 21
HASHES = 3
# Distinct grams that a counting task holds before it passes them on.
HELD = 1 << 20
# Text that a task works on at once, if no text is longer.
SLICE = 2 << 20

# What parts pieces, and what parts words.
_BREAK = flags(b".,;:!?\n\v\f\r")
_SEPARATOR = _BREAK | flags(b" \t")


def _language() -> Column:
    return F.coalesce(F.col("lang"), F.lit(NO_LANGUAGE))


def _pieces(texts: pa.Array):
    """Words of texts, and whether each goes on to the next in the same piece."""
    data, offsets = text_bytes(texts)
    words = word_table(LOWER[data], offsets, _SEPARATOR)
    breaks = np.cumsum(_BREAK[data], dtype=np.int32)[words.starts]
    goes_on = np.zeros(len(words.codes), dtype=bool)
    goes_on[:-1] = (breaks[1:] == breaks[:-1]) & (words.texts[1:] == words.texts[:-1])
    return words, goes_on


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    for piece in slices(batch, size=SLICE):
        langs = piece.column("lang")
        for lang in pc.unique(langs).to_pylist():
            yield lang, piece.column("text").filter(pc.equal(langs, lang))


def _keys(lang: str, words) -> np.ndarray:
    """A hash per word of the language."""
    salt = hash_words(pa.array([lang]))[0]
    return mix(hash_words(words.vocabulary) ^ salt)[words.codes] if len(words.codes) else np.zeros(0, np.uint64)


def mix_pairs(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the word at each place and the next one."""
    return mix(keys[at] * np.uint64(0x9E3779B97F4A7C15) + keys[at + 1])


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def short_counts(docs: DataFrame, words_in=None) -> DataFrame:
    """``lang``, ``size``, ``key`` and ``n``: words by their hash, and as size 0 the number of all words. With
    a filter ``words_in`` of frequent words, pairs of two such words instead.

    Hashes only serve the filters: what shares one looks more frequent than it is."""
    names = ["lang", "size", "key", "n"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        total: dict[str, int] = {}
        size = 0

        def rows(lang: str, kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(keys)), pa.repeat(pa.scalar(kind, pa.int32()), len(keys)),
                 pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], names=names
            )

        def merged() -> dict:
            return {lang: [_sums(*(np.concatenate(x) for x in zip(*parts)))] for lang, parts in held.items()}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, parts in merged().items():
                yield rows(lang, 1 if words_in is None else 2, *parts[0])

        for batch in batches:
            for lang, texts in _by_language(batch):
                words, goes_on = _pieces(texts)
                total[lang] = total.get(lang, 0) + len(words.codes)
                keys = _keys(lang, words)
                if words_in is not None:
                    frequent = _in_filter(words_in.value, keys)
                    goes_on[:-1] &= frequent[:-1] & frequent[1:]
                    keys = mix_pairs(keys, np.flatnonzero(goes_on))
                held.setdefault(lang, []).append(_sums(keys, np.ones(len(keys), dtype=np.int64)))
                size += len(held[lang][-1][0])
                if size > HELD:
                    held = merged()
                    size = sum(len(parts[0][0]) for parts in held.values())
                    if size > HELD // 2:
                        yield from passed_on()
                        held, size = {}, 0
        yield from passed_on()
        if words_in is None:
            for lang, n in total.items():
                yield rows(lang, 0, np.zeros(1, dtype=np.uint64), np.array([n]))

    counted = docs.mapInArrow(count, "lang string, size int, key long, n long")
    return counted.groupBy("lang", "size", "key").agg(F.sum("n").alias("n"))


def _places(keys: np.ndarray, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cell and bit of each key under each hash."""
    for which in range(HASHES):
        place = mix(keys + np.uint64((which + 1) * 0xD1B54A32D192ED03 % 2**64))
        yield (place >> np.uint64(6)) & np.uint64(cells - 1), np.uint64(1) << (place & np.uint64(63))


def frequent_filter(counts: DataFrame, least: int) -> np.ndarray:
    """A Bloom filter of all words or pairs that occur ``least`` times. Its cells, at most
    ``MOST_CELLS``, are what comes to the driver."""
    frequent = written(counts.filter((F.col("size") > 0) & (F.col("n") >= least)).select("key"), "frequent")
    wanted = max(frequent.count() * BITS // 64, 64)
    cells = min(MOST_CELLS, 1 << int(wanted - 1).bit_length())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, bit in _places(batch.column("key").to_numpy().view(np.uint64), cells):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int64)), pa.array(bit.view(np.int64))], names=["cell", "bits"]
                )

    placed = frequent.mapInArrow(place, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    got = placed.toArrow()
    filled = np.zeros(cells, dtype=np.uint64)
    filled[got.column("cell").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return filled


def _in_filter(cells: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), dtype=bool)
    for cell, bit in _places(keys, len(cells)):
        found &= cells[cell] & bit != 0
    return found


def _run_lengths(goes_on: np.ndarray, longest: int) -> np.ndarray:
    """How many words, up to ``longest``, are in the same run from each word on."""
    run = np.ones(len(goes_on), dtype=np.int32)
    ahead = goes_on.copy()
    for step in range(1, longest):
        run += ahead
        ahead[:-step or None] &= goes_on[step:]
        ahead[len(ahead) - step :] = False
    return run


def _grams(words, run: np.ndarray, at: np.ndarray, size: int) -> tuple[pa.Array, np.ndarray]:
    """The distinct grams of ``size`` words that begin at some words, and how often each does."""
    at = at[run[at] == size]
    columns = [words.codes[at + step] for step in range(size)]
    order = np.lexsort(columns[::-1])
    columns = [column[order] for column in columns]
    new = np.zeros(len(at), dtype=bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    first = np.flatnonzero(new)
    parts = [words.vocabulary.take(pa.array(column[first])) for column in columns]
    joined = pc.binary_join_element_wise(*parts, pa.scalar(" ")) if size > 1 else parts[0]
    return joined, np.diff(np.append(first, len(at)))


def edges_and_tails(docs: DataFrame, words_in, pairs_in, longest: int) -> DataFrame:
    """``lang``, ``size``, ``gram`` (words with single spaces) and ``n``: of ``longest`` words the edges,
    of fewer the tails where a piece ends or is cut."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _by_language(batch):
                words, goes_on = _pieces(texts)
                keys = _keys(lang, words)
                frequent = _in_filter(words_in.value, keys)
                goes_on[:-1] &= frequent[:-1] & frequent[1:]
                linked = np.flatnonzero(goes_on)
                goes_on[linked] = _in_filter(pairs_in.value, mix_pairs(keys, linked))
                run = _run_lengths(goes_on, longest)
                # a word that is frequent by no count is in no frequent phrase
                at = np.flatnonzero(frequent)
                for size in range(1, longest + 1):
                    gram, n = _grams(words, run, at, size)
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(lang, len(n)), pa.repeat(pa.scalar(size, pa.int32()), len(n)), gram,
                         pa.array(n, pa.int64())], names=["lang", "size", "gram", "n"]
                    )

    counted = docs.mapInArrow(count, "lang string, size int, gram string, n long")
    return counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


def first_words(gram: str | Column, count: int | Column) -> Column:
    return F.call_function("substring_index", gram, F.lit(" "), F.lit(count) if isinstance(count, int) else count)


def last_words(gram: str | Column, count: int | Column) -> Column:
    return first_words(gram, -count)


def flows(grams: DataFrame, longest: int) -> dict[int, DataFrame]:
    """Per size ``lang``, ``gram``, ``n`` and ``onward``, the most that flows out by one edge."""
    longer = grams.filter(F.col("size") == longest).select("lang", "gram", "n", F.lit(0).cast("long").alias("onward"))
    by_size = {longest: longer}
    for size in range(longest - 1, 0, -1):
        out = longer.select("lang", first_words("gram", size).alias("gram"), "n", F.col("n").alias("onward"))
        tails = grams.filter(F.col("size") == size).select("lang", "gram", "n", F.lit(0).cast("long").alias("onward"))
        summed = out.unionByName(tails).groupBy("lang", "gram")
        longer = written(summed.agg(F.sum("n").alias("n"), F.max("onward").alias("onward")), f"flow{size}")
        by_size[size] = longer
    return by_size


def compact_paths(edges: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``lang``, ``path``, ``n`` and ``edges``: maximal paths whose inner nodes are unary, as text.

    ``edges`` are grams of ``size`` words, ``nodes`` those of one word less. An edge goes on to another
    if both weigh what the node between them does, so all of one is followed by all of the other, and
    no circle is possible. Each round doubles how far an edge has been followed, so the rounds are the
    logarithm of the longest path. A path is no longer than a piece of one text.
    """
    on = nodes.select("lang", F.col("gram").alias("node"), F.col("n").alias("flow"))
    ends = edges.select("lang", F.col("gram").alias("edge"), last_words("gram", size - 1).alias("node"), "n")
    starts = edges.select("lang", F.col("gram").alias("next"), first_words("gram", size - 1).alias("node"), "n")
    # what weighs as much as the node is its only edge on that side
    links = ends.join(on, ["lang", "node"]).filter("n = flow").join(starts, ["lang", "node", "n"])
    # how far ahead an edge has been followed, and to which edge
    ahead = written(
        edges.select("lang", F.col("gram").alias("edge"), "n").join(
            links.select("lang", "edge", "next"), ["lang", "edge"], "left"
        ),
        "links",
    ).select(
        "lang", "edge", "n", F.coalesce("next", "edge").alias("last"), F.col("next").isNotNull().cast("int").alias("steps")
    )
    while True:
        far = ahead.select("lang", F.col("edge").alias("last"), F.col("last").alias("farther"), F.col("steps").alias("more"))
        ahead = written(
            ahead.join(far.filter("more > 0"), ["lang", "last"], "left").select(
                "lang",
                "edge",
                "n",
                F.coalesce("farther", "last").alias("last"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                F.col("more").isNotNull().alias("moved"),
            ),
            "paths",
        )
        if ahead.filter("moved").isEmpty():
            break
        ahead = ahead.drop("moved")
    along = F.array_sort(F.collect_list(F.struct((-F.col("steps")).alias("place"), "edge")))
    words = F.transform("along", lambda own: last_words(own["edge"], 1))
    path = F.array_join(F.concat(F.array(first_words(F.col("along")[0]["edge"], size - 1)), words), " ")
    return (
        ahead.groupBy("lang", "last", "n")
        .agg(along.alias("along"))
        .select("lang", path.alias("path"), "n", F.size("along").alias("edges"))
    )


def path_edges(paths: DataFrame, size: int) -> DataFrame:
    """The edges that paths are made of: ``lang``, ``gram`` and ``n``."""
    words = F.split("path", " ")
    at = F.explode(F.sequence(F.lit(1), F.col("edges"))).alias("at")
    placed = paths.select("lang", "n", words.alias("words"), at)
    gram = F.array_join(F.slice("words", F.col("at"), F.lit(size)), " ")
    return placed.select("lang", gram.alias("gram"), "n")


def candidates(by_size: dict[int, DataFrame], longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases that no longer one accounts for, ``lang``, ``size``, ``gram``, ``n``; and the counts of
    all frequent phrases and words."""
    heavy = {size: flow.filter(F.col("n") >= least) for size, flow in by_size.items()}
    edges = written(heavy[longest].select("lang", "gram", "n"), "edges")
    paths = written(compact_paths(edges, heavy[longest - 1], longest), "compact")
    heavy[longest] = path_edges(paths, longest)
    kept = [heavy[longest].select("lang", F.lit(longest).alias("size"), "gram", "n")]
    for size in range(longest - 1, 1, -1):
        # the most that comes in by one edge
        back = heavy[size + 1].groupBy("lang", last_words("gram", size).alias("gram")).agg(F.max("n").alias("inward"))
        own = heavy[size].join(back, ["lang", "gram"], "left")
        free = (F.col("onward") < F.col("n")) & (F.coalesce("inward", F.lit(0)) < F.col("n"))
        kept.append(own.filter(free).select("lang", F.lit(size).alias("size"), "gram", "n"))
    counted = [heavy[size].select("lang", "gram", "n") for size in range(1, longest)]
    return reduce(DataFrame.unionByName, kept), reduce(DataFrame.unionByName, counted)


def scored(phrases: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases with their lowest-scoring cut: counts ``l`` and ``r`` of its parts, and ``score``."""
    exact = lambda name: F.col(name).cast("decimal(18,0)")  # noqa: E731  products of two fit a decimal
    cut = phrases.select(
        "lang", "gram", F.col("n").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).withColumns(
        {"left": first_words("gram", F.col("k")), "right": last_words("gram", F.col("size") - F.col("k"))}
    )
    parts = cut.join(counts.select("lang", F.col("gram").alias("left"), F.col("n").alias("l")), ["lang", "left"]).join(
        counts.select("lang", F.col("gram").alias("right"), F.col("n").alias("r")), ["lang", "right"]
    )
    of_all = parts.join(totals, "lang").withColumns(
        {"above": (F.lit(1000) * F.col("a")).cast("decimal(20,0)") * exact("n"), "below": exact("l") * exact("r")}
    )
    found = of_all.withColumn("score", F.expr("above div below"))
    least = F.min(F.struct("score", "k", "l", "r")).alias("least")
    return found.groupBy("lang", "gram", "a", "n").agg(least).select("lang", "gram", "a", "n", "least.*")


def phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Per language the ``top`` phrases of 2 to ``longest`` words by score: ``lang``, ``rank``, ``phrase``, ``a``,
    ``l``, ``r``, ``n`` and ``score``.

    Texts are lower-cased in A-Z and parted into pieces at punctuation and line ends; null and empty ones
    have none. A null language counts as ``und``. Repeated rows count as often as they stand there, and ids
    and other columns are ignored. A long text is worked on as a whole, some 60 bytes in memory for each of
    its bytes. Ties are broken by frequency, then by the phrase's bytes; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    texts = docs.select(_language().alias("lang"), "text").filter("text is not null")
    spark = docs.sparkSession
    counts = written(short_counts(texts), "words")
    words_in = shared(spark, frequent_filter(counts, least))  # at most MOST_CELLS cells, as the next
    pairs_in = shared(spark, frequent_filter(short_counts(texts, words_in), least))
    grams = written(edges_and_tails(texts, words_in, pairs_in, longest), "grams")
    free, known = candidates(flows(grams, longest), longest, least)
    # a table of its own, so that its size is known where it is joined
    totals = written(counts.filter("size = 0").select("lang", "n"), "totals")
    ranked = scored(written(free, "phrases"), written(known, "counts"), totals)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "gram")
    return (
        ranked.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), F.col("gram").alias("phrase"), "a", "l", "r", "n", "score")
    )
