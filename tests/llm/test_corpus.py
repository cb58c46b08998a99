"""Search, phrases and repeated windows: against plain Python over small tables, with all that is odd."""

import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tables import document, frame, odd_documents, some_documents

from marquee.llm import bag_search, phrase_graph, radix_windows
from marquee.llm.bag_search import bags, build_postings, classes, search
from marquee.llm.buffers import flags, text_bytes, word_table
from marquee.llm.phrase_graph import compact_paths, path_edges, phrases
from marquee.llm.radix_windows import radix_pass, regions, remove_repeats

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lowered(text):
    return (text or "").translate(ASCII_LOWER)


def test_words_of_a_slice_do_not_cross_texts():
    texts = pa.array(["skipped", "ab c", None, "d", "", " é\tf ", "g"]).slice(1)
    data, offsets = text_bytes(texts)
    words = word_table(data, offsets, flags(b" \t"))
    assert words.vocabulary.take(pa.array(words.codes)).to_pylist() == ["ab", "c", "d", "é", "f", "g"]
    assert words.texts.tolist() == [0, 0, 2, 4, 4, 5]
    assert text_bytes(pa.array([], pa.string()))[0].tolist() == []
    assert text_bytes(pa.array([None], pa.string()))[1].tolist() == [0, 0]


# search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))


def plain_search(docs, items, top=10):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs if text is not None and terms(text)]
    n, length = len(counted), sum(sum(tf.values()) for _, tf in counted)
    df = Counter(term for _, tf in counted for term in tf)
    found = []
    for item_id, text in set(items):
        scores = []
        for doc_id, tf in counted:
            m = 100 - 75 + (75 * sum(tf.values()) * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                * ((1_000_000_000 * tf[term]) // (1000 * tf[term] + 8 * m))
                for term in terms(text)
                if tf[term]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:top], 1):
            found.append((item_id, rank, doc_id, -score))
    return sorted(found, key=str)


def benchmark_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1.0))


def searched(spark, rows, items, top=10):
    found = search(frame(spark, rows).repartition(5), benchmark_frame(spark, items), top)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def some_items(rows, seed=3):
    rng = random.Random(seed)
    items = [(k, " ".join(rng.choices(terms(row[1]) or ["the"], k=8))) for k, row in enumerate(rows[:25])]
    return items + [(100, "the the ring"), (101, None), (102, ""), (103, "... ;"), (104, "nowhere at all zzz"),
                    (None, "the other one"), (0, "another text of the same id"), items[1], items[1]]


def test_search_equals_plain_ranking(spark):
    rows = some_documents() + odd_documents()
    items = some_items(rows)
    assert searched(spark, rows, items) == plain_search([row[:2] for row in rows], items)


def test_classes_of_copies_are_ranked_by_least_ids(spark):
    rng = random.Random(5)
    rows = some_documents(seed=4, count=40)
    # equal bags in other word orders, and a third of all rows one text
    rows += [document(500 - k, " ".join(rng.sample(["ring", "ander", "theer", "other"], 4))) for k in range(60)]
    rows += [document(None, "ring theer ander other"), document(441, "ring theer ander other")]
    items = [(1, "ring theer"), (2, "Ander ander RING"), (3, rows[0][1])]
    got = searched(spark, rows, items, top=4)
    assert got == plain_search([row[:2] for row in rows], items, top=4)
    assert [row[2] for row in got if row[0] == 1] == [441, 441, 442, 443]


def test_several_blocks_of_items_and_chunks_of_scores(spark, monkeypatch):
    rows = some_documents(seed=6, count=60)
    items = some_items(rows, seed=8)
    want = plain_search([row[:2] for row in rows], items)
    monkeypatch.setattr(bag_search, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(bag_search, "SCORES", 20)
    assert searched(spark, rows, items) == want


def test_a_class_is_one_bag_and_one_norm(spark):
    postings = spark.sparkContext.broadcast(build_postings([(1, "a b")]))
    rows = [document(1, "a b x"), document(2, "B y a"), document(3, "a b"), document(4, "a a b"), document(5, "x y z")]
    bagged = bags(frame(spark, rows), postings).select("doc_id", F.col("n").alias("m"), "bag")
    found = {(row.m, tuple(row.members)) for row in classes(bagged).collect()}
    assert found == {(3, (1, 2)), (2, (3,)), (3, (4,)), (3, (5,))}


def test_scores_beyond_the_doubles_are_exact():
    index = build_postings([(1, " ".join(["t"] * 3000))])
    bag = pa.array([np.array([0, 1 << 20], dtype="<u4").tobytes()], pa.binary())
    weight = 2_000_003
    ((_, _, score),) = bag_search.score_bags(index, np.array([weight]), bag, np.array([25]))
    tf = 1 << 20
    assert score.tolist() == [3000 * weight * ((1_000_000_000 * tf) // (1000 * tf + 200))]
    assert score[0] % 2 == 1 or score[0] > 2**50


def test_nothing_to_search(spark):
    rows, items = some_documents(count=3), [(1, "the")]
    assert searched(spark, [], items) == searched(spark, rows, []) == searched(spark, [document(1, None)], items) == []


# phrases


def plain_phrases(docs, longest=5, least=100, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    found = []
    for lang, grams in counts.items():
        frequent = {gram: n for gram, n in grams.items() if len(gram) > 1 and n >= least}
        inside = {}
        for gram, n in frequent.items():
            for size in range(2, len(gram)):
                for k in range(len(gram) - size + 1):
                    part = gram[k : k + size]
                    inside[part] = max(inside.get(part, 0), n)
        rows = []
        for gram, a in frequent.items():
            if inside.get(gram, 0) >= a:
                continue
            score, k = min(
                ((1000 * a * totals[lang]) // (grams[gram[:k]] * grams[gram[k:]]), k) for k in range(1, len(gram))
            )
            rows.append((-score, -a, " ".join(gram).encode(), grams[gram[:k]], grams[gram[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):  # noqa: E741
            found.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(found)


def mined(spark, rows, **parameters):
    found = phrases(frame(spark, rows).repartition(5), **parameters)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, found.collect()))


def wordy_documents(seed, count=60):
    rng = random.Random(seed)
    words = ["the", "ring", "of", "fire", "Ünd", "so", "on", "A-b"]
    passage = " ".join(f"w{k}" for k in range(23))
    rows = []
    for k in range(count):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(40))
        text += f" {passage}" if k % 3 == 0 else ""
        text += " fire fire fire fire fire fire fire" if k % 5 == 0 else ""
        rows.append(document(k, text, rng.choice(["en", "de", None])))
    return rows


@pytest.mark.parametrize("seed,least,longest", [(1, 2, 5), (2, 6, 5), (3, 3, 3), (4, 1, 2)])
def test_phrases_equal_plain_counting(spark, seed, least, longest):
    rows = wordy_documents(seed) + odd_documents()[:4] + odd_documents()[6:]
    want = plain_phrases([(row[2], row[1]) for row in rows], longest, least)
    assert len(want) > 10
    assert mined(spark, rows, longest=longest, least=least) == want


def test_a_full_filter_and_small_slices_change_nothing(spark, monkeypatch):
    rows = wordy_documents(5, 30)
    want = plain_phrases([(row[2], row[1]) for row in rows], 5, 3)
    monkeypatch.setattr(phrase_graph, "MOST_CELLS", 1)
    monkeypatch.setattr(phrase_graph, "HELD", 10)
    monkeypatch.setattr(phrase_graph, "SLICE", 100)
    assert mined(spark, rows, least=3) == want
    assert mined(spark, rows, least=3, top=4) == [row for row in want if row[1] <= 4]


def test_unary_paths_are_compacted(spark):
    text = " ".join(f"w{k}" for k in range(40))
    edges = [("en", " ".join(f"w{k}" for k in range(at, at + 3)), 7) for at in range(38)]
    nodes = [("en", " ".join(f"w{k}" for k in range(at, at + 2)), 7) for at in range(39)]
    # another edge into the middle: the path parts there
    edges.append(("en", "x w20 w21", 2))
    nodes = [(lang, gram, 9 if gram == "w20 w21" else n) for lang, gram, n in nodes] + [("en", "x w20", 2)]
    edges = [(lang, gram, 9 if gram.startswith(("w20 ", "w21 ", "w22 ")) else n) for lang, gram, n in edges]
    nodes = [(lang, gram, 9 if gram in ("w21 w22", "w22 w23") else n) for lang, gram, n in nodes]
    schema = "lang string, gram string, n long"
    edge_table = spark.createDataFrame(edges, schema)
    paths = compact_paths(edge_table, spark.createDataFrame(nodes, schema), 3)
    found = {(row.path, row.n, row.edges) for row in paths.collect()}
    words = text.split()
    assert found == {
        (" ".join(words[:22]), 7, 20),
        ("x w20 w21", 2, 1),
        (" ".join(words[20:25]), 9, 3),
        (" ".join(words[23:]), 7, 15),
    }
    again = sorted(map(tuple, path_edges(paths, 3).select("lang", "gram", "n").collect()))
    assert again == sorted(edges)


def test_scores_beyond_64_bits(spark):
    found = phrase_graph.scored(
        spark.createDataFrame([("en", 2, "a b", 10**12)], "lang string, size int, gram string, n long"),
        spark.createDataFrame([("en", "a", 10**12 + 7), ("en", "b", 10**13 + 1)], "lang string, gram string, n long"),
        spark.createDataFrame([("en", 10**15 + 3)], "lang string, n long"),
    ).first()
    assert found.score == (1000 * 10**12 * (10**15 + 3)) // ((10**12 + 7) * (10**13 + 1))


def test_no_phrases(spark):
    assert mined(spark, []) == mined(spark, [document(1, None), document(2, " . ")], least=1) == []


# repeated windows


def plain_removal(docs, length):
    seen = Counter()
    held = [(text or "").encode() for _, text in docs]
    for text in held:
        seen.update(text[k : k + length] for k in range(len(text) - length + 1))
    rows = []
    for (doc_id, _), text in zip(docs, held):
        removed = np.zeros(len(text), dtype=bool)
        for k in range(len(text) - length + 1):
            if seen[text[k : k + length]] > 1:
                removed[k : k + length] = True
        spans = sum(1 for k in range(len(text)) if removed[k] and not (k and removed[k - 1]))
        kept = bytes(np.frombuffer(text, dtype=np.uint8)[~removed]) if text else b""
        rows.append((doc_id, len(text), int(removed.sum()), spans, sha256(kept).hexdigest()))
    return sorted(rows, key=str)


def removed(spark, rows, **parameters):
    found = remove_repeats(frame(spark, rows).repartition(5), **parameters)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted(map(tuple, found.collect()), key=str)


def pieced_documents(seed):
    """Texts put together from shared passages, with edits, runs of one letter and whole copies."""
    rng = random.Random(seed)
    letters = "abcdefgh é"
    passages = ["".join(rng.choices(letters, k=rng.randint(5, 60))) for _ in range(12)]
    passages += ["x" * 50, "xy" * 30, "é" * 25]
    rows = []
    for k in range(70):
        parts = [
            rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices(letters, k=rng.randint(1, 40)))
            for _ in range(rng.randint(0, 5))
        ]
        rows.append(document(k, "".join(parts)))
    rows += [document(200 + k, rows[3][1]) for k in range(20)]
    near = rows[5][1]
    rows += [document(300 + k, near[:k] + "#" + near[k:]) for k in range(0, len(near), 7)]
    return rows


@pytest.mark.parametrize(
    "seed,length,gram,kinds",
    [(1, 20, 6, 10_000), (2, 21, 21, 10_000), (3, 30, 1, 10_000), (4, 8, 3, 10_000), (1, 20, 6, 1), (4, 8, 3, 3)],
)
def test_removal_equals_plain_windows(spark, monkeypatch, seed, length, gram, kinds):
    # grams of more kinds of regions than that are parted by shuffles
    monkeypatch.setattr(radix_windows, "KINDS", kinds)
    rows = pieced_documents(seed) + odd_documents()[:4] + odd_documents()[6:]
    want = plain_removal([row[:2] for row in rows], length)
    assert 0 < sum(row[2] for row in want) < sum(row[1] for row in want)
    assert removed(spark, rows, length=length, gram=gram) == want


def test_production_length_on_long_texts(spark):
    rng = random.Random(9)
    base = "".join(rng.choices("abcdefghij klmno", k=3000))
    rows = [
        document(1, base),
        document(2, base[:1500] + "!" + base[1500:]),
        document(3, "q" * 199),
        document(4, "r" * 200),
        document(5, "s" * 201),
        document(6, base[100:299] + "?"),
        document(7, base[100:300] + "?" + base[700:1000]),
        document(8, None),
        *odd_documents(),
    ]
    # the long texts of the odd documents are copies
    want = plain_removal([row[:2] for row in rows if row[0] not in (1004, 1005)], 200)
    got = removed(spark, rows)
    nothing = sha256(b"").hexdigest()
    size = len(odd_documents()[4][1].encode())
    assert [row for row in got if row[0] in (1004, 1005)] == [(k, size, size, 1, nothing) for k in (1004, 1005)]
    assert [row for row in got if row[0] not in (1004, 1005)] == want


def test_small_slices_and_a_full_filter_change_nothing(spark, monkeypatch):
    rows = pieced_documents(6)
    want = plain_removal([row[:2] for row in rows], 20)
    monkeypatch.setattr(radix_windows, "SLICE", 64)
    monkeypatch.setattr(radix_windows, "MOST_CELLS", 1)
    assert removed(spark, rows, length=20, gram=6) == want


def test_equal_windows_choose_the_same_place():
    rng = random.Random(2)
    shared = bytes(rng.choices(b"abc", k=90))
    texts = [bytes(rng.choices(b"abc", k=rng.randint(0, 50))) + shared for _ in range(8)] + [b"a" * 70, b""]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(text) for text in texts])])
    gram, text, first, last = regions(data, offsets, 30, 7)
    chosen = {}
    windows = 0
    for k in range(len(gram)):
        assert offsets[text[k]] <= first[k] <= last[k] <= offsets[text[k] + 1] - 30
        for at in range(first[k], last[k] + 1):
            assert chosen.setdefault(data[at : at + 30].tobytes(), gram[k]) == gram[k]
            windows += 1
    assert windows == sum(max(len(text) - 29, 0) for text in texts)


def test_sorting_in_a_task_finds_what_is_together():
    rng = np.random.default_rng(3)
    for count in (0, 1, 2, 50, 400):
        keys = [rng.integers(0, 9, count), rng.integers(0, 9, count)]
        seen = Counter(zip(*(key.tolist() for key in keys)))
        assert radix_windows.together(keys).tolist() == [seen[pair] > 1 for pair in zip(*(k.tolist() for k in keys))]


def test_a_pass_keeps_what_is_together(spark):
    rows = spark.createDataFrame([(1, 5, 0), (2, 5, 1), (3, 6, 1), (4, 5, 1)], "row long, a long, b long")
    assert sorted(row.row for row in radix_pass(rows, ["a"]).collect()) == [1, 2, 4]
    assert sorted(row.row for row in radix_pass(rows, ["a", "b"]).collect()) == [2, 4]


def test_nothing_to_remove_from(spark):
    assert removed(spark, []) == []
    assert removed(spark, [document(None, None)]) == [(None, 0, 0, 0, sha256(b"").hexdigest())]
