"""Context tree, language filters, toxicity and host reputation."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tables import document, frame, odd_documents, prose, some_documents

from marquee.llm import context_tree, language_bloom
from marquee.llm.context_tree import language_model_scores, log_kt, pack, unpack
from marquee.llm.host_reputation import host_posteriors, judge_urls, lower_bound, suffix_and_domain
from marquee.llm.language_bloom import (
    CELLS,
    CELLS_PER_GRAM,
    HASHES,
    identify_languages,
    language_id,
    learn_filter,
    positions,
)
from marquee.llm.queries import op5_host_reputation
from marquee.llm.toxicity_cnn import Network, fit, fit_rows, labelled_rows, labelled_sample, score_documents, toxicity

DOCUMENTS = some_documents() + odd_documents()


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\v\f\r":
        lowered = lowered.replace(space, " ")
    return [word for word in lowered.split(" ") if word]


def remainder(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


# --- context tree ----------------------------------------------------------------------------


class PlainTree:
    """Context tree weighting, node by node, on dictionaries."""

    def __init__(self, texts):
        self.counts = defaultdict(lambda: [0, 0])
        for text in texts:
            for context, bits, bit in self.decisions(text):
                for depth in range(context_tree.DEPTH + 1):
                    self.counts[context[context_tree.DEPTH - depth :], bits][bit] += 1
        self.children = defaultdict(set)
        for context, bits in list(self.counts):
            if context:
                self.children[context[1:], bits].add((context, bits))
        self.log_weighted, self.weight = {}, {}
        for node in sorted(self.counts, key=lambda x: -len(x[0])):
            own = self.log_kt(*self.counts[node])
            below = sum(self.log_weighted[x] for x in self.children[node])
            if len(node[0]) == context_tree.DEPTH:
                self.log_weighted[node] = own
            else:
                self.log_weighted[node] = np.logaddexp(own, below) - math.log(2)
                self.weight[node] = 1 / (1 + math.exp(min(700, below - own)))

    @staticmethod
    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @staticmethod
    def decisions(text):
        data = b"\n" * context_tree.DEPTH + text + b"\n"
        for at in range(context_tree.DEPTH, len(data)):
            for level in range(8):
                yield data[at - context_tree.DEPTH : at], (level, data[at] >> (8 - level)), data[at] >> (7 - level) & 1

    def bits(self, text):
        total = 0.0
        for context, bits, bit in self.decisions(text):
            path = [(context[context_tree.DEPTH - d :], bits) for d in range(context_tree.DEPTH + 1)]
            path = [node for node in path if node in self.counts]
            one = 0.5
            for k, node in enumerate(reversed(path)):
                zeros, ones = self.counts[node]
                own = (ones + 0.5) / (zeros + ones + 1)
                one = own if k == 0 else self.weight[node] * own + (1 - self.weight[node]) * one
            total -= math.log2(one if bit else 1 - one)
        return total


def check_scores(spark, rows):
    got = language_model_scores(frame(spark, rows)).collect()
    learnt = [words_of(row[1]) for row in rows if remainder(row[0], 7) != 2]
    counts = Counter(token for words in learnt for token in [*words, "\n"])
    tokens, distinct = sum(counts.values()), len(counts)
    tree = PlainTree(" ".join(words).encode() for words in learnt)
    want = []
    for row in rows:
        own = [*words_of(row[1]), "\n"]
        base = sum(math.log10((counts[token] + 1) / (tokens + distinct + 1)) for token in own)
        score = -tree.bits(" ".join(own[:-1]).encode()) * math.log10(2)
        known = sum(counts[token] > 0 for token in own)
        want.append(((str(row[0]), remainder(row[0], 7) == 2, len(own), known, tokens), base, score))
    made = sorted(
        ((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens), r.base_score, r.score) for r in got
    )
    want.sort()
    assert [x[0] for x in made] == [x[0] for x in want]
    assert [x[1] for x in made] == pytest.approx([x[1] for x in want], rel=1e-9)
    assert [x[2] for x in made] == pytest.approx([x[2] for x in want], abs=0.01)
    return got


def test_scores_are_those_of_a_plain_context_tree(spark):
    short = [row if len(row[1] or "") < 2000 else document(row[0], row[1][:1500]) for row in DOCUMENTS]
    got = check_scores(spark, short[:40] + short[120:] + short[:3])
    assert len({row.held_out for row in got}) == 2


def test_scores_of_hot_copies_are_as_exact(spark):
    rows = [document(k, "ab cd") for k in range(6000)]
    tree = PlainTree(b"ab cd" for row in rows if remainder(row[0], 7) != 2)
    want = -tree.bits(b"ab cd") * math.log10(2)
    got = {row.score for row in language_model_scores(frame(spark, rows)).collect()}
    assert -0.01 < want < 0 and all(score == pytest.approx(want, rel=1e-5) for score in got)


def test_many_parts_and_rounds_give_the_same_scores(spark, monkeypatch):
    docs = frame(spark, some_documents(count=60)).repartition(6, "doc_id")
    want = {row.doc_id: row.score for row in language_model_scores(docs).collect()}
    monkeypatch.setattr(context_tree, "FAN_IN", 2)
    got = {row.doc_id: row.score for row in language_model_scores(docs).collect()}
    assert got == pytest.approx(want, rel=1e-6)


def test_nothing_to_learn_from_and_nothing_at_all(spark):
    held_out = [document(k, "a b c") for k in range(200) if remainder(k, 7) == 2][:3]
    for row in language_model_scores(frame(spark, held_out)).collect():
        assert row.train_tokens == 0 and row.n_known == 0 and row.bits_per_byte == pytest.approx(8)
    assert language_model_scores(frame(spark, [])).count() == 0


def test_kt_estimates():
    for zeros, ones in ((0, 0), (1, 0), (3, 5), (400, 2), (10**6, 10**5)):
        want = PlainTree.log_kt(zeros, ones)
        assert log_kt(np.array([zeros]), np.array([ones]))[0] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    for size in (0, 1, 1000):
        values = np.sort(rng.integers(0, 2**62, size).astype(np.uint64))
        assert (unpack(pack(values, ascending=True), np.uint64, ascending=True) == values).all()
        assert (unpack(pack(values), np.uint64) == values).all()


# --- languages -------------------------------------------------------------------------------


def test_languages_of_held_out_texts(spark):
    rows = some_documents(count=300)
    truth = {row[0]: row[2] for row in rows}
    got = language_id(frame(spark, rows)).collect()
    assert len(got) == 300
    held_out = [row for row in got if row.held_out]
    assert {row.doc_id for row in held_out} == {k for k in truth if remainder(k, 4) == 2}
    assert sum(row.lang_pred == truth[row.doc_id] for row in held_out) >= 0.97 * len(held_out)
    assert all(0 <= row.score <= 1 for row in got)


def test_odd_texts_have_no_language(spark):
    got = language_id(frame(spark, DOCUMENTS)).collect()
    assert len(got) == len(DOCUMENTS)
    by_id = {row.doc_id: row for row in got}
    for doc_id in (1000, 1001, 1002, 1003):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert by_id[1004].lang_pred == "en"
    nothing = frame(spark, [document(1, "some text", None)])
    assert language_id(nothing).first().lang_pred == "und"
    assert language_id(frame(spark, [])).count() == 0


def plain_ngrams(text):
    low = bytes(
        b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").encode()
    )
    framed = b"   " + low + b"   "
    return [framed[k : k + 4] for k in range(len(framed) - 3) if framed[k : k + 4] != b"    "]


def test_the_filter_returns_all_languages_of_an_ngram(spark):
    rows = some_documents(count=80)
    model = learn_filter(frame(spark, rows))
    counts = defaultdict(Counter)
    for row in rows:
        counts[row[2]].update(plain_ngrams(row[1]))
    totals = {lang: sum(own.values()) for lang, own in counts.items()}
    assert model.languages == sorted(totals, key=lambda x: (-totals[x], x))
    for gram in set().union(*counts.values()):
        rates = {lang: counts[lang][gram] / totals[lang] for lang in totals}
        top = max(rates.values())
        want = {lang for lang, rate in rates.items() if rate >= 0.1 * top}
        value = np.array([int.from_bytes(gram, "big")], dtype=np.uint32)
        mask = np.uint64(2**64 - 1)
        for which in range(HASHES):
            mask &= model.cells[0, positions(value, which)[0]]
        found = {lang for k, lang in enumerate(model.languages) if int(mask) >> k & 1}
        assert want <= found
    assert model.cells.shape == (1, CELLS) and (model.false_positives < 0.01).all()


def plain_identify(model, text):
    """Language and share by counting n-grams one by one."""
    grams = plain_ngrams(text)
    best = (-1.0, 0)
    for k in range(len(model.languages)):
        hits = 0
        for gram in grams:
            value = np.array([int.from_bytes(gram, "big")], dtype=np.uint32)
            cells = [positions(value, which, model.cells.shape[1])[0] for which in range(HASHES)]
            hits += all(int(model.cells[k // 64, cell]) >> k % 64 & 1 for cell in cells)
        false = model.false_positives[k]
        corrected = (hits / max(len(grams), 1) - false) / max(1 - false, 1e-9)
        best = max(best, (corrected, -k))
    return -best[1], min(max(best[0], 0.0), 1.0)


@pytest.mark.parametrize("block", [1 << 20, 37])
def test_popcounts_and_decisions_equal_plain_counting(spark, monkeypatch, block):
    rows = some_documents(count=60) + [document(900, "", None), document(901, "é", None), document(902, "?", None)]
    monkeypatch.setattr(language_bloom, "BLOCK", block)
    model = learn_filter(frame(spark, rows))
    model.false_positives = np.array([0.01, 0.2, 0.03])
    texts = [row[1] for row in rows]
    best, share = model.identify(pa.array(texts))
    for k, text in enumerate(texts):
        want = plain_identify(model, text)
        assert (best[k], round(share[k], 9)) == (want[0], round(want[1], 9)), text
    assert model.identify(pa.array([], pa.string()))[0].tolist() == []


def test_the_filter_grows_with_what_is_learnt(spark, monkeypatch):
    monkeypatch.setattr(language_bloom, "CELLS", 1 << 10)
    rows = some_documents(count=200)
    model = learn_filter(frame(spark, rows))
    most = max(len({gram for row in rows if row[2] == lang for gram in plain_ngrams(row[1])}) for lang in model.languages)
    assert 4 * most <= model.cells.shape[1] < 8 * most or model.cells.shape[1] == 1 << 10
    assert (model.false_positives < 0.15).all()
    # as many cells as allowed: what is met most often stays
    monkeypatch.setattr(language_bloom, "MOST_CELLS", 1 << 11)
    small = learn_filter(frame(spark, rows))
    assert small.cells.shape[1] <= 1 << 11 and (small.false_positives < 0.15).all()
    best, _ = small.identify(pa.array([row[1] for row in rows]))
    right = sum(small.languages[k] == row[2] for k, row in zip(best, rows))
    assert right > 0.9 * len(rows)


@pytest.mark.parametrize("languages", [3, 70])
def test_a_filter_in_parts_holds_all_ngrams(spark, monkeypatch, languages):
    rows = [document(k, *row[1:3]) for k, row in enumerate(some_documents(count=120) + odd_documents())]
    if languages > 64:  # two planes
        rows = [document(k, row[1], f"{row[2]}{k % 70}") for k, row in enumerate(rows[:120])]
    counts = defaultdict(Counter)
    for row in rows:
        if row[1] is not None and row[2] is not None:
            counts[row[2]].update(plain_ngrams(row[1]))
    monkeypatch.setattr(language_bloom, "CELLS", 1 << 8)
    monkeypatch.setattr(language_bloom, "MOST_CELLS", 1 << 10)
    monkeypatch.setattr(language_bloom, "PARTS_SLICE", 5000)
    model = learn_filter(frame(spark, rows))
    count = len(model.parts)
    planes = -(-len(model.languages) // 64)
    assert (len(model.languages) > 64) == (languages > 64)
    assert count > 1 and model.cells.size <= max(1 << 10, planes << 8)
    assert (model.false_positives < 0.15).all()
    totals = {lang: sum(own.values()) for lang, own in counts.items()}
    known = [model.cells_of(part) for part in range(count)]
    for gram in set().union(*counts.values()):
        rates = {lang: own[gram] / totals[lang] for lang, own in counts.items() if totals[lang]}
        value = np.array([int.from_bytes(gram, "big")], dtype=np.uint32)
        cells = known[language_bloom.part_of(value, count)[0]]
        for k, lang in enumerate(model.languages):
            if rates[lang] >= 0.1 * max(rates.values()):
                assert all(int(cells[k // 64, positions(value, h, cells.shape[1])[0]]) >> k % 64 & 1 for h in range(HASHES))
    # tasks count as the driver does, and nearly as with one part
    texts = pa.array([row[1] or "" for row in rows])
    best, share = model.identify(texts)
    want = {row[0]: (model.languages[k], x) for row, k, x in zip(rows, best, share)}
    got = {row.doc_id: (row.lang_pred, row.score) for row in identify_languages(frame(spark, rows), model).collect()}
    assert len(got) == len(want) == len(rows)
    assert all(got[k] == want[k] for k, text, *_ in (x[:2] for x in rows) if any(c.isalpha() for c in text or ""))
    monkeypatch.setattr(language_bloom, "MOST_CELLS", 1 << 24)
    whole = learn_filter(frame(spark, rows))
    assert len(whole.parts) == 1 and whole.cells.shape[1] == count * model.cells.shape[1]
    assert whole.false_positives == pytest.approx(model.false_positives, abs=0.02)
    if languages < 64:
        far = np.array([len(text) > 100 for text in texts.to_pylist()])
        assert (np.abs(whole.identify(texts)[1] - share)[far] < 0.1).all()


def test_two_million_ngrams_leave_few_false_positives():
    rng = np.random.default_rng(4)
    cells = 1 << 23  # what learn_filter takes for them
    grams = rng.choice(2**32, 2_000_000, replace=False).astype(np.uint32)
    bits = np.zeros(cells, dtype=bool)
    for which in range(HASHES):
        bits[positions(grams, which, cells)] = True
    assert CELLS_PER_GRAM * len(grams) <= cells and bits.mean() ** HASHES < 0.15


def test_more_languages_than_bits_of_a_cell(spark):
    rng = random.Random(3)
    letters = [chr(0x4E00 + 50 * k) for k in range(70)]
    rows = [
        document(7 * k + j, " ".join(rng.choice(letter) * 3 for _ in range(40)), f"l{k:02d}")
        for k, letter in enumerate(letters) for j in range(4)
    ]
    model = learn_filter(frame(spark, rows))
    assert len(model.cells) == 2
    got = identify_languages(frame(spark, rows), model, keep=["doc_id", "lang", "score"])
    assert got.columns == ["doc_id", "lang", "lang_pred", "score"]
    assert got.filter("lang <> lang_pred").count() == 0


# --- toxicity --------------------------------------------------------------------------------


def labelled(count, seed=5):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(count):
        lang = rng.choice(["en", "de", "fr"])
        toxic = rng.random() < 0.25
        words = prose(rng, lang, rng.randint(5, 60)).split()
        if toxic:
            words.insert(rng.randint(0, len(words)), rng.choice(["blockhead", "vermin", "Vermin,"]))
        rows.append(document(k, " ".join(words), lang))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_toxic_words_are_learnt(spark):
    rows, labels = labelled(900)
    truth = {k: toxic for k, _, toxic in labels}
    marks = spark.createDataFrame([*labels, (3, 1, None), (None, 1, 1), (10**6, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity(frame(spark, rows + odd_documents()), marks).collect()
    assert len(got) == 900 + len(odd_documents())
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in got)
    held_out = [row for row in got if row.held_out and row.doc_id in truth]
    hits = sum(row.predicted == truth[row.doc_id] for row in held_out)
    assert hits >= 0.95 * len(held_out)
    empty = {row.score for row in got if row.doc_id in (1000, 1001, 1002)}
    assert len(empty) == 1 and empty.pop() < 0.3


def test_only_training_labels_are_learnt_from(spark):
    rows, labels = labelled(300)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sample = labelled_sample(frame(spark, rows), marks)
    assert {remainder(k, 4) for k in sample.doc_id} == {0, 1, 3}
    few = labelled_sample(frame(spark, rows), marks, per_label=10, max_bytes=200)
    assert few.toxic.value_counts().max() <= 10 and few.text.str.encode("utf8").str.len().max() <= 200


def test_labels_without_documents_cost_no_sample(spark):
    rows, labels = labelled(200)
    far = spark.range(10**6, 10**6 + 50_000).selectExpr("id as doc_id", "1 as quality", "cast(id % 2 as int) as toxic")
    own = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    with_far = labelled_sample(frame(spark, rows), own.unionByName(far), per_label=20)
    assert with_far.toxic.value_counts().to_dict() == {0: 20, 1: 20}
    assert with_far.equals(labelled_sample(frame(spark, rows), own, per_label=20))
    with pytest.warns(UserWarning, match="no labelled document"):
        assert not len(labelled_sample(frame(spark, rows), far, per_label=20))


def test_a_repeated_id_is_one_sample(spark):
    docs = spark.range(3000).selectExpr("1L as doc_id", "concat('text ', id) as text", "'en' as lang")
    marks = spark.createDataFrame([(1, 0), (1, 1), (1, 1)], "doc_id long, toxic int")
    sample = labelled_sample(docs, marks, per_label=10)
    assert sample.to_dict("records") == [{"doc_id": 1, "text": "text 0", "toxic": 1, "lang": "en"}]


def test_all_labelled_documents_are_learnt_from(spark, conf, monkeypatch):
    from marquee.llm import toxicity_cnn

    rows, labels = labelled(1500)
    truth = {k: toxic for k, _, toxic in labels}
    # one text longer than a sample takes, in a language that no other text has
    rows.append(document(1503, "zyx " * 15_000 + "vermin", "zz"))
    while remainder(rows[-1][0], 4) == 2:
        rows[-1] = (rows[-1][0] + 1, *rows[-1][1:])
    marks = spark.createDataFrame([*labels, (rows[-1][0], 1, 1)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    # as of more labelled documents than a sample holds
    monkeypatch.setattr(toxicity_cnn.labelled_sample, "__defaults__", (5, 200))
    monkeypatch.setattr(toxicity_cnn.fit_rows, "__defaults__", (*fit_rows.__defaults__[:-1], 0))
    conf("spark.sql.files.maxPartitionBytes", "40000")
    conf("spark.sql.files.openCostInBytes", "1")
    learnt = labelled_rows(docs, marks)
    assert sorted(x.doc_id for x in learnt.collect()) == sorted(k for k, *_ in rows if remainder(k, 4) != 2)
    assert learnt.rdd.getNumPartitions() > 1
    assert "zz" in fit_rows(learnt).languages
    held_out = [row for row in toxicity(docs, marks).collect() if row.held_out]
    assert sum(row.predicted == truth[row.doc_id] for row in held_out) >= 0.95 * len(held_out)


def test_all_passes_are_made_whatever_the_size(spark, monkeypatch):
    from marquee.llm import toxicity_cnn

    rows, labels = labelled(60)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    learnt = labelled_rows(frame(spark, rows), marks)
    made = []
    monkeypatch.setattr(toxicity_cnn, "_one_pass", lambda network, sums, learning, *_: made.append(learning))
    monkeypatch.setattr(toxicity_cnn, "_learn", lambda *_: made.append(None))
    fit(learnt, epochs=3, batch=1000)
    assert made == [None] * 3
    made.clear()
    monkeypatch.setattr(toxicity_cnn.fit_rows, "__defaults__", (*fit_rows.__defaults__[:-1], 0))
    fit(learnt, epochs=3)
    assert len(made) == 3
    fit(learnt)
    assert len(made) == 3 + toxicity_cnn.EPOCHS == 3 + fit.__defaults__[0]
    fit_rows(learnt)
    assert len(made) == 3 + 2 * toxicity_cnn.EPOCHS


def test_words_are_coded_alike_by_run_and_by_batch():
    from marquee.llm.text import Words
    from marquee.llm.toxicity_cnn import PAD, coded_runs, word_codes

    rows, _ = labelled(50)
    odd = ["", "\u00e9 A\x00b", "x\x7fY{z", "  ", "\u00c0B-c_d`e[f]", "\u65e5\u672c 9:A@", "tail"]
    for texts in (pa.array(odd), pa.array(odd)[2:6], pa.array(["", ""]), pa.array([x[1] for x in rows] + odd)):
        hashes, codes, starts = word_codes(texts)
        low = [Words(pa.array(["".join(c if c.isalnum() or ord(c) > 127 else " " for c in x.lower())])) for x in texts.to_pylist()]
        assert np.diff(np.append(starts, len(codes))).tolist() == [len(x.codes) + PAD for x in low]
        runs = list(coded_runs(texts, 3))
        assert len(runs) == -(-len(texts) // 3)
        for at, (own_hashes, own_codes, own_starts) in zip(range(0, len(texts), 3), runs):
            want_hashes, want_codes, want_starts = word_codes(texts[at : at + 3])
            assert own_starts.tolist() == want_starts.tolist()
            real = want_codes < want_hashes.shape[1]
            assert ((own_codes < own_hashes.shape[1]) == real).all()
            assert np.array_equal(own_hashes[:, own_codes[real]], want_hashes[:, want_codes[real]])


def test_the_driver_derives_a_slice_at_a_time(monkeypatch):
    from marquee.llm import toxicity_cnn

    rows, labels = labelled(900)
    texts = {k: f"{text} " * 8 for k, text, *_ in (x[:2] for x in rows)}
    langs = [x[2] for x in rows[:-30]] + [None] * 30
    sample = pd.DataFrame({"text": [texts[x[0]] for x in rows], "toxic": [x[2] for x in labels], "lang": langs})
    assert sample.text.str.len().sum() > 1_000_000
    sizes, plain = [], toxicity_cnn.word_codes
    monkeypatch.setattr(toxicity_cnn, "word_codes", lambda texts: sizes.append(texts.nbytes) or plain(texts))
    sliced = fit(sample, epochs=1)
    assert max(sizes) < 300_000
    monkeypatch.setattr(toxicity_cnn, "LOCAL_SLICE", 1 << 30)
    whole = fit(sample, epochs=1)
    assert sliced.languages == whole.languages == ["de", "en", "fr"]
    assert np.array_equal(sliced.language_weights, whole.language_weights)
    assert sliced.thresholds == pytest.approx(whole.thresholds, abs=1e-4)


def test_the_driver_holds_little_between_passes(spark, tmp_path, monkeypatch):
    import tracemalloc

    from marquee.llm import toxicity_cnn

    rows, labels = labelled(200)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    learnt = labelled_rows(frame(spark, rows), marks)
    held, plain = [], toxicity_cnn._add_changes

    def added(*args):
        held.append(tracemalloc.get_traced_memory())
        plain(*args)

    monkeypatch.setattr(toxicity_cnn, "_add_changes", added)
    tracemalloc.start()
    try:
        fit_rows(learnt, passes=2, local=0)
    finally:
        tracemalloc.stop()
    # the network and its sums are 50 MB; another network is needed for a moment only
    assert len(held) >= 2 and max(now for now, _ in held) < 60e6 and max(most for _, most in held) < 100e6


def test_words_by_language_are_counted_in_tasks(spark):
    from marquee.llm.toxicity_cnn import _counted_languages, _language_counts

    rows = [(k, f"w{k % 7} w{k % 3} x", lang) for k, lang in enumerate(["en", "", None, "de"] * 50)]
    found = _counted_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5))
    want = {lang: _language_counts(pa.array([x[1] for x in rows if x[2] == lang])) for lang in ("en", "", "de")}
    assert found.keys() == want.keys()
    assert all(np.array_equal(found[lang], want[lang]) for lang in want)


def test_no_labels_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity(frame(spark, DOCUMENTS[:5]), none).collect()
    assert [row.predicted for row in got] == [0] * 5
    assert toxicity(frame(spark, []), none).count() == 0
    one = fit(pd.DataFrame({"text": ["bad"], "toxic": [1], "lang": [None]}))
    assert 0 <= one.scores(pa.array(["bad"]), 0.3)[0] <= 1


def test_scores_keep_columns_and_rows(spark):
    docs = frame(spark, DOCUMENTS)
    got = score_documents(docs, Network(), keep=docs.columns, names=("_score", "_predicted"))
    assert got.columns == [*docs.columns, "_score", "_predicted"]
    assert sorted(map(str, got.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))


def test_pooled_responses_equal_a_loop_over_windows():
    network = Network(seed=2)
    from marquee.llm.toxicity_cnn import FILTERS, WIDTHS, word_codes

    texts = ["a bb ccc dddd", "", "x", "a a a a bb"]
    hashes, codes, starts = word_codes(pa.array(texts))
    vectors = network.embedded(hashes)
    want = []
    for k, start in enumerate(starts):
        own = vectors[codes[start : (list(starts) + [len(codes)])[k + 1]]]
        own = np.vstack([own, np.zeros((3, own.shape[1]))])
        pooled = []
        for width in WIDTHS:
            windows = [sum(own[t + j] @ network.filters[width][j] for j in range(width)) for t in range(len(own) - 3)]
            pooled.append(np.max(windows, axis=0) + network.biases[width])
        want.append(np.maximum(np.concatenate(pooled), 0) @ network.out + network.base)
    assert network.logits(hashes, codes, starts) == pytest.approx(want, abs=1e-4)
    assert len(network.out) == FILTERS * len(WIDTHS)


# --- hosts -----------------------------------------------------------------------------------

RULES = [("allow", "org/"), ("block", "bad.org/x"), ("block", "com/de/"), ("allow", "a.com/de/ok")]


def test_rules_and_url_parts(spark):
    urls = {
        1: ("http://Bad.ORG/x/1?q#f", "bad.org", "/x/1", "bad.org/x", "block"),
        2: ("https://sub.bad.org/y", "sub.bad.org", "/y", "org/", "allow"),
        3: ("x://notbad.org/x", "notbad.org", "/x", "org/", "allow"),
        4: ("http://a.com/de/ok/2", "a.com", "/de/ok/2", "a.com/de/ok", "allow"),
        5: ("http://b.com/de/", "b.com", "/de/", "com/de/", "block"),
        6: ("http://b.com?x=/de/", "b.com", "", None, "allow"),
        7: ("no scheme/de/", "", "", None, "allow"),
        8: (None, "", "", None, "allow"),
        9: ("http://a.org", "a.org", "", None, "allow"),
        10: ("a://b://c/d", "b:", "//c/d", None, "allow"),
        11: ("http://ÄB.com/\n/e#", "Äb.com", "/\n/e", None, "allow"),
        12: ("", "", "", None, "allow"),
        13: ("://", "", "", None, "allow"),
    }
    pages = spark.createDataFrame([(k, v[0], "x", "y") for k, v in urls.items()], "page_id long, url string, host string, verdict string")
    nothing = spark.createDataFrame([], "page_id long, bad boolean")
    got = {row.page_id: tuple(row)[1:5] for row in judge_urls(pages, nothing, RULES).collect()}
    assert got == {k: v[1:] for k, v in urls.items()}
    assert judge_urls(pages.limit(0), nothing, RULES).count() == 0


def test_reputation_blocks_bad_hosts_only(spark):
    rng = random.Random(1)
    pages, outcomes = [], []
    for k in range(3000):
        host = rng.choice(["a.good.com", "b.good.com", "spam.bad.net", "junk.bad.net", "c.mixed.org"])
        pages.append((k, f"http://{host}/{k}"))
        rate = 0.9 if "bad" in host else 0.15 if "mixed" in host else 0.02
        if rng.random() < 0.5:
            outcomes.append((k, rng.random() < rate))
    pages += [(5000, "http://new.bad.net/"), (5001, "http://new.good.com/"), (5002, "http://unheard.xyz/"), (5000, "http://new.bad.net/")]
    outcomes += [(None, True), (7, None), (8, True), (8, True)]
    frame_pages = spark.createDataFrame(pages, "page_id long, url string")
    marks = spark.createDataFrame(outcomes, "page_id long, bad boolean")
    got = judge_urls(frame_pages, marks).collect()
    assert len(got) == len(pages)
    verdicts = defaultdict(set)
    for row in got:
        verdicts[row.host].add(row.verdict)
    assert {host for host, found in verdicts.items() if found == {"block"}} == {
        "spam.bad.net", "junk.bad.net", *(["new.bad.net"] if verdicts["new.bad.net"] == {"block"} else []),
    }
    assert verdicts["a.good.com"] == verdicts["new.good.com"] == verdicts["unheard.xyz"] == {"allow"}


def test_a_hosts_rate_lies_between_its_own_and_its_domains(spark):
    counts = [("a.x.com", 1, 1), ("b.x.com", 100, 2), ("c.x.com", 80, 3), ("d.y.com", 100, 60), ("e.y.com", 0, 0), ("f.z.com", 90, 70)]
    got = {r.host: r for r in host_posteriors(spark.createDataFrame(counts, "host string, n long, bad long")).collect()}
    rate = {host: row.alpha / (row.alpha + row.beta) for host, row in got.items()}
    assert rate["b.x.com"] < rate["a.x.com"] < 1.0
    assert rate["a.x.com"] < rate["e.y.com"] and abs(rate["e.y.com"] - 0.6) < 0.2
    bound = spark.range(1).select(lower_bound(F.lit(2.0), F.lit(2.0), 1.64), lower_bound(F.lit(0.1), F.lit(5.0), 5.0)).first()
    assert 0 < bound[0] < 0.5 and bound[1] == 0


def test_longer_suffixes(spark):
    hosts = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("x.uk",), ("uk",), ("",)], "host string")
    parts = suffix_and_domain(F.col("host"), ["co.uk"])
    got = [tuple(row) for row in hosts.select(*parts).collect()]
    assert got == [("co.uk", "b.co.uk"), ("co.uk", "co.uk"), ("uk", "x.uk"), ("uk", "uk"), ("", "")]


def test_ports_and_addresses(spark):
    names = ["a.b.com:8080", "b.com:", "10.0.0.1", "10.0.0.1:80", "[::1]:443", "1.2.3.com"]
    hosts = spark.createDataFrame([(name,) for name in names], "host string")
    got = [tuple(row) for row in hosts.select(*suffix_and_domain(F.col("host"))).collect()]
    assert got == [
        ("com", "b.com"), ("com", "b.com"), ("[ip]", "10.0.0.1"), ("[ip]", "10.0.0.1"), ("[ip]", "[::1]"), ("com", "3.com")
    ]


def test_the_query_tells_domains_under_double_suffixes_apart(spark, tmp_path):
    pages = [(k, f"http://www.{name}.co.uk/{k}", "") for k, name in enumerate(["bad"] * 300 + ["good"] * 300)]
    pages += [(600, "http://new.bad.co.uk/", ""), (601, "http://new.good.co.uk/", "")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    labels = [(k, 1, int(k < 300)) for k in range(600)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {row.page_id: row.verdict for row in op5_host_reputation(spark, str(tmp_path)).collect()}
    assert (got[0], got[300], got[600], got[601]) == ("block", "allow", "block", "allow")


def test_sql_knows_suffixes_ports_and_addresses(spark, tmp_path):
    import duckdb

    from marquee.llm.oracles import OP5

    hosts = ["a.co.uk", "www.a.co.uk", "co.uk", "b.com:8080", "B.com", "x.b.com", "10.1.2.3", "10.1.2.3:81", "[::1]",
             "localhost", "", "c.org", "d.example.org", "e.gov.uk:", "f.f.f.com.au"]
    rng = random.Random(4)
    pages = [(k, f"http://{rng.choice(hosts)}/{rng.choice(['es/', 'de/1', ''])}{k}", "") for k in range(900)]
    pages += [(900, None, None), (901, "no scheme", "")]
    labels = [(k, rng.randint(0, 1), int(rng.random() < 0.4)) for k in range(0, 900, 2)]
    connection = duckdb.connect()
    for name, rows, schema in (("pages", pages, "page_id long, url string, html string"),
                               ("labels", labels, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        connection.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    got = sorted(map(tuple, op5_host_reputation(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(connection.sql(OP5).fetchall(), key=str) and len({row[-1] for row in got}) == 2
