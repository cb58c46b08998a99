"""The pipeline on a small corpus against its stages in plain Python, and its registration."""

import random
from collections import Counter

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tables import document, frame, odd_documents, prose
from test_models import labelled, words_of
from test_similar import plain_components, plain_distance
from test_texts import whole_ids

import __spark_entry__ as contract
from marquee.llm.decontamination import EDITS
from marquee.llm.token_frames import tokenizer_path
from marquee.llm.toxicity_cnn import fit, labelled_sample

ITEMS = [(k, prose(random.Random(90 + k), "en", 25)) for k in range(4)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    rows, labels = labelled(600)
    rows += odd_documents()
    for k in range(30):  # leaks and copies, some with null or repeated ids
        text = prose(rng, "en", 60)
        rows.append(document(2000 + k, f"{text} {ITEMS[k % 4][1]}" if k < 10 else text))
        if k >= 20:
            rows += [document(3000 + k, text), document(None, text), document(2000 + k, text)]
    root = tmp_path_factory.mktemp("corpus")
    docs = frame(spark, rows)
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def stage(spark, name, docs, corpus):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, corpus)


def texts(df):
    return Counter((row.doc_id, row.text) for row in df.select("doc_id", "text").collect())


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "language_id", "near_duplicates", "decontamination", "packing",
    ]


def test_every_stage_does_what_plain_python_does(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    labels = spark.read.parquet(f"{corpus}/labels.parquet")
    columns = docs.columns

    kept = stage(spark, "toxicity", docs, corpus)
    network = fit(labelled_sample(docs, labels))
    rows = docs.select("doc_id", "text").collect()
    scores = network.scores(pa.array([row.text or "" for row in rows]), 0.3)
    assert kept.columns == columns
    assert texts(kept) == Counter((row.doc_id, row.text) for row, s in zip(rows, scores) if s < 0.3 or not (row.text or "").strip())
    truth = {row.doc_id: row.toxic for row in labels.collect()}
    ids = {row.doc_id for row in kept.collect()}
    wrong = sum((k in ids) == bool(toxic) for k, toxic in truth.items())
    assert wrong <= 0.04 * len(truth)

    readable = stage(spark, "language_id", kept, corpus)
    assert readable.columns == columns
    lettered = Counter({k: n for k, n in texts(kept).items() if any(c.isalpha() for c in k[1] or "")})
    assert not texts(readable) - lettered and sum((lettered - texts(readable)).values()) <= 2

    rows = [tuple(row) for row in readable.select("doc_id", "text").collect()]
    single = stage(spark, "near_duplicates", readable, corpus)
    assert single.columns == columns
    # of rows with equal id and text one stays
    want = {row for row, judged in zip(rows, plain_components(rows)) if judged[3]}
    assert texts(single) == Counter(want) and len(want) < len(rows) - 20

    clean = stage(spark, "decontamination", single, corpus)
    assert clean.columns == columns

    def leaks(text):
        words = words_of(text)
        return any(
            len(words) < 5000
            and plain_distance(words_of(item), words) <= int(EDITS * len(words_of(item)))
            for _, item in ITEMS
        )

    assert texts(clean) == Counter({k: n for k, n in texts(single).items() if not leaks(k[1])})
    assert 4 <= single.count() - clean.count() <= 10

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = stage(spark, "packing", clean, corpus)
    sizes = Counter()
    for row in pieces.collect():
        sizes[row.doc_id] += row.length
    want = Counter()
    for (doc_id, text), n in texts(clean).items():
        want[doc_id] += n * len(whole_ids(tokenizer, text))
    assert sizes == want


def test_texts_without_words_stay_whatever_the_network_says(spark, corpus, monkeypatch):
    docs = frame(spark, [document(1, None), document(2, ""), document(3, " \n "), document(4, "word")])
    network = fit(labelled_sample(docs, spark.read.parquet(f"{corpus}/labels.parquet").limit(0)))
    network.base = 9.0
    monkeypatch.setattr(corpus_pipeline, "fit", lambda sample: network)
    assert sorted(row.doc_id for row in stage(spark, "toxicity", docs, corpus).collect()) == [1, 2, 3]


def test_runs_side_by_side_clear_their_own(spark):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    from marquee.llm.common import removing_written, shared, written

    both = Barrier(2, timeout=60)

    def work(number):
        with removing_written(spark):
            table, value = written(spark.range(number), "run"), shared(spark, number)
            both.wait()
            if number == 1:
                return table, value
            both.wait()
            assert (table.count(), value.value) == (2, 2)

    with ThreadPoolExecutor(2) as pool:
        first, second = pool.submit(work, 1), pool.submit(work, 2)
        table, value = first.result()
        both.wait()
        second.result()
    with pytest.raises(Exception):
        table.collect()
    with pytest.raises(Exception):
        value.unpersist()


def test_a_whole_run_equals_its_stages(spark, corpus):
    got = contract.queries()["pipeline"](spark, corpus)
    assert got.columns[:4] == ["doc_id", "start", "length", "ids_crc32"]
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for name, _ in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, name, docs, corpus)
    assert {row.doc_id for row in got.select("doc_id").collect()} == {row.doc_id for row in docs.collect()}


def test_columns_of_clashing_names_and_no_rows(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(40)
    for name in ("predicted", "lang_pred", "text_key", "Score", "_score", "place", "row_number"):
        docs = docs.withColumn(name, F.lit("own")) if name.lower() not in map(str.lower, docs.columns) else docs
    for name, _ in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, name, docs, corpus)
        assert got.columns == docs.columns and got.filter("predicted <> 'own'").count() == 0
        assert stage(spark, name, docs.limit(0), corpus).count() == 0
    assert stage(spark, "packing", docs, corpus).count() > 0
    assert stage(spark, "packing", docs.limit(0), corpus).count() == 0


def test_an_operator_is_registered_for_each_number():
    names = [name for name in contract.queries() if name.startswith("op")]
    assert sorted({int(name[2:].split("_")[0]) for name in names}) == list(range(1, 14)) and len(names) == 13
