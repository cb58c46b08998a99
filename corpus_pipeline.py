"""A corpus pipeline: toxic documents, unreadable ones, near copies and benchmark leaks go, and what
stays is packed.

Each stage calls one operator of ``marquee.llm`` on all documents that its predecessor kept. Its
result is written as Parquet below the shared scratch folder and read again as the next one's
documents. All stages but the last return the columns of their documents, whatever else they hold.

Rows are told apart by id and text, not by id alone: null and repeated ids have a defined result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.chosen_path import near_duplicates
from marquee.llm.common import fresh, removing_written, table, training_part, written
from marquee.llm.decontamination import contaminated
from marquee.llm.language_bloom import UNKNOWN, identify_languages, learn_filter
from marquee.llm.queries import END_ID
from marquee.llm.token_frames import tokenizer_path
from marquee.llm.toxicity_cnn import fit, labelled_rows, score_documents
from marquee.llm.window_packing import pack_documents
from marquee.scratch import remove_folder, scratch_root

# A text is in a language if that share of its n-grams is: prose has nearly all of them.
READABLE = 0.4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labelled ones of them, does not call toxic.

    Texts without a word, null and empty ones among them, stay whatever the classifier makes of nothing;
    equal texts share their fate.
    """
    network = fit(labelled_rows(docs, table(spark, sf_dir, "labels")))
    score, predicted = fresh(docs, "score", "predicted")
    scored = score_documents(docs, network, keep=docs.columns, names=(score, predicted))
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"\S")
    return scored.filter((F.col(predicted) == 0) | wordless).select(*docs.columns)


def drop_unreadable(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is learned from the others.

    Texts that are null or without a letter go, as do those of whose n-grams too few are of any
    language. If no document has a language, nothing can be learned and none goes.
    """
    model = learn_filter(docs.filter(training_part("doc_id", 4, 2)))
    if not model.languages:
        return docs
    lang, score = fresh(docs, "lang_pred", "score")
    found = identify_languages(docs, model, keep=docs.columns, names=(lang, score))
    return found.filter((F.col(lang) != UNKNOWN) & (F.col(score) >= READABLE)).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of least id.

    Null and empty texts are no copies of anything. Of rows with equal id and text one
    stays. A null id counts as larger than all; near but not equal copies that all have null ids stay.
    """
    (key,) = fresh(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    judged = near_duplicates(keyed, carry=[key])
    kept = written(judged.filter("kept").groupBy("doc_id", key).agg(F.count("*").alias("rows")), "kept")

    def chosen(rows: DataFrame) -> DataFrame:
        ids = rows.select(F.col("doc_id").alias("kept_id"), F.col(key).alias("kept_key"))
        same = keyed["doc_id"].eqNullSafe(ids["kept_id"]) & (keyed[key] == ids["kept_key"])
        return keyed.join(ids, same, "left_semi")

    once = chosen(kept.filter("rows = 1"))
    repeated = chosen(kept.filter("rows > 1")).dropDuplicates(["doc_id", key])
    return once.unionByName(repeated).select(*docs.columns)


# A benchmark item of so many words or more is a leak. At 1 every item is; a benchmark that has single common
# words as items wants more.
LEAK_WORDS = 1


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item of ``LEAK_WORDS`` words or more. Null and empty texts hold none;
    equal texts share their fate."""
    (key,) = fresh(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    texts = keyed.select(F.col(key).alias("doc_id"), "text")
    found = contaminated(texts, table(spark, sf_dir, "benchmark")).filter(F.col("item_words") >= LEAK_WORDS)
    # as a table its size is known before the join is planned, so few leaks move no documents
    leaks = written(found.select(F.col("doc_id").alias(key)).distinct(), "leaks")
    return keyed.join(leaks, key, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in windows; null and empty texts are an end id each."""
    return pack_documents(docs, tokenizer_path(), END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unreadable),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# Trained models and a tokenizer are beyond SQL; the tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage leaves in the scratch folder goes when the next
    one has read it; the table behind the returned frame stays."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_root(spark, f"pipeline-{name}")
        with removing_written(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
