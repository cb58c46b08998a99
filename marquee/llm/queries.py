"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.bag_search import search
from marquee.llm.chosen_path import near_duplicates
from marquee.llm.common import table
from marquee.llm.context_tree import language_model_scores
from marquee.llm.decontamination import contaminated
from marquee.llm.feistel_shards import shard_rows
from marquee.llm.host_reputation import judge_urls
from marquee.llm.language_bloom import language_id
from marquee.llm.multi_index import nearest
from marquee.llm.phrase_graph import phrases
from marquee.llm.radix_windows import remove_repeats
from marquee.llm.suffixes import DOUBLE_SUFFIXES
from marquee.llm.token_frames import scratch_uri, token_file_digests, tokenizer_path, write_token_files
from marquee.llm.toxicity_cnn import toxicity
from marquee.llm.window_packing import pack_documents

# The id that ends a document, in files and in windows.
END_ID = 2

# Verdict, and host with path.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code lengths of all documents."""
    return language_model_scores(table(spark, sf_dir, "documents"))


def op2_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to files of frames and read back."""
    docs = table(spark, sf_dir, "documents")
    files = write_token_files(docs, scratch_uri(spark, "tokens"), tokenizer_path(), END_ID)
    return token_file_digests(files)


def op3_language_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    return language_id(table(spark, sf_dir, "documents"))


def op4_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items of any length in all documents."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page urls; labels of equal id are the outcomes hosts are judged by."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad")
    )
    judged = judge_urls(table(spark, sf_dir, "pages"), outcomes, RULES, double_suffixes=DOUBLE_SUFFIXES)
    return judged.drop("bad_bound")


def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return nearest(table(spark, sf_dir, "embeddings"))


def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards whose row counts differ by one at most."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    sharded = shard_rows(rows, ["doc_id", "text_crc32", "size"], 8, seed=8)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


def op9_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def op10_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of every language in all documents."""
    return phrases(table(spark, sf_dir, "documents"))


def op13_radix_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the strings of 200 bytes that they repeat."""
    return remove_repeats(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_context_tree": op1_context_tree,
    "op2_token_frames": op2_token_frames,
    "op3_language_bloom": op3_language_bloom,
    "op4_edit_decontamination": op4_edit_decontamination,
    "op5_host_reputation": op5_host_reputation,
    "op6_chosen_path": op6_chosen_path,
    "op7_multi_index": op7_multi_index,
    "op8_feistel_shards": op8_feistel_shards,
    "op9_window_packing": op9_window_packing,
    "op10_toxicity_cnn": op10_toxicity_cnn,
    "op11_bag_search": op11_bag_search,
    "op12_phrase_graph": op12_phrase_graph,
    "op13_radix_windows": op13_radix_windows,
}
