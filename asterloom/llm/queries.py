"""One query per operator over the test tables: each applies it to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterloom.llm.chunks import small_batches
from asterloom.llm.decontaminate import find_benchmark
from asterloom.llm.digest import edited_fingerprints
from asterloom.llm.html_text import extract_text
from asterloom.llm.infill import fill_in_middle, restore_texts
from asterloom.llm.language import held_out, identify, learn
from asterloom.llm import toxicity
from asterloom.llm.multi_index import nearest_neighbours
from asterloom.llm.oracle import ORACLE_SQL  # noqa: F401
from asterloom.llm.packing import pack
from asterloom.llm.phrases import collocations
from asterloom.llm.simhash import near_duplicates
from asterloom.llm.substring_dedup import remove_repeated_windows
from asterloom.llm.suffix_dedup import remove_earlier_strings
from asterloom.llm.warc import archive_pages


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op2_concat_and_cut_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = archive_pages(_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_windows(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


#: The label columns and the values that mean yes, in the order of the chain.
CATEGORIES = {"low_quality": ("quality", 0), "toxic": ("toxic", 1)}


def op6_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return toxicity.classify(docs, toxicity.learn(docs, labels, CATEGORIES), list(CATEGORIES))


def op7_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    out = find_benchmark(docs, _table(spark, sf_dir, "benchmark", "item_id", "text"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_earlier_strings(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_tag_path_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = fill_in_middle(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return restore_texts(examples).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op12_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents", "text", "lang"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_cnn_language": op1_byte_cnn_language,
    "op2_concat_and_cut_packing": op2_concat_and_cut_packing,
    "op3_warc_capture_index": op3_warc_capture_index,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_toxicity_chain": op6_toxicity_chain,
    "op7_fm_index_decontamination": op7_fm_index_decontamination,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_quartile_digest": op9_quartile_digest,
    "op10_tag_path_extraction": op10_tag_path_extraction,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_inverted_multi_index": op12_inverted_multi_index,
    "op13_phrase_automata": op13_phrase_automata,
}
