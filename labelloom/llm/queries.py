"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import bpe_tree, chosen_path, chunk_dedup, exact_dedup, host_quality, langid, license_scan, packing, spelling, token_alignment, toxicity, vector_graph, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_quality.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.similar(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: the source is the top directory, the language the one below."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.concat(F.col("doc_id"), F.lit(".txt")))
    return license_scan.licenses(docs.select("doc_id", path.alias("path"), "text"), "path", "text")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language(table(spark, sf_dir, "documents"))


def op9_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_tree.round_trip_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op10_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = chunk_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    return passages.selectExpr(
        "doc_id", "first_id as first_doc_id", "start_byte", "end_byte", "n_words", "size(cuts) > 0 as removed"
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_vectors(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.alignment(table(spark, sf_dir, "documents"), *paths)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_host_quality": op2_host_quality,
        "op3_chosen_path": op3_chosen_path,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_packing": op5_packing,
        "op6_warc": op6_warc,
        "op7_license_scan": op7_license_scan,
        "op8_langid": op8_langid,
        "op9_bpe_tree": op9_bpe_tree,
        "op10_chunk_dedup": op10_chunk_dedup,
        "op11_spelling": op11_spelling,
        "op12_vector_graph": op12_vector_graph,
        "op13_token_alignment": op13_token_alignment,
    }
