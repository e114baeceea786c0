"""A corpus from raw documents to packed training sequences.

Each stage takes what the one before it wrote and decides on narrow tables, rows
being told apart by their place in the files; the texts themselves are read,
sifted or cut where they lie. Stages keep all columns; the last one gives pieces
in place of documents.

Defined results for odd input: null and empty texts fail the base rules and go
in the first stage; rows of a null host are judged as those of the host ''; of
rows that repeat an id each is judged, kept and packed for itself; rows with a
null id take no part in near duplicates and repeated passages and stay; an empty
table gives an empty result.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import chosen_path, chunk_dedup, exact_dedup, host_quality, packing
from labelloom.operators.pin import remove, shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break the base rules, or a soft rule that their host breaks as a habit, go."""
    return host_quality.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similar ones link, however far, the one with the smallest id stays."""
    return chosen_path.keep_one(docs)


def substring_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of passages that repeat across documents, the copy under the smallest id stays in its text."""
    return chunk_dedup.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each remaining document lies in the training sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_duplicates),
    ("best-fit packing", packed_sequences),
]

#: Similarity joins and tokenizers aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to the shared folder and read by the next, and then deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        if number:
            remove(spark, f"{folder}/{number - 1}")
    return docs
