"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each level looks only at what the level before left ambiguous. The first scan
turns a text into its length and a hash of its first characters; a text whose
length, or length and prefix, nobody shares is unique and is not read again.
The second scan reads the whole texts of the survivors alone and hashes them.

Texts are equal when identical after every run of ASCII white space becomes one
space. Defined results for odd input: a null text counts as empty; empty texts
are equal to each other; rows that repeat an id count as separate rows, and those
that repeat id and text are marked alike, but one of them stays when duplicates
are dropped; a null id is an id of its own, beaten by any other; an empty
table gives an empty result. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.shared import ROW, among, attach, numbered, without
from labelloom.operators.pin import settle, settle_alone

#: Characters hashed at the second level.
PREFIX_CHARS = 128


def normalised(text: Column) -> Column:
    """Null as empty; each run of white space as one space. Runs that already are one space aren't touched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def digest(text: Column) -> Column:
    """Hexadecimal SHA-256 of the normalised text in UTF-8."""
    return F.sha2(normalised(text).cast("binary"), 256)


def survivors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids of the rows that share length and prefix hash with another row."""
    text = normalised(F.col(text_col))
    cheap = settle(
        docs.select(
            F.col(id_col).alias("id"),
            F.length(text).alias("n_chars"),
            F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix"),
        )
    )
    prefixes = cheap.groupBy("n_chars", "prefix").agg(F.count(F.lit(1)).alias("n"))
    lengths = prefixes.groupBy("n_chars").agg(F.sum("n").alias("n_length")).where("n_length > 1").select("n_chars")
    shared = settle(
        prefixes.join(lengths, "n_chars", "left_semi")
        .where("n > 1")
        .select(F.struct("n_chars", "prefix").alias("key"), "n")
    )
    rows = cheap.select("id", F.struct("n_chars", "prefix").alias("key"))
    return attach(rows, shared, "key", "n", cheap.count()).where("n is not null").select("id")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text that occurs twice or more: ``text_sha256, keep_id, group_size``.

    The rows of the survivors are picked out where they are read; counts and
    smallest ids of a digest are combined in each task before the shuffle.
    """
    rows = numbered(docs)
    full = among(rows, settle(survivors(rows, ROW, text_col).withColumnRenamed("id", ROW)))
    return (
        full.select(F.col(id_col).alias("doc"), digest(F.col(text_col)).alias("text_sha256"))
        .groupBy("text_sha256")
        .agg(F.min("doc").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, keep_id, group_size, kept, text_sha256``.

    The digest of every text, also of the unique ones, is part of this result;
    it is computed where the text lies and only digests are shuffled.
    """
    digests = settle(docs.select(F.col(id_col), digest(F.col(text_col)).alias("text_sha256")))
    groups = settle(duplicate_groups(docs, id_col, text_col))
    found = attach(digests, groups, "text_sha256", "group_size", digests.count())
    alone = F.col("group_size").isNull()
    return found.select(
        id_col,
        F.when(alone, F.col(id_col)).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col(id_col).eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each text, of those with the smallest id; all columns stay.

    Rows are told apart by a number of their own, as an id may stand for several texts.
    """
    rows = numbered(docs)

    def repeated() -> DataFrame:
        found = among(rows, settle(survivors(rows, ROW, text_col).withColumnRenamed("id", ROW)))
        digests = settle(found.select(ROW, F.col(id_col).alias("doc"), digest(F.col(text_col)).alias("text_sha256")))
        first = F.min(F.struct(F.col("doc").isNull().alias("unknown"), "doc", ROW)).alias("first")
        kept = digests.groupBy("text_sha256").agg(first).select(F.col(f"first.{ROW}").alias(ROW))
        return digests.select(ROW).join(kept, ROW, "left_anti")

    return without(rows, settle_alone(repeated)).select(*docs.columns)
