"""What several operators of this subpackage need."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.operators import bloom
from labelloom.operators.pin import pin, settle

#: ASCII white space, the only separator of words here.
SPACE = r"[\x20\x09-\x0D]"

#: A key is hot when it holds more than this share of the rows; fewer than 1 / HOT_SHARE keys can.
HOT_SHARE = 1 / 1000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


#: A row's own number, see :func:`numbered`.
ROW = "_row_number"

#: Bits for a row's place in its file.
PLACE_BITS = 36

#: Rows that are broadcast to filter others by them, at most; beyond that a Bloom filter is.
MAX_LISTED = 200_000


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number ``ROW`` of its own for each row.

    Rows read from Parquet files have one from the number of their file and
    their place in it, whatever tasks read them. Others are written with it.
    """
    try:
        places = docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return settle(docs.withColumn(ROW, F.monotonically_increasing_id()))
    # One row per file.
    files = places.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    files = pin(files.select("file_path", (F.row_number().over(Window.orderBy("file_path")) - 1).cast("long").alias("_file_number")))
    files = files.withColumnRenamed("file_path", "_file_path")
    place = F.shiftleft("_file_number", PLACE_BITS) + F.col("_row_place")
    located = docs.select("*", F.col("_metadata.file_path").alias("_file_path"), F.col("_metadata.row_index").alias("_row_place"))
    return located.join(files, "_file_path").select(*[located[c] for c in docs.columns], place.alias(ROW))


def without(rows: DataFrame, dropped: DataFrame, key: str = ROW) -> DataFrame:
    """``rows`` whose ``key`` isn't in ``dropped``, a settled frame of that column. Keys aren't null.

    Few keys are broadcast. Of more a Bloom filter is, and only the rows that it
    can't rule out are shuffled to compare them exactly.
    """
    return _sifted(rows, dropped, key, "left_anti")


def among(rows: DataFrame, wanted: DataFrame, key: str = ROW) -> DataFrame:
    """``rows`` whose ``key`` is in ``wanted``, found as :func:`without` does."""
    return _sifted(rows, wanted, key, "left_semi")


def with_few(rows: DataFrame, table: DataFrame, key: str = ROW, max_listed: int | None = None) -> DataFrame:
    """``rows`` with the columns of the settled ``table``, which has one row for few of the keys; nulls for the others."""
    return _sifted(rows, table, key, "left", max_listed)


def _sifted(rows: DataFrame, listed: DataFrame, key: str, how: str, max_listed: int | None = None) -> DataFrame:
    if listed.count() <= (MAX_LISTED if max_listed is None else max_listed):
        return rows.join(F.broadcast(listed), key, how)
    marked = bloom.possible(rows, F.col(key), bloom.bloom_filter(listed, key))
    compared = marked.where("bloom_hit").drop("bloom_hit").join(listed, key, how)
    if how == "left_semi":
        return compared
    return marked.where("not bloom_hit").drop("bloom_hit").unionByName(compared, allowMissingColumns=True)


def attach(rows: DataFrame, table: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per ``key``; nulls where it has none.

    ``size`` is the column of ``table`` that counts the rows of a key, ``total``
    bounds their sum. Keys with more than a thousandth of ``total`` are at most
    a thousand; their line of ``table`` is broadcast and their rows stay where
    they are. Only the others are shuffled, so no task gets one key's bulk.
    ``rows`` and ``table`` are read twice and should be settled. Keys aren't null.
    """
    is_hot = F.col(size) > F.lit(total * HOT_SHARE)
    hot = F.broadcast(table.where(is_hot))
    usual = table.where(~is_hot)
    from_hot = rows.join(hot, key)
    from_usual = rows.join(hot.select(key), key, "left_anti").join(usual, key, "left")
    return from_hot.unionByName(from_usual)
