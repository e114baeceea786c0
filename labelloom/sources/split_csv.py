"""CSV with line breaks inside quotes, one file read by many tasks.

Spark cuts a text file into ranges at ends of lines, and a line may lie inside a
quoted field. Whether it does follows from the quotes before it: an even number
of them, doubled ones counting twice, and a record begins. So a first pass gives
out, for every range, how many quotes it has and how many records begin in it if
an even or an odd number of quotes stands before. Sums over the ranges of a file,
one row per range, then fix where each range stands and the number of its first
record. The second pass puts lines together to records, in the task that reads
them; only records that lie across ranges have their parts brought together.

Lines end with a line feed, with or without a carriage return in front; line
breaks inside quotes stay as they are. Quotes have to be balanced as the format
demands: a quote inside a field that isn't quoted shifts what follows it, which
the reader of whole files forgives.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelloom.operators.pin import settle

#: Encodings in which a byte of a line break or quote is never part of another character.
ASCII_LIKE = {"UTF-8", "UTF8", "US-ASCII", "ASCII", "ISO-8859-1", "LATIN1", "ISO-8859-15", "WINDOWS-1252", "CP1252"}

#: Ranges whose places are broadcast at most; more are joined as Spark chooses.
MAX_BROADCAST_RANGES = 200_000


def can_split(encoding: str) -> bool:
    return encoding.upper() in ASCII_LIKE


def lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """``file, start, line, quotes, blank``: the lines of all files with the range they were read in."""
    raw = spark.read.option("lineSep", "\n").text(path)
    line = F.col("value")
    if encoding.upper() not in ("UTF-8", "UTF8"):
        line = F.decode(line.cast("binary"), encoding)
    found = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), line.alias("line"))
    return found.withColumns({"quotes": _quotes(F.col("line")), "blank": F.col("line").isin("", "\r")})


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _segments(batch: pa.RecordBatch, *keys: str) -> Iterator[pa.RecordBatch]:
    """``batch`` cut where one of ``keys`` changes."""
    n = len(batch)
    if not n:
        return
    changed = np.zeros(n - 1, bool)
    for key in keys:
        column = batch.column(key)
        changed |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    bounds = [0, *(np.flatnonzero(changed) + 1).tolist(), n]
    for at, end in zip(bounds, bounds[1:], strict=False):
        yield batch.slice(at, end - at)


def _inside(segment: pa.RecordBatch, before: int) -> np.ndarray:
    """Whether each line begins inside quotes, given the quotes ``before`` the first one."""
    quotes = segment.column("quotes").to_numpy().astype(np.int64)
    return ((before + np.cumsum(quotes) - quotes) & 1).astype(bool)


def range_summaries(found: DataFrame) -> DataFrame:
    """``file, start, quotes, begun_even, begun_odd``: one row per range and task."""

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, [0, 0, 0]
        for batch in batches:
            for segment in _segments(batch, "file", "start"):
                here = segment.column("file")[0].as_py(), segment.column("start")[0].as_py()
                if here != key:
                    if key:
                        yield _summary(key, total)
                    key, total = here, [0, 0, 0]
                text = ~segment.column("blank").to_numpy(zero_copy_only=False)
                inside = _inside(segment, total[0])
                total[1] += int((text & ~inside).sum())
                total[2] += int((text & inside).sum())
                total[0] += int(segment.column("quotes").to_numpy().sum())
        if key:
            yield _summary(key, total)

    return found.select("file", "start", "quotes", "blank").mapInArrow(
        summarize, "file string, start long, quotes long, begun_even long, begun_odd long"
    )


def _summary(key: tuple[str, int], total: list[int]) -> pa.RecordBatch:
    names = ["file", "start", "quotes", "begun_even", "begun_odd"]
    return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, *total)], names)


def range_places(summaries: DataFrame) -> DataFrame:
    """``file, start, number, odd, first``: the file's number, the quotes before the range modulo 2, its first record's number.

    The windows run over one row per range of a file, and one per file.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int")
    placed = summaries.withColumn("odd", odd)
    begun = F.when(F.col("odd") == 1, F.col("begun_odd")).otherwise(F.col("begun_even"))
    placed = placed.withColumn("begun", begun).withColumn("first", F.coalesce(F.sum("begun").over(before), F.lit(0)))
    numbers = placed.select("file").distinct()
    numbers = numbers.withColumn("number", (F.row_number().over(Window.orderBy("file")) - 1).cast("long"))
    return placed.join(numbers, "file").select("file", "start", "number", "odd", "first")


def record_parts(placed: DataFrame) -> DataFrame:
    """``number, record, start, whole, text``: records, and the parts in this range of those that lie across ranges."""

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_ = _Range(-1, -1, 0, 0)
        for batch in batches:
            for segment in _segments(batch, "number", "start"):
                number, start, odd, first = (segment.column(c)[0].as_py() for c in ("number", "start", "odd", "first"))
                if (number, start) != (range_.number, range_.start):
                    yield from range_.rest()
                    range_ = _Range(number, start, odd, first)
                yield from range_.add(segment)
        yield from range_.rest()

    return placed.select("number", "start", "odd", "first", "quotes", "blank", "line").mapInArrow(
        put_together, "number long, record long, start long, whole boolean, text string"
    )


class _Range:
    """Puts the lines of a range together; holds back the last record, which may go on."""

    def __init__(self, number: int, start: int, quotes: int, first: int):
        self.number, self.start = number, start
        self._quotes, self._next = quotes, first
        self._open: tuple[int, bool, list[str]] | None = None

    def add(self, segment: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        inside = _inside(segment, self._quotes)
        kept = inside | ~segment.column("blank").to_numpy(zero_copy_only=False)
        self._quotes += int(segment.column("quotes").to_numpy().sum())
        inside, texts = inside[kept], segment.column("line").filter(pa.array(kept))
        if not len(texts):
            return
        records = self._next + np.cumsum(~inside) - 1
        self._next += int((~inside).sum())
        heads = np.concatenate(([0], np.flatnonzero(records[1:] != records[:-1]) + 1))
        bounds = np.append(heads, len(texts)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), texts), "\n")
        records, begins = records[heads], ~inside[heads]
        if self._open:
            if records[0] == self._open[0]:
                self._open[2].append(joined[0].as_py())
                records, begins, joined = records[1:], begins[1:], joined.slice(1)
            if len(records):
                yield self._row()
        if len(records):
            # All but the last are closed, as another record begins behind them.
            last = len(records) - 1
            if last:
                yield self._rows(records[:last], begins[:last], joined.slice(0, last))
            self._open = int(records[last]), bool(begins[last]), [joined[last].as_py()]

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self._open:
            yield self._row()

    def _row(self) -> pa.RecordBatch:
        record, begins, texts = self._open
        self._open = None
        return self._rows(np.array([record]), np.array([begins]), pa.array(["\n".join(texts)], pa.string()), closed=self._quotes % 2 == 0)

    def _rows(self, records: np.ndarray, whole: np.ndarray, texts: pa.Array, closed: bool = True) -> pa.RecordBatch:
        n = len(records)
        columns = [pa.array(np.full(n, self.number)), pa.array(records.astype(np.int64)), pa.array(np.full(n, self.start)), pa.array(whole & closed), texts]
        return pa.RecordBatch.from_arrays(columns, ["number", "record", "start", "whole", "text"])


def partition_value(file: Column, name: str) -> Column:
    """What a file's path says for a partition column; null for Spark's name of null."""
    raw = F.regexp_extract(file, f"/{name}=([^/]*)/", 1)
    # Spark escapes a folder's name, and its path once more.
    once = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    value = F.url_decode(F.replace(once, F.lit("+"), F.lit("%2B")))
    return F.when(value != "__HIVE_DEFAULT_PARTITION__", value)


def records(spark: SparkSession, path: str, encoding: str = "UTF-8", partitions: Sequence[str] = ()) -> DataFrame:
    """``number, record, text`` and the columns in ``partitions``, which paths give: the records of all files, header included.

    Files are numbered by name, records in their file.
    """
    found = lines(spark, path, encoding)
    places = settle(range_places(settle(range_summaries(found))))
    text = _texts(found, places)
    if not partitions:
        return text
    # One row per file.
    files = places.select("number", "file").distinct()
    return text.join(files.select("number", *[partition_value(F.col("file"), name).alias(name) for name in partitions]), "number")


def _texts(found: DataFrame, places: DataFrame) -> DataFrame:
    if places.count() <= MAX_BROADCAST_RANGES:
        places = F.broadcast(places)
    parts = record_parts(found.join(places, ["file", "start"]))
    whole = parts.where("whole").select("number", "record", "text")
    # A record is as long as one row of the table, however many ranges it lies across.
    across = parts.where("not whole").groupBy("number", "record").agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("parts"))
    across = across.select("number", "record", F.array_join("parts.text", "\n").alias("text"))
    text = F.when(F.endswith("text", F.lit("\r")), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    return whole.unionByName(across).withColumn("text", text)
