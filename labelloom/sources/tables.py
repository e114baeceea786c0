"""Reading and writing labelled-text tables and reports."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.operators.pin import pin
from labelloom.operators.validate import assert_order_identifies_rows, assert_unique_texts, require_columns
from labelloom.roles import Roles
from labelloom.sources import commit, split_csv

# Reads as null; a character that no text field holds, so that "" stays a text.
NO_TEXT = "\x00"
DEFAULT_SCHEMA = "text string, label string"

#: Bits for a row's position in its file, as many as Spark numbers the rows of a task with.
ROWS_BITS = 33

#: Lines of a report that is put together on the driver.
MAX_DOCUMENT_LINES = 100_000


def _found(load, path: str) -> DataFrame:
    """Run a reader, turning Spark's path error into ``FileNotFoundError``."""
    try:
        commit.restore(SparkSession.active(), path)
        return load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such table: {path}") from error
        raise


def _not_empty(df: DataFrame, path: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"table is empty: {path}")
    return df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType = DEFAULT_SCHEMA,
    encoding: str = "UTF-8",
    null_value: str | None = None,
    order_column: str | None = None,
    whole_files: bool = False,
) -> DataFrame:
    """A CSV table with a header and standard quoting, including line breaks inside quotes.

    An empty field is null and a quoted empty field is an empty text;
    ``null_value`` names one more spelling of null. Columns are matched to the
    header by name; a declared column the header lacks is an error. Large files
    are read by many tasks, see :mod:`split_csv`. ``whole_files`` makes one file
    one task instead, as is done for encodings whose bytes can't be told apart;
    it forgives quotes inside fields that aren't quoted.

    ``order_column`` names a column for the place of a row, which files of this
    kind don't have: their number in the order of their names, and the row's
    position in its file, as one long. It is the same in every run.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)

    options = {"quote": '"', "escape": '"', "nullValue": NO_TEXT if null_value is None else null_value}

    def load(p: str) -> DataFrame:
        return spark.read.options(header=True, multiLine=True, encoding=encoding, **options).csv(p)

    raw = _found(load, path)
    if not raw.columns:
        raise ValueError(f"table is empty: {path}")
    require_columns(raw, *schema.fieldNames())
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    if not whole_files and split_csv.can_split(encoding):
        return _not_empty(_from_records(spark, path, raw.schema, columns, encoding, options, order_column), path)
    if order_column is None or order_column in schema.fieldNames():
        return _not_empty(raw.select(*columns), path)
    return _not_empty(_with_place(raw, columns, order_column), path)


def _from_records(
    spark: SparkSession,
    path: str,
    header: T.StructType,
    columns: list[Column],
    encoding: str,
    options: Mapping[str, str],
    order_column: str | None,
) -> DataFrame:
    """``columns`` of the records of all files but their headers, with the place of each as ``order_column``."""
    in_paths = _partition_columns(spark, path)
    found = split_csv.records(spark, path, encoding, in_paths).where(F.col("record") > 0)
    place = F.col("number") * F.lit(1 << ROWS_BITS) + F.col("record") - 1
    # Columns go by position, as names may hold any character.
    in_files = [name for name in header.fieldNames() if name not in in_paths]
    names = {name: f"_{k}" for k, name in enumerate(in_files)}
    shape = ", ".join(f"{name} string" for name in names.values())
    fields = F.from_csv("text", shape, dict(options)).alias("_fields")
    parsed = found.select(place.alias("_place"), fields, *in_paths)
    parsed = parsed.select("_place", *[F.col(f"_fields.{short}").alias(name) for name, short in names.items()], *in_paths)
    placed = [] if order_column is None or order_column in header.fieldNames() else [F.col("_place").alias(order_column)]
    return parsed.select(*placed, *columns)


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns that stand in the paths of a table's files."""
    return [name for name in spark.read.text(path).columns if name != "value"]


def _with_place(raw: DataFrame, columns: list[Column], order_column: str) -> DataFrame:
    """``columns`` of ``raw`` and the place of each row in the files it was read from.

    Rows of a file are numbered in a row within their task, so the first number
    of a file, one row per file, is all that has to be looked up.
    """
    placed = raw.select(*columns, F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    files = placed.groupBy("_file").agg(F.min("_at").alias("_first"))
    numbered = files.select("_file", "_first", (F.row_number().over(Window.orderBy("_file")) - 1).cast("long").alias("_number"))
    place = F.col("_number") * F.lit(1 << ROWS_BITS) + F.col("_at") - F.col("_first")
    rest = [c for c in placed.columns if c not in ("_file", "_at")]
    return placed.join(numbered, "_file").select(place.alias(order_column), *rest)


def read_parquet(
    spark: SparkSession, path: str, columns: Iterable[str] | None = None, order_column: str | None = None
) -> DataFrame:
    """A Parquet table, optionally only some columns. Runs no job beyond reading footers.

    ``order_column`` names a column for the place of a row, as :func:`read_csv`
    does, if the table lacks it. It is the number of the file by name and the
    row's position in its file, whatever ranges the files are read in; nothing
    is written but the names of the files, and they are listed by a job that
    reads no column.
    """
    df = _found(spark.read.parquet, path)
    if columns is not None:
        columns = list(columns)
        require_columns(df, *[c for c in columns if c != order_column])
    if order_column is not None and order_column not in df.columns:
        df = _with_row_place(df, order_column)
    return df if columns is None else df.select(*columns)


def _with_row_place(df: DataFrame, order_column: str) -> DataFrame:
    """``df``, a scan of Parquet files, with the place of each row."""
    # One row per file.
    files = df.select(F.col("_metadata.file_path").alias("_file")).distinct()
    files = pin(files.select("_file", (F.row_number().over(Window.orderBy("_file")) - 1).cast("long").alias("_number")))
    located = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    place = F.col("_number") * F.lit(1 << ROWS_BITS) + F.col("_at")
    return located.join(files, "_file").select(place.alias(order_column), *[located[c] for c in df.columns])


def read_clean(
    spark: SparkSession,
    path: str,
    roles: Roles = Roles(),
    file_format: str = "parquet",
    schema: str | T.StructType | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """A table that must exist, be non-empty, have its columns and hold each text once.

    A CSV table is read by the names in ``roles`` unless it has a ``schema``. If
    the table lacks the order column, the place in the files stands for it.
    """
    if file_format == "parquet":
        df = _not_empty(read_parquet(spark, path, order_column=_place_column(roles)), path)
    elif file_format == "csv":
        df = read_csv(spark, path, schema or csv_schema(spark, path, roles), encoding, order_column=roles.order_columns[0])
    else:
        raise ValueError(f"file_format must be 'parquet' or 'csv', got {file_format!r}")
    require_columns(df, roles.text, roles.label, *roles.order_columns)
    assert_unique_texts(df, roles)
    assert_order_identifies_rows(df, roles)
    return df


def _place_column(roles: Roles) -> str | None:
    """The order column, if it is a single one, for which the place in files can stand."""
    return roles.order_columns[0] if len(roles.order_columns) == 1 else None


def csv_schema(spark: SparkSession, path: str, roles: Roles) -> T.StructType:
    """Text and label as strings, and the order column as a number if the header has it."""
    header = _found(lambda p: spark.read.option("header", True).csv(p), path).columns
    order = [T.StructField(name, T.LongType()) for name in roles.order_columns if name in header]
    return T.StructType([*order, T.StructField(roles.text, T.StringType()), T.StructField(roles.label, T.StringType())])


def _csv_options(writer: DataFrameWriter) -> DataFrameWriter:
    return (
        writer.option("header", True)
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def write_table(df: DataFrame, path: str, file_format: str = "parquet") -> str:
    """Write a table; CSV gets a header, and quotes are doubled so it reads back unchanged.

    A table at ``path`` is replaced once all is written, see :mod:`commit`.
    """
    return commit.replace(df.sparkSession, path, _write_as(df.write, file_format))


def _write_as(writer: DataFrameWriter, file_format: str) -> Callable[[str], None]:
    if file_format == "parquet":
        return writer.parquet
    if file_format == "csv":
        return _csv_options(writer).csv
    raise ValueError(f"file_format must be 'parquet' or 'csv', got {file_format!r}")


def write_splits(df: DataFrame, path: str, file_format: str = "parquet", split: str = "split") -> dict[str, str]:
    """Write one table partitioned by split; returns the directory of each split.

    A single write serves all splits, so the rows are computed once, and they
    replace what was at ``path`` together.
    """
    require_columns(df, split)
    commit.replace(df.sparkSession, path, _write_as(df.write.partitionBy(split), file_format))
    return {name: f"{path}/{split}={name}" for name in ("train", "val", "test")}


def read_splits(
    spark: SparkSession, path: str, file_format: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """The table :func:`write_splits` wrote, with its ``split`` column."""
    if file_format == "parquet":
        return _found(spark.read.parquet, path)
    if schema is None:
        raise ValueError("reading splits from CSV needs the schema of the table")
    with_split = T.StructType([*schema.fields, T.StructField("split", T.StringType())])
    return read_csv(spark, path, with_split)


def write_report(report: DataFrame, path: str, notes: Mapping[str, Any] | None = None) -> str:
    """Write a ``section, item, value`` report as JSON lines.

    ``notes``, such as file or policy names and settings, are lines of section
    ``notes`` with a ``note`` in place of the value; numbers among them stay
    numbers. Nothing is gathered: a report of any length is written by its tasks.
    """
    spark = report.sparkSession
    lines = report.select("section", "item", "value", F.lit(None).cast("string").alias("note"))
    said = []
    for name, value in (notes or {}).items():
        number = float(value) if isinstance(value, int | float) and not isinstance(value, bool) else None
        said.append(("notes", name, number, None if number is not None else str(value)))
    if said:
        lines = lines.unionByName(spark.createDataFrame(said, "section string, item string, value double, note string"))
    return commit.replace(spark, path, lines.write.json)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A written report as ``section, item, value`` rows again."""
    return _lines(spark, path).where("section <> 'notes'").select("section", "item", "value")


def read_notes(spark: SparkSession, path: str) -> dict[str, Any]:
    """The notes of a written report."""
    said = _lines(spark, path).where("section = 'notes'").collect()
    return {row["item"]: row["note"] if row["value"] is None else row["value"] for row in said}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    shape = "section string, item string, value double, note string"
    return _found(lambda p: spark.read.schema(shape).json(p), path)


def write_document(report: DataFrame, path: str, notes: Mapping[str, Any] | None = None) -> str:
    """Write a short report as one JSON document, a single file at ``path``; refuses what :func:`report_document` does."""
    spark = report.sparkSession
    text = report_document(report, notes)

    def write(folder: str) -> None:
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(folder)

    return commit.replace_file(spark, path, write)


def report_document(report: DataFrame, notes: Mapping[str, Any] | None = None) -> str:
    """A short report as one JSON document, for people; refuses more than ``MAX_DOCUMENT_LINES`` lines."""
    lines = report.select("section", "item", "value").limit(MAX_DOCUMENT_LINES + 1).collect()
    if len(lines) > MAX_DOCUMENT_LINES:
        raise ValueError(f"the report has more than {MAX_DOCUMENT_LINES} lines; write it as JSON lines")
    sections: dict[str, dict[str, float]] = {}
    for section, item, value in sorted(lines, key=lambda line: (line["section"], str(line["item"]))):
        sections.setdefault(section, {})[item] = int(value) if value is not None and float(value).is_integer() else value
    return json.dumps({**(notes or {}), "report": sections}, indent=2, ensure_ascii=False)
