"""Profiling a labelled-text table.

Row-level measures are plain expressions evaluated in the scan's stage; what
is shuffled are counts. Exact percentiles work on histograms of lengths, which
have one row per distinct length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions import text as tx
from labelloom.functions.numbers import LENGTH_STATS, histogram_stats, over_all, percent
from labelloom.operators.groups import is_conflicting, label_counts
from labelloom.operators.validate import require_columns
from labelloom.roles import Roles


def shape(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the size of the whole table."""
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    size = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return size.select("n_rows", F.lit(len(df.columns)).alias("n_cols"), F.inline(columns))


def class_distribution(df: DataFrame, label: str = "label", dropna: bool = False, digits: int = 4) -> DataFrame:
    """``label, n, pct`` per class.

    With ``dropna`` rows without a label are left out of both count and
    denominator; otherwise they form a class of their own.
    """
    require_columns(df, label)
    rows = df.where(F.col(label).isNotNull()) if dropna else df
    counts = rows.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("*", percent(F.col("n"), over_all(F.sum("n")), digits).alias("pct"))


def class_distribution_zero_filled(
    df: DataFrame, original: DataFrame, label: str = "label", digits: int = 4
) -> DataFrame:
    """Class counts of ``df`` over every label of ``original``; 0 where none is left."""
    labels = original.where(F.col(label).isNotNull()).select(F.col(label).alias("label")).distinct()
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    # Labels of df that original lacks, and rows without a label, still count in the total.
    totals = counts.select("label", "n", over_all(F.sum("n")).alias("total"))
    joined = labels.join(totals, "label", "left")
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    return joined.select("label", n.alias("n"), percent(n, F.col("total"), digits).alias("pct"))


def missing_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage per column, from one aggregate."""
    columns = list(columns or df.columns)
    require_columns(df, *columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counts.unpivot(["_rows"], columns, "column_name", "missing").select(
        "column_name", "missing", percent(F.col("missing"), F.col("_rows")).alias("missing_pct")
    )


def _comparable(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Columns as grouping keys, strings by digest."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [
        (tx.text_key(F.col(c)) if isinstance(types[c], T.StringType) else F.col(c)).alias(c) for c in columns
    ]


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: copies beyond the first of equal rows over ``columns``; nulls equal each other."""
    columns = list(columns or df.columns)
    require_columns(df, *columns)
    groups = df.groupBy(*_comparable(df, columns)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def duplicate_counts(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row: exact duplicate rows, duplicate text rows, texts with conflicting labels.

    "Exact" compares text and label; both counts leave out first occurrences.
    """
    counts = label_counts(df, roles)
    per_text = counts.groupBy("text_key").agg(
        F.sum(F.col("n") - 1).alias("exact"), F.sum("n").alias("n_rows"), F.count("label").alias("n_labels")
    )
    return per_text.agg(
        F.coalesce(F.sum("exact"), F.lit(0)).alias("exact_duplicate_rows"),
        F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("duplicate_text_rows"),
        F.count_if(is_conflicting()).alias("texts_with_conflicting_labels"),
    )


def blank_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """One row: null texts, and texts of white space only."""
    require_columns(df, text)
    return df.agg(
        F.count_if(F.col(text).isNull()).alias("null_texts"),
        F.count_if(tx.is_blank(F.col(text))).alias("blank_texts"),
    )


def _length_stats(df: DataFrame, length: Column) -> DataFrame:
    histogram = df.select(length.alias("length")).groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    return histogram.where(F.col("length").isNotNull()).agg(*histogram_stats("length", "n"))


def char_length_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """One row of length statistics in characters, null texts left out."""
    require_columns(df, text)
    return _length_stats(df, F.length(text))


def word_length_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """One row of length statistics in white-space separated words, null texts left out."""
    require_columns(df, text)
    return _length_stats(df, tx.word_count(F.col(text)))


def text_flags(df: DataFrame, text: str = "text", repeat: int = 3) -> DataFrame:
    """``df`` with one boolean column per surface flag."""
    require_columns(df, text)
    return df.select("*", *[c.alias(f"has_{n}") for n, c in tx.flag_columns(F.col(text), repeat).items()])


def feature_presence(df: DataFrame, text: str = "text", digits: int = 4) -> DataFrame:
    """Rows and percentage per surface flag; null texts are not in the denominator."""
    require_columns(df, text)
    flags = tx.flag_columns(F.col(text))
    counts = df.agg(
        F.count(text).alias("_texts"), *[F.count_if(c).alias(n) for n, c in flags.items()]
    )
    return counts.unpivot(["_texts"], list(flags), "feature", "n").select(
        "feature", "n", percent(F.col("n"), F.col("_texts"), digits).alias("pct")
    )


def non_ascii_rows(df: DataFrame, text: str = "text", digits: int = 4) -> DataFrame:
    """One row: texts with a character beyond ASCII, and their share."""
    require_columns(df, text)
    n = F.count_if(tx.has_non_ascii(F.col(text)))
    return df.agg(n.alias("n"), percent(n, F.count(text), digits).alias("pct"))


def examples_per_class(df: DataFrame, roles: Roles = Roles(), k: int = 2, width: int = 200) -> DataFrame:
    """The first ``k`` texts of each class, cut and on one line.

    Ranks up to ``k`` are cut per task before the shuffle, so a class of any
    size sends at most ``k`` rows from each task.
    """
    require_columns(df, roles.text, roles.label, *roles.order_columns)
    rows = df.where(F.col(roles.text).isNotNull() & F.col(roles.label).isNotNull()).select(
        F.col(roles.label).alias("label"),
        roles.order_value().alias("row_order"),
        tx.one_line(F.substring(roles.text, 1, width)).alias("example"),
    )
    rank = F.row_number().over(Window.partitionBy("label").orderBy("row_order"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).select("label", "rank", "example")


def preview(df: DataFrame, roles: Roles = Roles(), condition: Column | None = None, k: int = 3, width: int = 150) -> DataFrame:
    """The first ``k`` texts that satisfy ``condition``, cut to ``width`` characters."""
    rows = df if condition is None else df.where(condition)
    return (
        rows.where(F.col(roles.text).isNotNull())
        .select(*roles.order_columns, F.substring(roles.text, 1, width).alias("preview"))
        .orderBy(*roles.order_columns)
        .limit(k)
    )


def non_ascii_preview(df: DataFrame, roles: Roles = Roles(), k: int = 3, width: int = 150) -> DataFrame:
    return preview(df, roles, tx.has_non_ascii(F.col(roles.text)), k, width)


def profile_report(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """The whole profile as ``section, item, value`` rows, from one pass over the texts.

    ``columns`` names each column with its type and its place, ``roles`` the
    columns taken for text and label, ``labels`` the classes in order.

    Lengths and flags are functions of the text, so they ride along with the
    per-text groups, and counts of nulls are added up in them. Each group then
    adds its weight to two length histograms and to the table totals; the report
    is read off those. Class counts need the label column only and come from one
    scan of it.
    """
    t = F.col(roles.text)
    measures = {
        "chars": F.length(t),
        "words": tx.word_count(t),
        "blank": tx.is_blank(t),
        "non_ascii": tx.has_non_ascii(t),
        **tx.flag_columns(t),
    }
    nulls = {f"_null_{k}": F.col(c).isNull().cast("bigint") for k, c in enumerate(df.columns)}
    per_text = (
        label_counts(df, roles, measures, nulls)
        .groupBy("text_key", *measures)
        .agg(
            F.count("label").alias("n_labels"),
            F.sum("n").alias("n_rows"),
            F.sum(F.col("n") - 1).alias("exact"),
            *[F.sum(name).alias(name) for name in nulls],
        )
    )
    n = F.col("n_rows")
    zero = F.lit(0).cast("bigint")

    def rows_where(condition: Column) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), n).otherwise(zero)

    totals = {
        "n_rows": n,
        "null_text_values": rows_where(F.col("text_key").isNull()),
        "empty_whitespace_texts": rows_where(F.col("blank")),
        "exact_duplicate_rows": F.col("exact"),
        "duplicate_text_rows": n - 1,
        "texts_with_conflicting_labels": is_conflicting().cast("bigint"),
        "non_ascii_rows": rows_where(F.col("non_ascii")),
        **{f: rows_where(F.col(f)) for f in tx.FLAG_NAMES},
    }
    summed = totals | {name: F.col(name) for name in nulls}

    def entry(kind: str, length: Column, weight: Column, counted: bool = False) -> Column:
        counts = [(c if counted else zero).alias(f"_{name}") for name, c in summed.items()]
        return F.struct(F.lit(kind).alias("kind"), length.alias("length"), weight.alias("weight"), *counts)

    entries = F.array(
        entry("char_length", F.col("chars"), n),
        entry("word_length", F.col("words"), n),
        entry("totals", F.lit(None).cast("int"), zero, counted=True),
    )
    sums = [F.sum(f"_{name}").alias(f"_{name}") for name in summed]
    small = (
        per_text.select(F.inline(entries))
        .groupBy("kind", "length")
        .agg(F.sum("weight").alias("n"), *sums)
        .groupBy("kind")
        .agg(*sums, *histogram_stats("length", "n"))
    )

    def line(section: Column | str, item: Column | str, value: Column) -> Column:
        section = F.lit(section) if isinstance(section, str) else section
        item = F.lit(item) if isinstance(item, str) else item
        return F.struct(section.alias("section"), item.alias("item"), value.cast("double").alias("value"))

    of_totals = [line("totals", name, F.col(f"_{name}")) for name in totals]
    for k, column in enumerate(df.columns):
        missing = F.coalesce(F.col(f"__null_{k}"), F.lit(0))
        of_totals += [line("missing_values", column, missing), line("missing_percentages", column, percent(missing, F.col("_n_rows")))]
    lines = F.when(F.col("kind") == "totals", F.array(*of_totals)).otherwise(F.array(*[line(F.col("kind"), s, F.col(s)) for s in LENGTH_STATS]))
    label = F.coalesce(F.col("label").cast("string"), F.lit("null"))
    # One row per class; those without a label come last and have no place among the others.
    place = F.row_number().over(Window.orderBy(F.col("label").isNull(), F.col("label").cast("string"))) - 1
    counts = [line("class_counts", label, F.col("n")), line("class_percentages", label, F.col("pct"))]
    listed = F.array(*counts, line("labels", F.col("label").cast("string"), F.col("place")))
    classes = class_distribution(df, roles.label).withColumn("place", place)
    classes = classes.select(F.inline(F.when(F.col("label").isNull(), F.array(*counts)).otherwise(listed)))
    known = [("shape", "n_cols", float(len(df.columns)))]
    known += [("columns", f"{name} {kind}", float(place)) for place, (name, kind) in enumerate(df.dtypes)]
    known += [("roles", f"text {roles.text}", 1.0), ("roles", f"label {roles.label}", 1.0)]
    fixed = df.sparkSession.createDataFrame(known, "section string, item string, value double")
    return small.select(F.inline(lines)).unionByName(classes).unionByName(fixed)
