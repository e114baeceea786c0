"""Checks on tables: columns, roles, nulls, class coverage, uniqueness, expected values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.text import text_key
from labelloom.roles import Roles


def require_columns(df: DataFrame, *columns: str) -> None:
    """Raise ``ValueError`` naming the first column that is missing. Runs no job."""
    for name in columns:
        if name not in df.columns:
            raise ValueError(f"column {name!r} not found; available: {df.columns}")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def column_roles(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Guess roles of string columns: fewest distinct values is the label, most is the text.

    One row per string column: ``column_name, n_distinct, role``. Nulls are not
    counted, ties go to the first column, a lone string column is the text.
    """
    names = string_columns(df)
    if not names:
        raise ValueError("no string columns to choose from")
    values = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("position"),
                        F.lit(name).alias("column_name"),
                        text_key(F.col(name)).alias("value"),
                    )
                    for i, name in enumerate(names)
                ]
            )
        )
    )
    if approximate:
        counted = values.groupBy("position", "column_name").agg(
            F.approx_count_distinct("value").alias("n_distinct")
        )
    else:
        # distinct() first: each task sends a frequent value on only once.
        counted = values.distinct().groupBy("position", "column_name").agg(F.count("value").alias("n_distinct"))
    extremes = counted.agg(
        F.min(F.struct("n_distinct", "position")).alias("least"),
        F.max(F.struct(F.col("n_distinct"), (-F.col("position")).alias("back"))).alias("most"),
        F.collect_list(F.struct("position", "column_name", "n_distinct")).alias("columns"),
    ).select("least", "most", F.inline("columns"))
    label = (F.col("position") == F.col("least.position")) & F.lit(len(names) > 1)
    text = F.col("position") == -F.col("most.back")
    return extremes.select(
        "column_name",
        "n_distinct",
        F.when(label & text, F.lit("label+text"))
        .when(label, F.lit("label"))
        .when(text, F.lit("text"))
        .otherwise(F.lit("other"))
        .alias("role"),
    )


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: ``column_name, nulls, passes``."""
    require_columns(df, *columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "nulls").select(
        "column_name", "nulls", (F.col("nulls") == 0).alias("passes")
    )


def assert_no_nulls(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise ``ValueError`` listing the columns that hold nulls."""
    found = {r["column_name"]: r["nulls"] for r in null_audit(df, columns).where(~F.col("passes")).collect()}
    if found:
        raise ValueError(f"null values found: {found}")


def class_coverage_gaps(
    df: DataFrame,
    expected: DataFrame | Iterable[str],
    splits: Sequence[str],
    label: str = "label",
    split: str = "split",
) -> DataFrame:
    """Pairs ``split, label`` that should occur in ``df`` and do not; empty when all is well.

    ``expected`` lists the classes, or is a frame with a ``label`` column.
    """
    if not isinstance(expected, DataFrame):
        expected = df.sparkSession.createDataFrame([(c,) for c in expected], "label string")
    wanted = expected.select(
        F.explode(F.array(*[F.lit(s) for s in splits])).alias("split"), F.col("label")
    ).distinct()
    present = df.select(F.col(split).alias("split"), F.col(label).alias("label")).distinct()
    return wanted.join(present, ["split", "label"], "left_anti")


def unique_text_check(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row: ``n_rows, n_unique, is_unique``. A null text breaks uniqueness."""
    require_columns(df, roles.text)
    per_text = df.groupBy(text_key(F.col(roles.text)).alias("text_key")).agg(F.count(F.lit(1)).alias("n"))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return per_text.agg(
        rows.alias("n_rows"),
        F.count("text_key").alias("n_unique"),
        (rows == F.count("text_key")).alias("is_unique"),
    )


def assert_unique_texts(df: DataFrame, roles: Roles = Roles()) -> None:
    row = unique_text_check(df, roles).first()
    if not row["is_unique"]:
        raise ValueError(
            f"texts are not unique: {row['n_rows']} rows but {row['n_unique']} distinct non-null texts"
        )


def expected_value_mismatches(
    report: DataFrame, expected: DataFrame, keys: Sequence[str], value: str = "value"
) -> DataFrame:
    """Keys whose reported value differs from the expected one, or that only one side has."""
    actual = report.select(*keys, F.col(value).alias("actual"))
    wanted = expected.select(*keys, F.col(value).alias("expected"))
    return actual.join(wanted, list(keys), "full_outer").where(
        ~F.col("actual").eqNullSafe(F.col("expected"))
    )


def assert_order_identifies_rows(df: DataFrame, roles: Roles = Roles()) -> None:
    """Raise ``ValueError`` unless every row has an order value and no two share one.

    Keep-one policies and the split go by it: a shared value would keep several
    rows of a text and a null one would lose its row. One narrow aggregate.
    """
    require_columns(df, *roles.order_columns)
    whole = F.lit(True)
    for name in roles.order_columns:
        whole = whole & F.col(name).isNotNull()
    per_value = df.select(*roles.order_columns, whole.alias("_whole")).groupBy(*roles.order_columns, "_whole")
    found = per_value.agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.when(F.col("_whole"), 0).otherwise(F.col("n"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(F.col("_whole"), F.col("n") - 1)), F.lit(0)).alias("repeated"),
    ).first()
    if found["missing"] or found["repeated"]:
        names = ", ".join(roles.order_columns)
        raise ValueError(f"{names} doesn't identify rows: {found['missing']} without a value, {found['repeated']} with another row's")
