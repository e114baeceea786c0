"""Evaluating predicted labels.

Rows are reduced to truth-by-prediction counts once; every metric follows from
that small table. ``by`` columns evaluate several models in the same job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.numbers import percent
from labelloom.operators.validate import require_columns

# Fixed value: probabilities are kept this far from 0 and 1 in the log loss.
PROBABILITY_MARGIN = 1e-7


def argmax_class(probabilities: Column) -> Column:
    """Zero-based position of the largest entry; the first one on ties."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def with_argmax(df: DataFrame, probabilities: str, out: str = "predicted") -> DataFrame:
    require_columns(df, probabilities)
    return df.withColumn(out, argmax_class(F.col(probabilities)))


def row_loss(probabilities: Column, truth_id: Column) -> Column:
    """Negative log of the probability given to the true class; its mean is the log loss."""
    given = F.get(probabilities, truth_id)
    return -F.log(F.least(F.greatest(given, F.lit(PROBABILITY_MARGIN)), F.lit(1 - PROBABILITY_MARGIN)))


def confusion_counts(
    df: DataFrame, truth: str, predicted: str, by: Sequence[str] = (), loss: str | None = None
) -> DataFrame:
    """Pairs that occur: ``truth, predicted, n``, and the summed ``loss`` if a column is named."""
    require_columns(df, truth, predicted, *by, *([loss] if loss else []))
    sums = [F.sum(loss).alias("loss")] if loss else []
    return df.groupBy(*by, F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"), *sums
    )


def confusion_matrix(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Every pair of labels seen in truth or prediction, 0 where a pair does not occur.

    The grid is unfolded from the label list of the counts, one row per class pair.
    """
    counts = confusion_counts(df, truth, predicted)
    labels = counts.agg(
        F.array_union(F.collect_set("truth"), F.collect_set("predicted")).alias("labels")
    )
    zero = F.lit(0).cast("bigint")
    grid = labels.select(F.explode("labels").alias("truth"), "labels").select(
        "truth", F.explode("labels").alias("predicted"), zero.alias("n")
    )
    return grid.unionByName(counts).groupBy("truth", "predicted").agg(F.sum("n").alias("n"))


def confusion_wide(df: DataFrame, truth: str, predicted: str, labels: Sequence[str]) -> DataFrame:
    """The confusion matrix with one column per predicted label of a given list."""
    matrix = confusion_matrix(df, truth, predicted)
    return matrix.groupBy("truth").pivot("predicted", list(labels)).agg(F.sum("n")).na.fill(0)


def _per_label(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per label: support (truth), claimed (predicted), hits, precision, recall, F1 (0 if undefined)."""
    zero = F.lit(0).cast("bigint")
    n = F.col("n")
    hit = F.when(F.col("truth").eqNullSafe(F.col("predicted")), n).otherwise(zero)
    loss = F.col("loss") if "loss" in counts.columns else F.lit(0.0)

    def side(label: str, support: Column, claimed: Column, hits: Column, lost: Column) -> Column:
        return F.struct(
            F.col(label).alias("label"),
            support.alias("support"),
            claimed.alias("claimed"),
            hits.alias("hits"),
            lost.alias("loss"),
        )

    sides = F.array(side("truth", n, zero, hit, loss), side("predicted", zero, n, zero, F.lit(0.0)))
    totals = counts.select(*by, F.inline(sides)).groupBy(*by, "label").agg(
        *[F.sum(c).alias(c) for c in ("support", "claimed", "hits", "loss")]
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    return totals.select(
        "*",
        ratio(F.col("hits"), F.col("claimed")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(F.col("hits") * 2, F.col("claimed") + F.col("support")).alias("f1"),
    )


def _weighted(value: str) -> Column:
    return F.coalesce(F.try_divide(F.sum(F.col(value) * F.col("support")), F.sum("support")), F.lit(0.0))


def overall_metrics(
    df: DataFrame,
    truth: str,
    predicted: str,
    by: Sequence[str] = (),
    digits: int | None = None,
    loss: str | None = None,
) -> DataFrame:
    """One row per ``by`` group: ``n_rows, accuracy, macro_f1, weighted_f1``, and the mean ``loss`` if named.

    Macro F1 averages over labels that occur in truth or prediction.
    """
    shown = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)

    def per_row(total: Column) -> Column:
        return F.coalesce(F.try_divide(total.cast("double"), F.sum("support")), F.lit(0.0))

    losses = [shown(per_row(F.sum("loss"))).alias("loss")] if loss else []
    counts = confusion_counts(df, truth, predicted, by, loss)
    return _per_label(counts, by).groupBy(*by).agg(
        F.sum("support").alias("n_rows"),
        *losses,
        shown(per_row(F.sum("hits"))).alias("accuracy"),
        shown(F.avg("f1")).alias("macro_f1"),
        shown(_weighted("f1")).alias("weighted_f1"),
    )


def classification_report(df: DataFrame, truth: str, predicted: str, digits: int | None = None) -> DataFrame:
    """Per label, then for all: ``label, precision, recall, f1, support``.

    The rows ``accuracy``, ``macro avg`` and ``weighted avg`` come from the
    grand-total row of one rollup; accuracy has no precision and recall.
    """
    shown = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    rolled = (
        _per_label(confusion_counts(df, truth, predicted))
        .withColumn("label", F.coalesce(F.col("label").cast("string"), F.lit("null")))
        .rollup("label")
        .agg(
            F.grouping("label").alias("is_total"),
            F.sum("support").alias("support"),
            F.try_divide(F.sum("hits").cast("double"), F.sum("support")).alias("accuracy"),
            *[F.avg(m).alias(m) for m in ("precision", "recall", "f1")],
            *[_weighted(m).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")],
        )
    )
    none = F.lit(None).cast("double")

    def line(name: Column, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            name.alias("label"),
            shown(precision).alias("precision"),
            shown(recall).alias("recall"),
            shown(f1).alias("f1"),
            F.col("support").alias("support"),
        )

    p, r, f = F.col("precision"), F.col("recall"), F.col("f1")
    totals = F.array(
        line(F.lit("accuracy"), none, none, F.col("accuracy")),
        line(F.lit("macro avg"), p, r, f),
        line(F.lit("weighted avg"), *[F.col(f"weighted_{m}") for m in ("precision", "recall", "f1")]),
    )
    return rolled.select(
        F.inline(F.when(F.col("is_total") == 1, totals).otherwise(F.array(line(F.col("label"), p, r, f))))
    )


def misclassified(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Rows whose prediction differs from the truth."""
    require_columns(df, truth, predicted)
    return df.where(~F.col(truth).eqNullSafe(F.col(predicted)))


def error_summary(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row: wrong predictions, all predictions, error rate in percent."""
    require_columns(df, truth, predicted)
    wrong = F.count_if(~F.col(truth).eqNullSafe(F.col(predicted)))
    return df.agg(
        wrong.alias("errors"),
        F.count(F.lit(1)).alias("n_rows"),
        percent(wrong, F.count(F.lit(1)), 2).alias("error_pct"),
    )


def misclassified_preview(
    df: DataFrame, truth: str, predicted: str, order: Sequence[str], text: str = "text", k: int = 6, width: int = 140
) -> DataFrame:
    """The first ``k`` wrong predictions with their text cut to ``width`` characters."""
    require_columns(df, text, *order)
    return (
        misclassified(df, truth, predicted)
        .select(
            *order,
            F.col(truth).alias("truth"),
            F.col(predicted).alias("predicted"),
            F.substring(text, 1, width).alias("preview"),
        )
        .orderBy(*order)
        .limit(k)
    )
