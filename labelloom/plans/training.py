"""Training on train, choosing on validation, evaluating once on test."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators import features, metrics, models
from labelloom.operators.pin import pin, settle
from labelloom.roles import Roles


@dataclass(frozen=True)
class TrainingResult:
    trained: models.Trained
    benchmark: DataFrame
    selected: str
    test_scores: DataFrame
    test_report: DataFrame
    confusion: DataFrame
    errors: DataFrame
    error_preview: DataFrame


def train_and_evaluate(
    df: DataFrame,
    roles: Roles = Roles(),
    chosen: models.Variants | None = None,
    max_features: int = features.TFIDF_FEATURES,
    stop_words: Sequence[str] | None = None,
    expected: Sequence[str] | None = None,
) -> TrainingResult:
    """The whole model comparison on a table with a ``split`` column.

    Test rows are scored once, by the selected model only; every test figure
    is read off those settled predictions.
    """
    trained = models.train(df, roles, chosen, max_features, stop_words, expected)
    benchmark = pin(models.model_benchmark(df, trained))
    selected = models.select_model(benchmark).first()["model"]
    columns = [*roles.order_columns, roles.text, roles.label, "label_id", "probabilities", "predicted"]
    scored = settle(
        trained.transform(df.where(F.col("split") == "test"), [selected])
        .select(*columns)
        .withColumn("row_loss", metrics.row_loss(F.col("probabilities"), F.col("label_id")))
    )
    pair = (scored, roles.label, "predicted")
    return TrainingResult(
        trained=trained,
        benchmark=benchmark,
        selected=selected,
        test_scores=metrics.overall_metrics(*pair, loss="row_loss"),
        test_report=metrics.classification_report(*pair),
        confusion=metrics.confusion_matrix(*pair),
        errors=metrics.error_summary(*pair),
        error_preview=metrics.misclassified_preview(*pair, list(roles.order_columns), roles.text),
    )
