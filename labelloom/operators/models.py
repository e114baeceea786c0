"""Training classifier variants, choosing on validation, evaluating once on test.

Features are sparse TF-IDF vectors fitted on train. Variants are Spark ML's, or
that of :mod:`network`; all add up gradients over the partitions of the train split.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.operators import features, metrics, network
from labelloom.operators.pin import pin
from labelloom.roles import Roles

# Hidden units and penalty strength of the variants.
HIDDEN_UNITS = 256
PENALTY = 3e-4

#: Rows that a task of the training goes over at a time, more if fewer tasks than run at once would do.
TASK_ROWS = 100_000

Variants = Mapping[str, Callable[[int, int], object]]


def variants(
    hidden: int = HIDDEN_UNITS, penalty: float = PENALTY, iterations: int = 50, seed: int = 42, rectified: bool = False
) -> Variants:
    """Estimators by name; each takes the number of features and of classes.

    The dense one has sigmoid units and is Spark ML's, or with ``rectified``
    rectified ones, trained on sparse rows until the validation loss rises.
    """
    columns = {"featuresCol": "features", "labelCol": "label_id"}

    def dense(n: int, k: int) -> object:
        if rectified:
            return network.ReluClassifier(n, k, hidden, max_steps=iterations, seed=seed)
        return MultilayerPerceptronClassifier(layers=[n, hidden, k], maxIter=iterations, seed=seed, **columns)

    return {
        "dense": dense,
        "linear": lambda n, k: LogisticRegression(family="multinomial", maxIter=iterations, regParam=0.0, **columns),
        "linear_l1": lambda n, k: LogisticRegression(
            family="multinomial", maxIter=iterations, regParam=penalty, elasticNetParam=1.0, **columns
        ),
        "linear_l2": lambda n, k: LogisticRegression(
            family="multinomial", maxIter=iterations, regParam=penalty, elasticNetParam=0.0, **columns
        ),
    }


@dataclass(frozen=True)
class Trained:
    """Fitted label index, vocabulary and models; ``transform`` applies one model to a table."""

    roles: Roles
    index: DataFrame
    vocabulary: DataFrame
    models: Mapping[str, Model | network.Network] = field(default_factory=dict)

    def prepare(self, df: DataFrame) -> DataFrame:
        vectors = features.tfidf_vectors(df, self.vocabulary, self.roles.text)
        return features.encode_labels(vectors, self.index, self.roles.label)

    def transform(self, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        """One row per row of ``df`` and model: ``model, label_id, probabilities, predicted_id, predicted``.

        Features are computed once; the models run over them one after the
        other in the same pass.
        """
        names = list(self.models if names is None else names)
        scored = self.prepare(df)
        for i, name in enumerate(names):
            if isinstance(self.models[name], network.Network):
                scored = self.models[name].transform(scored, f"_probability_{i}")
                continue
            model = self.models[name].copy()
            for part in ("rawPrediction", "probability", "prediction"):
                model.set(model.getParam(f"{part}Col"), f"_{part}_{i}")
            scored = model.transform(scored)
        found = [F.col(f"_probability_{i}") for i in range(len(names))]
        arrays = [c if isinstance(self.models[name], network.Network) else vector_to_array(c) for name, c in zip(names, found, strict=True)]
        outcomes = F.array(
            *[F.struct(F.lit(name).alias("model"), c.alias("probabilities")) for name, c in zip(names, arrays, strict=True)]
        )
        rows = scored.select(*df.columns, "label_id", F.inline(outcomes))
        guessed = rows.withColumn("predicted_id", metrics.argmax_class(F.col("probabilities")))
        return features.decode_labels(guessed, self.index, "predicted_id", "predicted")


def train(
    df: DataFrame,
    roles: Roles = Roles(),
    chosen: Variants | None = None,
    max_features: int = features.TFIDF_FEATURES,
    stop_words: Sequence[str] | None = None,
    expected: Sequence[str] | None = None,
) -> Trained:
    """Fit index, vocabulary and every variant on the rows of ``df`` with ``split = 'train'``.

    ``df`` is read several times, so pass a written or settled table.
    """
    chosen = variants() if chosen is None else chosen
    rows = df.where(F.col("split") == "train")
    n_rows, unlabelled = rows.agg(F.count(F.lit(1)), F.count_if(F.col(roles.label).isNull())).first()
    if unlabelled:
        raise ValueError(f"{unlabelled} training rows have no label; drop or label them first")
    index = features.label_index(rows, roles.label, expected)
    vocabulary = pin(
        features.tfidf_vocabulary(rows, roles.text, max_features, stop_words), features.MAX_BROADCAST_VOCABULARY
    )
    fitted = Trained(roles, index, vocabulary)
    n_classes, n_terms = index.count(), vocabulary.count()
    # All variants read the same vectors; an executor that is lost has its share recomputed. Every step waits for its slowest
    # task and moves a gradient per task, so the rows are dealt evenly to the tasks that run at once, or a few times as many.
    vectors = fitted.prepare(rows).select("features", "label_id").repartition(n_tasks(df.sparkSession, n_rows))
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    # A network stops by its loss on validation rows, if there are any of known labels.
    unseen = fitted.prepare(df.where(F.col("split") == "val")).select("features", "label_id").where("label_id is not null")
    unseen = unseen.persist(StorageLevel.MEMORY_AND_DISK)
    models = {}
    try:
        for name, build in chosen.items():
            estimator = build(n_terms, n_classes)
            if isinstance(estimator, network.ReluClassifier):
                models[name] = estimator.fit(vectors, None if unseen.isEmpty() else unseen)
            else:
                models[name] = estimator.fit(vectors)
    finally:
        vectors.unpersist()
        unseen.unpersist()
    return Trained(roles, index, vocabulary, models)


def n_tasks(spark: SparkSession, n_rows: int) -> int:
    """As many tasks as run at once, times as often as it takes for each to have at most ``TASK_ROWS`` rows."""
    at_once = spark.sparkContext.defaultParallelism
    return at_once * max(1, math.ceil(n_rows / (at_once * TASK_ROWS)))


def model_benchmark(
    df: DataFrame, trained: Trained, split: str = "val", digits: int = 4, names: Sequence[str] | None = None
) -> DataFrame:
    """One row per model on one split: ``model, loss, accuracy, macro_f1, weighted_f1``, best first."""
    scored = trained.transform(df.where(F.col("split") == split), names)
    rows = scored.withColumn("row_loss", metrics.row_loss(F.col("probabilities"), F.col("label_id")))
    quality = metrics.overall_metrics(
        rows, trained.roles.label, "predicted", by=["model"], digits=digits, loss="row_loss"
    )
    return quality.orderBy(F.desc("macro_f1"), "model")


def select_model(benchmark: DataFrame) -> DataFrame:
    """The row with the best macro F1; equal scores go by name."""
    return benchmark.orderBy(F.desc("macro_f1"), "model").limit(1)


def test_evaluation(df: DataFrame, trained: Trained, name: str | None = None) -> DataFrame:
    """Scores of the selected model on the test split; selection looks at validation only."""
    if name is None:
        name = select_model(model_benchmark(df, trained)).first()["model"]
    return model_benchmark(df, trained, split="test", names=[name])
