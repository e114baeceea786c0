"""Evaluation against the definitions written out in Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from labelloom.operators import metrics


def scored(spark, pairs):
    return spark.createDataFrame([(i, f"text {i}", t, p) for i, (t, p) in enumerate(pairs)], "doc_id int, text string, truth string, guess string")


def by_hand(pairs):
    labels = sorted({x for pair in pairs for x in pair})
    rows = {}
    for label in labels:
        hits = sum(t == p == label for t, p in pairs)
        support, claimed = sum(t == label for t, _ in pairs), sum(p == label for _, p in pairs)
        precision, recall = (hits / n if n else 0.0 for n in (claimed, support))
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        rows[label] = (precision, recall, f1, support)
    n = len(pairs)
    accuracy = sum(t == p for t, p in pairs) / n
    macro = [sum(r[k] for r in rows.values()) / len(rows) for k in range(3)]
    weighted = [sum(r[k] * r[3] for r in rows.values()) / n for k in range(3)]
    return rows, accuracy, macro, weighted


RANDOM = [(random.Random(i).choice("abcd"), random.Random(i + 1000).choice("abce")) for i in range(200)]
CASES = [RANDOM, [("a", "a"), ("b", "b")], [("a", "b")], [("a", "a"), ("a", "b"), ("c", "a")]]


@pytest.mark.parametrize("pairs", CASES)
def test_metrics(spark, pairs):
    df = scored(spark, pairs)
    rows, accuracy, macro, weighted = by_hand(pairs)
    total = metrics.overall_metrics(df, "truth", "guess").first()
    assert (total["n_rows"], total["accuracy"], total["macro_f1"], total["weighted_f1"]) == pytest.approx(
        (len(pairs), accuracy, macro[2], weighted[2])
    )
    report = {r["label"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in metrics.classification_report(df, "truth", "guess").collect()}
    assert report.pop("accuracy") == (None, None, pytest.approx(accuracy), len(pairs))
    assert report.pop("macro avg") == pytest.approx((*macro, len(pairs)))
    assert report.pop("weighted avg") == pytest.approx((*weighted, len(pairs)))
    assert report.keys() == rows.keys()
    for label, values in rows.items():
        assert report[label] == pytest.approx(values)


def test_perfect_predictions(spark):
    df = spark.range(6).select("id", F.array(*[(F.col("id") == i).cast("double") for i in range(6)]).alias("p"))
    guessed = metrics.with_argmax(df, "p")
    row = metrics.overall_metrics(guessed, "id", "predicted").first()
    assert (row["accuracy"], row["macro_f1"], row["weighted_f1"]) == (1.0, 1.0, 1.0)


def test_argmax_takes_the_first_of_ties(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), ([1.0],), ([0.5, 0.5],)], "p array<double>")
    assert [r["predicted"] for r in metrics.with_argmax(df, "p").collect()] == [1, 0, 0]


def test_confusion_matrix_is_zero_filled(spark):
    df = scored(spark, [("a", "a"), ("a", "c"), ("b", "a")])
    cells = {(r["truth"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df, "truth", "guess").collect()}
    assert len(cells) == 9 and sum(cells.values()) == 3 and cells["a", "c"] == 1 and cells["c", "c"] == 0
    wide = {r["truth"]: r.asDict() for r in metrics.confusion_wide(df, "truth", "guess", ["a", "b", "c"]).collect()}
    assert wide["a"] == {"truth": "a", "a": 1, "b": 0, "c": 1}


def test_groups_are_evaluated_apart(spark):
    one = scored(spark, CASES[3]).withColumn("model", F.lit("x"))
    two = scored(spark, CASES[1]).withColumn("model", F.lit("y"))
    rows = {r["model"]: r for r in metrics.overall_metrics(one.unionByName(two), "truth", "guess", ["model"]).collect()}
    assert rows["y"]["accuracy"] == 1.0 and rows["x"]["accuracy"] == pytest.approx(1 / 3)


def test_loss_is_clipped_and_averaged(spark):
    df = spark.createDataFrame(
        [("a", "a", 0, [0.25, 0.75]), ("b", "b", 1, [1.0, 0.0])], "truth string, guess string, i int, p array<double>"
    ).withColumn("loss", metrics.row_loss(F.col("p"), F.col("i")))
    row = metrics.overall_metrics(df, "truth", "guess", loss="loss").first()
    assert row["loss"] == pytest.approx((-math.log(0.25) - math.log(1e-7)) / 2)


def test_errors(spark):
    df = scored(spark, [("a", "a"), ("a", "b"), ("b", None), ("b", "a")])
    assert tuple(metrics.error_summary(df, "truth", "guess").first()) == (3, 4, 75.0)
    preview = metrics.misclassified_preview(df, "truth", "guess", ["doc_id"], k=2, width=3).collect()
    assert [(r["doc_id"], r["preview"]) for r in preview] == [(1, "tex"), (2, "tex")]
    assert metrics.error_summary(df.limit(0), "truth", "guess").first()["error_pct"] == 0.0
