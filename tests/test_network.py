"""The classifier with rectified units: its gradient, its optimum, its training."""

import math
import time

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from labelloom.operators import models, network
from labelloom.operators.network import ReluClassifier, Rows, Shape


def made(n=200, n_features=12, n_classes=3, seed=5):
    """Sparse rows whose class is that of the group of features with the most weight, mostly."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        k = rng.integers(0, 6)
        at = np.sort(rng.choice(n_features, k, replace=False))
        values = rng.normal(1, 0.4, k)
        by_class = np.bincount(at % n_classes, weights=values, minlength=n_classes)
        label = int(by_class.argmax()) if rng.random() < 0.9 else int(rng.integers(n_classes))
        rows.append((at.tolist(), values.tolist(), label))
    return rows


def packed(rows):
    sizes = [len(r[0]) for r in rows]
    flat = [np.concatenate([np.array(r[c], kind) for r in rows]) for c, kind in ((0, np.int64), (1, float))]
    return Rows(*flat, np.concatenate(([0], np.cumsum(sizes))), np.array([r[2] for r in rows]))


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(Vectors.sparse(12, at, values) if i % 7 else Vectors.dense(Vectors.sparse(12, at, values).toArray()), label) for i, (at, values, label) in enumerate(made())]
    return spark.createDataFrame(rows, ["features", "label_id"]).repartition(5).cache()


@pytest.mark.parametrize("hidden", [0, 5])
def test_gradient_equals_finite_differences(monkeypatch, hidden):
    shape = Shape(12, hidden, 3)
    rows = packed(made(40))
    flat = np.random.default_rng(1).normal(0, 0.5, shape.n_parameters)
    gradient = np.zeros_like(flat)
    loss = network.add_loss(rows, shape, flat, gradient)
    for block in (20, 1 << 21):
        monkeypatch.setattr(network, "BLOCK", block)
        again = np.zeros_like(flat)
        assert math.isclose(network.add_loss(rows, shape, flat, again), loss) and np.allclose(again, gradient)
    for k in range(len(flat)):
        ends = []
        for e in (-1e-6, 1e-6):
            moved = flat.copy()
            moved[k] += e
            ends.append(network.add_loss(rows, shape, moved, None))
        assert abs((ends[1] - ends[0]) / 2e-6 - gradient[k]) < 1e-4


def test_tasks_add_up_to_the_whole(vectors):
    shape = Shape(12, 4, 3)
    flat = shape.start(3)
    gradient = np.zeros_like(flat)
    rows = packed(made())
    loss = network.add_loss(rows, shape, flat, gradient)
    found, found_gradient = network.mean_loss(network.entries(vectors), shape, flat)
    assert math.isclose(found, loss / 200) and np.allclose(found_gradient, gradient / 200)


def test_softmax_regression_reaches_its_optimum(vectors):
    trained = ReluClassifier(12, 3, 0, max_steps=200, tolerance=1e-7).fit(vectors)
    model = LogisticRegression(family="multinomial", regParam=0.0, maxIter=500, tol=1e-12, labelCol="label_id").fit(vectors)
    best = model.summary.objectiveHistory[-1]
    assert abs(trained.losses[-1] - best) < 1e-5
    assert all(b <= a for a, b in zip(trained.losses, trained.losses[1:]))


def test_hidden_units_learn_what_no_line_tells(spark):
    """Exclusive or: a linear classifier stays at chance."""
    rows = [(Vectors.dense([float(a), float(b)]), int(a != b)) for a in (0, 1) for b in (0, 1)] * 10
    df = spark.createDataFrame(rows, ["features", "label_id"])
    trained = ReluClassifier(2, 2, 8, max_steps=200, seed=1).fit(df)
    found = trained.transform(df).collect()
    assert all(int(np.argmax(r.probability)) == r.label_id and abs(sum(r.probability) - 1) < 1e-9 for r in found)
    assert ReluClassifier(2, 2, 0, max_steps=100).fit(df).losses[-1] > 0.69


def test_training_stops_on_validation_loss(spark, vectors):
    noise = made(60, seed=9)
    flipped = spark.createDataFrame([(Vectors.sparse(12, at, values), (label + 1) % 3) for at, values, label in noise], ["features", "label_id"])
    free = ReluClassifier(12, 3, 16, max_steps=40).fit(vectors)
    stopped = ReluClassifier(12, 3, 16, max_steps=40, patience=2).fit(vectors, flipped)
    assert len(stopped.losses) < len(free.losses)
    shape = free.shape
    losses = [network.mean_loss(network.entries(flipped), shape, n.parameters, False)[0] for n in (stopped, free)]
    assert losses[0] < losses[1]


def test_products_hold_few_lines_at_a_time(monkeypatch):
    """Every product was made at once, a line of units for each entry; sums over runs of entries are the same."""
    rows = packed([*made(60), ([], [], 1), (list(range(12)), [0.5] * 12, 2)])
    dense = np.zeros((62, 12))
    for i, (a, b) in enumerate(zip(rows.starts, rows.starts[1:])):
        dense[i, rows.indices[a:b]] = rows.values[a:b]
    rng = np.random.default_rng(2)
    weights, slopes = rng.normal(size=(12, 5)), rng.normal(size=(62, 5))
    taken = []
    monkeypatch.setattr(network.np, "take", lambda lines, at, take=np.take, **more: taken.append(len(at)) or take(lines, at, **more))
    for held in (1, 15, 1 << 16):
        monkeypatch.setattr(network, "GATHERED", held)
        taken.clear()
        gradient = np.ones((12, 5))
        rows.add_outer(slopes, gradient)
        assert np.allclose(rows.times(weights), dense @ weights) and np.allclose(gradient, 1 + dense.T @ slopes)
        assert sum(taken) == 2 * len(rows.indices) and max(taken) <= max(1, held // 5)


def test_features_that_the_weights_lack():
    for at in (-1, 12):
        with pytest.raises(IndexError):
            packed([([at], [1.0], 0)]).times(np.zeros((12, 5)))


def test_steps_are_kept_in_files():
    kept = network.in_file(np.arange(5.0))
    assert isinstance(kept, np.memmap) and kept.tolist() == [0, 1, 2, 3, 4]
    assert np.allclose(network.direction(np.ones(5), [(kept, 2 * kept)]), network.direction(np.ones(5), [(np.arange(5.0), 2 * np.arange(5.0))]))


def test_steps_leave_no_shuffle_files(spark, vectors):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    rows, shape = network.entries(vectors), Shape(12, 4, 3)

    def shuffles():
        return sum(str(f).rpartition("/")[2].startswith("shuffle_") for f in blocks.getAllFiles().mkString("\n").split("\n"))

    network.mean_loss(rows, shape, shape.start(3))
    before = shuffles()
    for _ in range(4):
        network.mean_loss(rows, shape, shape.start(3))
    time.sleep(1)
    assert shuffles() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_training_rows_are_dealt_evenly(spark, monkeypatch):
    """The parts of the table may be uneven: here, one holds every row. A step takes as long as its slowest task."""
    rows = [(i, f"{('apple', 'hammer')[i % 2]} thing{i % 5}", "ab"[i % 2], "train") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label string, split string").coalesce(1)
    sizes = []

    class Estimator:
        def fit(self, vectors):
            sizes.append(vectors.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect())

    monkeypatch.setattr(models, "TASK_ROWS", 30)
    models.train(df, chosen={"x": lambda n, k: Estimator()}, max_features=20, stop_words=[])
    monkeypatch.undo()
    models.train(df, chosen={"x": lambda n, k: Estimator()}, max_features=20, stop_words=[])
    at_once = spark.sparkContext.defaultParallelism
    assert [len(s) for s in sizes] == [at_once * math.ceil(400 / (at_once * 30)), at_once]
    assert all(sum(s) == 400 and max(s) <= min(s) + 2 for s in sizes)


def test_nothing_to_train_on(vectors):
    with pytest.raises(ValueError, match="no rows"):
        ReluClassifier(12, 3, 4).fit(vectors.where("label_id > 5"))


def test_as_a_variant(spark):
    """It is trained, chosen among and applied as the others are, and stops on validation rows."""
    words = {"a": "apple pear plum", "b": "hammer saw drill"}
    rows = [(i, f"{words['ab'[i % 2]].split()[i % 3]} thing{i % 5}", "ab"[i % 2], ("train", "train", "val")[(i // 6) % 3]) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label string, split string")
    trained = models.train(df, chosen=models.variants(hidden=8, iterations=30, rectified=True), max_features=20, stop_words=[])
    assert isinstance(trained.models["dense"], network.Network)
    scores = {r.model: r for r in models.model_benchmark(df, trained).collect()}
    assert set(scores) == set(trained.models) and all(r.n_rows == 36 for r in scores.values())
    assert scores["dense"].macro_f1 == 1.0
    scored = trained.transform(df, ["dense"]).collect()
    assert len(scored) == 120 and all(abs(sum(r.probabilities) - 1) < 1e-9 for r in scored)
