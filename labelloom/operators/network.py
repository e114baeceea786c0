"""A classifier with one hidden layer of rectified units over sparse vectors.

Training is data-parallel: each task adds up loss and gradient over its rows,
from the entries that a sparse vector has, and the sums of the tasks are added
up slice by slice in several places. The driver holds the parameters, one gradient and a few steps of history, half of it in
files, whatever the number of rows, and takes quasi-Newton steps with a line search. It stops
when the loss on validation rows no longer falls, or the gradient is small.

Without hidden units the classifier is a softmax regression, whose loss has a
single optimum.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Units of rows, and entries of rows, that a task holds at a time.
BLOCK = 1 << 20

#: Numbers that are gathered before they are added up; they stay in a core's cache.
GATHERED = 1 << 16

#: Numbers of a gradient that are added up in one place, a megabyte.
SLICE = 1 << 17

#: Steps that the curvature is estimated from.
HISTORY = 8

#: The share of the expected decrease that a step must bring, and how often a step is halved at most.
ENOUGH, HALVINGS = 1e-4, 20


@dataclass(frozen=True)
class Shape:
    """Numbers of features, hidden units and classes, and where the layers lie in the flat parameters."""

    n_features: int
    hidden: int
    n_classes: int

    @property
    def sizes(self) -> list[tuple[int, ...]]:
        if not self.hidden:
            return [(self.n_features, self.n_classes), (self.n_classes,)]
        return [(self.n_features, self.hidden), (self.hidden,), (self.hidden, self.n_classes), (self.n_classes,)]

    def layers(self, flat: np.ndarray) -> list[np.ndarray]:
        """Views of the flat parameters, weights and offsets in turn."""
        found, at = [], 0
        for size in self.sizes:
            n = math.prod(size)
            found.append(flat[at : at + n].reshape(size))
            at += n
        return found

    @property
    def n_parameters(self) -> int:
        return sum(map(math.prod, self.sizes))

    def start(self, seed: int) -> np.ndarray:
        """Weights drawn evenly within bounds that keep the layers' outputs of one scale; offsets 0. A softmax regression starts at 0."""
        flat = np.zeros(self.n_parameters)
        if self.hidden:
            draw = np.random.default_rng(seed)
            for layer in self.layers(flat)[::2]:
                bound = math.sqrt(6 / sum(layer.shape))
                layer[:] = draw.uniform(-bound, bound, layer.shape)
        return flat


@dataclass
class Rows:
    """Sparse rows: ``values`` at the features ``indices``, row by row from ``starts`` on, and their classes."""

    indices: np.ndarray
    values: np.ndarray
    starts: np.ndarray
    labels: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Rows:
        sizes = batch.column("indices").value_lengths().to_numpy(zero_copy_only=False)
        flat = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("indices", "values")]
        labels = batch.column("label_id").to_numpy(zero_copy_only=False) if "label_id" in batch.schema.names else np.zeros(len(batch))
        return cls(flat[0].astype(np.int64), flat[1].astype(np.float64), np.concatenate(([0], np.cumsum(sizes))), labels.astype(np.int64))

    def blocks(self, width: int) -> Iterator[Rows]:
        """Runs of rows whose units and entries stay within a bound; a row is never cut."""
        at, n = 0, len(self.labels)
        while at < n:
            end = int(np.searchsorted(self.starts, self.starts[at] + BLOCK, side="right")) - 1
            end = min(n, max(at + 1, min(end, at + BLOCK // max(1, width))))
            a, b = self.starts[at], self.starts[end]
            yield Rows(self.indices[a:b], self.values[a:b], self.starts[at : end + 1] - a, self.labels[at:end])
            at = end

    def times(self, weights: np.ndarray) -> np.ndarray:
        """The rows times a matrix with a line per feature."""
        if len(self.indices) and not 0 <= self.indices.min() <= self.indices.max() < len(weights):
            raise IndexError(f"features are numbered from 0 to {len(weights) - 1}")
        sums = np.zeros((len(self.labels), weights.shape[1]))
        add_lines(self.starts, self.indices, self.values, weights, sums)
        return sums

    def add_outer(self, slopes: np.ndarray, gradient: np.ndarray) -> None:
        """Add to ``gradient`` the rows, turned, times ``slopes``."""
        if not len(self.indices):
            return
        # Sorting numbers of 16 bits is a counting sort.
        order = np.argsort(self.indices.astype(np.uint16) if len(gradient) <= 1 << 16 else self.indices, kind="stable")
        rows = np.repeat(np.arange(len(self.labels)), np.diff(self.starts))[order]
        indices = self.indices[order]
        first = np.flatnonzero(np.concatenate(([True], indices[1:] != indices[:-1])))
        add_lines(np.append(first, len(indices)), rows, self.values[order], slopes, gradient, indices[first])


def add_lines(starts: np.ndarray, at: np.ndarray, values: np.ndarray, lines: np.ndarray, sums: np.ndarray, places: np.ndarray | None = None) -> None:
    """Add up ``values`` times the ``lines`` that lie ``at`` them, from each of ``starts`` to the next, in the line of ``sums`` of the same
    place, or of ``places``.

    The lines of a sum are copied side by side, so many that they stay in the cache, and multiplied at once.
    """
    step = max(1, GATHERED // lines.shape[1])
    held = np.empty((min(step, len(at)), lines.shape[1]))
    bounds = starts.tolist()
    for a, b, place in zip(bounds, bounds[1:], range(len(bounds) - 1) if places is None else places.tolist()):
        for c in range(a, b, step):
            d = min(c + step, b)
            # Without a check of the bounds, numpy writes into the held lines directly.
            sums[place] += values[c:d] @ np.take(lines, at[c:d], axis=0, out=held[: d - c], mode="clip")


def outputs(rows: Rows, shape: Shape, flat: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
    """The hidden units of each row, None without any, and its log probabilities."""
    layers = shape.layers(flat)
    hidden = None
    if shape.hidden:
        hidden = np.maximum(rows.times(layers[0]) + layers[1], 0)
        scores = hidden @ layers[2] + layers[3]
    else:
        scores = rows.times(layers[0]) + layers[1]
    scores = scores - scores.max(axis=1, keepdims=True)
    return hidden, scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def add_loss(rows: Rows, shape: Shape, flat: np.ndarray, gradient: np.ndarray | None) -> float:
    """The loss summed over ``rows``; its gradient is added to ``gradient``."""
    total = 0.0
    for some in rows.blocks(max(shape.hidden, shape.n_classes)):
        hidden, log_p = outputs(some, shape, flat)
        here = np.arange(len(some.labels))
        total -= float(log_p[here, some.labels].sum())
        if gradient is None:
            continue
        slopes = np.exp(log_p)
        slopes[here, some.labels] -= 1
        parts = shape.layers(gradient)
        parts[-1] += slopes.sum(axis=0)
        if shape.hidden:
            parts[2] += hidden.T @ slopes
            slopes = (slopes @ shape.layers(flat)[2].T) * (hidden > 0)
            parts[1] += slopes.sum(axis=0)
        some.add_outer(slopes, parts[0])
    return total


def entries(vectors: DataFrame, features: str = "features") -> DataFrame:
    """``vectors`` with ``indices, values`` of the sparse or dense vectors in place of ``features``."""
    udt = F.unwrap_udt(features)
    every = F.transform(F.sequence(F.lit(0), F.size(udt["values"]) - 1), lambda i: i)
    indices = F.when(udt["type"] == 0, udt["indices"]).otherwise(F.when(F.size(udt["values"]) > 0, every).otherwise(F.array().cast("array<int>")))
    return vectors.select(*[c for c in vectors.columns if c != features], indices.alias("indices"), udt["values"].alias("values"))


def mean_loss(rows: DataFrame, shape: Shape, flat: np.ndarray, with_gradient: bool = True) -> tuple[float, np.ndarray]:
    """Mean loss over ``rows``, columns ``indices, values, label_id``, and its gradient, empty if not asked for.

    Each task sends its sums in slices; the slices of one place are added up
    together, so the driver gets one gradient.
    """
    context = rows.sparkSession.sparkContext
    sent = context.broadcast(flat)
    size = shape.n_parameters if with_gradient else 0
    n_slices = max(1, -(-size // SLICE))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient, loss, n = np.zeros(size), 0.0, 0
        for batch in batches:
            loss += add_loss(Rows.of(batch), shape, sent.value, gradient if with_gradient else None)
            n += len(batch)
        for k in range(n_slices if n else 0):
            yield _sums(k, (loss, n) if k == 0 else (0.0, 0), gradient[k * SLICE : (k + 1) * SLICE])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for k, loss, n, part in zip(*(batch.column(c) for c in SUMS), strict=True):
                part = np.frombuffer(part.as_buffer())
                so_far = found.setdefault(k.as_py(), [0.0, 0, np.zeros(len(part))])
                so_far[0] += loss.as_py()
                so_far[1] += n.as_py()
                so_far[2] += part
        for k, (loss, n, part) in found.items():
            yield _sums(k, (loss, n), part)

    schema = "slice int, loss double, n long, part binary"
    places = min(n_slices, context.defaultParallelism)
    sums = rows.select("indices", "values", "label_id").mapInArrow(partial, schema)
    with shuffles_removed(rows.sparkSession):
        found = sorted(sums.repartition(places, "slice").mapInArrow(add, schema).collect(), key=lambda row: row.slice)
    sent.destroy()
    n = sum(row.n for row in found)
    if not n:
        raise ValueError("there are no rows to train on")
    gradient = np.concatenate([np.frombuffer(row.part) for row in found])
    gradient /= n
    return sum(row.loss for row in found) / n, gradient


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Results that are collected meanwhile delete their shuffle files at once, not when the driver next clears its memory: a
    training has a shuffle per step."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


SUMS = ["slice", "loss", "n", "part"]


def _sums(k: int, counted: tuple[float, int], part: np.ndarray) -> pa.RecordBatch:
    loss, n = counted
    return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([loss]), pa.array([n]), pa.array([part.tobytes()], pa.binary())], SUMS)


@dataclass(frozen=True)
class Network:
    """A trained classifier, with the losses of its training by step."""

    shape: Shape
    parameters: np.ndarray
    losses: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame, probability: str = "probability", features: str = "features") -> DataFrame:
        """``df`` with an array of probabilities per row."""
        sent = df.sparkSession.sparkContext.broadcast(self.parameters)
        shape = self.shape

        @F.arrow_udf("array<double>")
        def probabilities(indices: pa.Array, values: pa.Array) -> pa.Array:
            rows = Rows.of(pa.RecordBatch.from_arrays([indices, values], ["indices", "values"]))
            found = [np.exp(outputs(some, shape, sent.value)[1]) for some in rows.blocks(max(shape.hidden, shape.n_classes))]
            found = np.concatenate(found) if found else np.zeros((0, shape.n_classes))
            ends = np.arange(len(found) + 1, dtype=np.int32) * shape.n_classes
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))

        located = entries(df.withColumn("_entries", F.col(features)), "_entries")
        return located.withColumn(probability, probabilities("indices", "values")).drop("indices", "values")


@dataclass(frozen=True)
class ReluClassifier:
    """Trains a :class:`Network` on ``features, label_id``."""

    n_features: int
    n_classes: int
    hidden: int
    max_steps: int = 50
    seed: int = 42
    tolerance: float = 1e-4
    patience: int = 3

    def fit(self, vectors: DataFrame, validation: DataFrame | None = None) -> Network:
        """Steps until the gradient's largest entry is below ``tolerance``, or the best loss on ``validation`` is ``patience`` steps old."""
        shape = Shape(self.n_features, self.hidden, self.n_classes)
        rows, unseen = entries(vectors), None if validation is None else entries(validation)
        here = shape.start(self.seed)
        loss, gradient = mean_loss(rows, shape, here)
        losses, history = [loss], []
        best, best_loss, age = here, math.inf, 0
        for _ in range(self.max_steps):
            if np.abs(gradient).max() < self.tolerance:
                break
            step = direction(gradient, history)
            slope = float(step @ gradient)
            length = 1.0 if history else min(1.0, 1.0 / float(np.abs(gradient).sum())) * 10
            for _ in range(HALVINGS):
                ahead = here + length * step
                next_loss, next_gradient = mean_loss(rows, shape, ahead)
                if next_loss <= loss + ENOUGH * length * slope:
                    break
                length /= 2
            else:
                break
            moved, turned = ahead - here, next_gradient - gradient
            if float(moved @ turned) > 1e-12:
                history = [*history[1 - HISTORY :], (moved, in_file(turned))]
            del moved, turned
            here, loss, gradient = ahead, next_loss, next_gradient
            losses.append(loss)
            if unseen is not None:
                seen_loss, _ = mean_loss(unseen, shape, here, with_gradient=False)
                age += 1
                if seen_loss < best_loss:
                    best, best_loss, age = here, seen_loss, 0
                elif age >= self.patience:
                    break
        return Network(shape, here if unseen is None or math.isinf(best_loss) else best, losses)


def in_file(numbers: np.ndarray) -> np.ndarray:
    """``numbers`` in a file of the driver's, which goes with them, instead of its memory."""
    with tempfile.TemporaryFile() as file:
        kept = np.memmap(file, numbers.dtype, "w+", shape=numbers.shape)
    kept[:] = numbers
    return kept


def direction(gradient: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the gradient times the inverse curvature that the last steps tell of."""
    q, factors = gradient.copy(), []
    for moved, turned in reversed(history):
        factor = float(moved @ q) / float(moved @ turned)
        factors.append(factor)
        q -= factor * turned
    if history:
        moved, turned = history[-1]
        q *= float(moved @ turned) / float(turned @ turned)
    for (moved, turned), factor in zip(history, reversed(factors), strict=True):
        q += (factor - float(turned @ q) / float(moved @ turned)) * moved
    return -q
