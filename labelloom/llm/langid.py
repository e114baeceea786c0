"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams weighted by TF-IDF. The weights of the
classes are trained with follow-the-regularised-leader: each coordinate has its
own learning rate, and an elastic net (L1 and L2) decides which weights are
anything but zero. The temperature of the probabilities is then fitted on texts
that the weights haven't seen.

Document frequencies are counted over all texts to learn from, in place, with a
vector of counts per task. Weights and temperature take a bounded sample of them.

Defined results for odd input: a null text, or one without a letter, is ``und``
with score 0; rows that repeat an id are predicted one by one; a null id or a
null language is never learned from; without any text to learn from every
result is ``und``; of languages equally likely the first by name is given; an empty table gives an empty result. Columns other than id,
text and language are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.shared import ROW, numbered
from labelloom.operators.pin import settle

#: Lengths of n-grams and the number of features they are hashed to.
ORDERS = (1, 2, 3)
FEATURES = 1 << 15

#: Texts that weights and temperature are fitted on, over all languages, and the share of them for the temperature.
FIT_ROWS = 3000
TEMPERATURE_SHARE = 0.2

#: Numbers that ids are drawn from.
DRAWS = 1 << 31

#: Languages that can be told apart; more values in the column are an error.
MAX_LANGUAGES = 1000

#: Learning rate, its offset, elastic net, passes.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.05, 0.05, 4

TEMPERATURES = np.exp(np.linspace(np.log(0.02), np.log(20), 200))

#: Characters that are counted at a time.
BLOCK_CHARS = 1 << 20

UNDETERMINED = "und"

LETTER = regex.compile(r"\p{L}")


def counts(text: str) -> np.ndarray:
    """How often each feature occurs in the whole text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    found = np.zeros(FEATURES, np.int64)
    longest = max(ORDERS)
    for at in range(0, len(codes), BLOCK_CHARS):
        block = codes[at : at + BLOCK_CHARS + longest - 1]
        hashes = np.zeros(len(block), np.uint32)
        for n in range(1, longest + 1):
            # Each n-gram once: those that begin in this block.
            n_here = min(len(block) - n + 1, BLOCK_CHARS)
            if n_here <= 0:
                break
            hashes = (hashes[: len(block) - n + 1] ^ block[n - 1 :]) * np.uint32(0x9E3779B1)
            hashes ^= hashes >> np.uint32(15)
            if n in ORDERS:
                found += np.bincount(hashes[:n_here] & np.uint32(FEATURES - 1), minlength=FEATURES)
    return found


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts, column ``body``, and by feature the number that have it. One row per feature and task is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last place counts the texts.
        having = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for text in batch.column("body"):
                having[:-1] += counts(text.as_py()) > 0
                having[-1] += 1
        present = np.flatnonzero(having)
        yield pa.RecordBatch.from_arrays([pa.array(present.astype(np.int32)), pa.array(having[present])], ["feature", "n"])

    found = texts.select("body").mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    having = np.zeros(FEATURES + 1, np.int64)
    having[found["feature"].to_numpy()] = found["n"].to_numpy()
    return int(having[-1]), having[:-1]


def weighted(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text's features and their TF-IDF weights, scaled to length 1. Another feature, always 1, stands for the intercept."""
    found = counts(text)
    present = np.flatnonzero(found)
    values = (1 + np.log(found[present])) * idf[present]
    values /= max(np.sqrt((values * values).sum()), 1e-12)
    return np.append(present, FEATURES), np.append(values, 1.0)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], n_classes: int) -> np.ndarray:
    """Weights by class and feature."""
    z = np.zeros((n_classes, FEATURES + 1))
    squares = np.zeros_like(z)

    def weights(z: np.ndarray, squares: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(squares)) / ALPHA + L2)

    for _ in range(PASSES):
        for present, values, label in rows:
            z_here, squares_here = z[:, present], squares[:, present]
            w = weights(z_here, squares_here)
            error = softmax(w @ values)
            error[label] -= 1
            slope = error[:, None] * values
            grown = squares_here + slope * slope
            z[:, present] = z_here + slope - (np.sqrt(grown) - np.sqrt(squares_here)) / ALPHA * w
            squares[:, present] = grown
    return weights(z, squares).astype(np.float32)


def fitted_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The one of TEMPERATURES with the least loss."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        x = logits / t
        x = x - x.max(axis=1, keepdims=True)
        return float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(labels)), labels]).mean())

    return float(min(TEMPERATURES, key=loss))


class Model(NamedTuple):
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not LETTER.search(text):
            return UNDETERMINED, 0.0
        present, values = weighted(text, self.idf)
        p = softmax(self.weights[:, present] @ values / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def sample_of(texts: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """``ROW, lang, place``: about ``FIT_ROWS`` rows of ``texts``, never more, of each language as many, numbered.

    ``sizes`` are about how many ids each language has. Ids are drawn by a hash below a cut
    that leaves somewhat more than are needed; only these are ordered. Of rows
    that repeat id and language one can be drawn.
    """
    per_language = max(1, FIT_ROWS // len(sizes))
    cuts = F.create_map(*[F.lit(x) for language, n in sizes.items() for x in (language, int(min(1.0, (1.2 * per_language + 100) / n) * DRAWS))])
    draw = F.pmod(F.xxhash64("id"), F.lit(DRAWS))
    few = texts.where(draw < cuts[F.col("lang")]).groupBy("id", "lang").agg(F.min(ROW).alias(ROW))
    order = Window.partitionBy("lang").orderBy(draw, "id")
    return few.select(ROW, "lang", F.row_number().over(order).alias("place")).where(F.col("place") <= per_language)


def train(texts: DataFrame) -> Model | None:
    """A model of ``texts``, columns ``ROW, id, body, lang``."""
    sizes = {row.lang: row.n for row in texts.groupBy("lang").agg(F.approx_count_distinct("id", 0.02).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    languages = sorted(sizes)
    if not languages:
        return None
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values are no languages")
    n, having = document_frequencies(texts)
    idf = np.log((n + 1) / (having + 1)) + 1
    sample = settle(sample_of(texts, sizes))
    sent = texts.sparkSession.sparkContext.broadcast(idf)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [weighted(text.as_py(), sent.value) for text in batch.column("body")]
            columns = [pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("place"), *columns], ["lang", "place", "present", "values"])

    drawn = texts.select(ROW, "body").join(F.broadcast(sample), ROW).select("lang", "place", "body")
    seen = drawn.mapInArrow(features, "lang string, place int, present array<int>, values array<float>").toArrow()
    numbers = {language: i for i, language in enumerate(languages)}
    rows = _in_turns(seen, numbers)
    n_fit = len(rows) - int(len(rows) * TEMPERATURE_SHARE)
    weights = follow_the_leader(rows[:n_fit], len(languages))
    rest = rows[n_fit:]
    logits = np.array([weights[:, present] @ values for present, values, _ in rest])
    return Model(languages, idf, weights, fitted_temperature(logits, np.array([label for *_, label in rest], dtype=int)))


def _in_turns(seen: pa.Table, numbers: dict[str, int]) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Features, values and label of each row; languages take turns, so that none is learned last."""
    order = sorted(range(len(seen)), key=lambda i: (seen["place"][i].as_py(), seen["lang"][i].as_py()))
    return [
        (np.array(seen["present"][i].values), np.array(seen["values"][i].values, dtype=np.float64), numbers[seen["lang"][i].as_py()])
        for i in order
    ]


def identify(texts: DataFrame, model: Model | None) -> DataFrame:
    """``texts`` with ``lang_pred`` and ``score`` in place of ``body``."""
    rest = [c for c in texts.columns if c != "body"]
    if model is None:
        return texts.select(*rest, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = texts.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.predict(text.as_py()) for text in batch.column("body")]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *columns], [*rest, "lang_pred", "score"])

    kinds = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in rest)
    return texts.select(*rest, "body").mapInArrow(predict, f"{kinds}, lang_pred string, score double")


def language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_out_fold: int = 2
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``lang_pred``, ``score``.

    Rows are dealt to folds by the CRC-32 of the id as text; the held-out fold
    isn't learned from.
    """
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    held_out: Column = F.coalesce(fold == held_out_fold, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"), held_out.alias("held_out"))
    known = numbered(docs).select(ROW, F.col(id_col).alias("id"), F.col(text_col).alias("body"), held_out.alias("held_out"), F.col(lang_col).alias("lang"))
    model = train(known.where("not held_out and id is not null and body is not null and lang is not null").drop("held_out"))
    return identify(rows, model).withColumnRenamed("id", id_col)
