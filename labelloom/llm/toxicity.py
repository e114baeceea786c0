"""Toxicity by class-conditional Kneser-Ney models.

Two models of words, one of texts labelled toxic and one of ordinary ones. In
Kneser-Ney fashion a word's weight in a class is the number of different words
it has followed there, not how often it came: a passage copied a thousand times
counts once. The ordinary counts are brought to the size of the toxic ones, a
discount is taken from both, and what it frees goes to each word by its
followings in both classes together. So an expression too rare to tell has the
same probability in either model.

A text's evidence is the mean over its words of the difference of the two log
probabilities. Differences within a margin are drift of topic and language and
count as none. The margin, and the line that turns evidence into a probability,
are fitted, with the discount, on labelled texts that the models haven't seen. All statistics cover
all labelled texts; the fit alone takes a bounded sample.

Words are counted by a 64-bit hash in a written table that grows with the
corpus. The words with the most followings, fewer than ``BUCKETS``, are
broadcast; where the table has more, the other words of the documents are
joined to it.

Defined results for odd input: null and empty texts have no evidence and get the
score of none; rows that repeat an id are learned from and scored one by one; a
null id, or a null label, is never learned from; without texts of both classes
to learn from every score is 0, and without both to fit on the line says nothing
but their shares among those learned from; an empty table gives an empty result. Columns
other than id, text and label are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.shared import attach, with_few
from labelloom.operators.pin import settle

#: Places for words that are broadcast; the last one stays free and stands for the words without followings.
BUCKETS = 1 << 20

#: The share of a following that every word is given in the shared counts.
UNSEEN = 0.1

#: Followings that don't count, and margins, of which the best pair is taken.
DISCOUNTS = (0.75, 1.5, 3.0)
MARGINS = (0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0)

TRIED = [(i, margin) for i in range(len(DISCOUNTS)) for margin in MARGINS]

#: Labelled texts that margin and line are fitted on, at most.
FIT_ROWS = 20_000

#: Labels that are broadcast to the texts, at most; more are looked up through a Bloom filter.
MAX_LABELS = 1_000_000

#: Weight of the penalty that keeps the line's slope finite.
RIDGE = 1e-3

#: Words whose numbers a worker remembers, and followings collected before they are given out.
MAX_WORDS = 300_000
LOT = 1_000_000

#: An odd factor; for a given word, the words before it and the products with it correspond one to one.
MIX = np.int64(-7046029254386353131)

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        bare = word.strip(PUNCTUATION)
        digest = xxhash.xxh3_64_intdigest(bare) if bare else 0
        found = self[word] = digest - (1 << 64) if digest >> 63 else digest
        return found


_NUMBERS = _Numbers()


def numbers(text: str | None) -> np.ndarray:
    """The text's words as numbers, in lower case and without punctuation around them."""
    if len(_NUMBERS) > MAX_WORDS:
        _NUMBERS.clear()
    return np.array(list(map(_NUMBERS.__getitem__, (text or "").lower().split())), dtype=np.int64)


def followings(texts: DataFrame) -> DataFrame:
    """Per word number: the different words it follows in either class, ``ordinary`` and ``toxic``, and in ``both`` together.

    ``texts`` has ``body`` and ``toxic``. A task gives out each following once
    for a million words, so that frequent ones don't pile up.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lots: tuple[list, list] = ([], [])

        def give() -> Iterator[pa.RecordBatch]:
            for toxic, lot in enumerate(lots):
                if lot:
                    words = np.concatenate([found for _, found in lot])
                    pair, at = np.unique(np.concatenate([before for before, _ in lot]) * MIX + words, return_index=True)
                    classes = np.full(len(at), toxic + 1, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(words[at]), pa.array(pair), pa.array(classes)], ["word", "pair", "classes"])
                    lot.clear()

        held = 0
        for batch in batches:
            for text, toxic in zip(batch.column("body"), batch.column("toxic").to_pylist(), strict=True):
                found = numbers(text.as_py())
                if len(found):
                    lots[toxic].append((np.concatenate(([0], found[:-1])), found))
                    held += len(found)
                if held >= LOT:
                    yield from give()
                    held = 0
        yield from give()

    # Classes as bits: 1 is ordinary, 2 is toxic.
    found = texts.select("body", "toxic").mapInArrow(pairs, "word long, pair long, classes int")
    by_pair = found.groupBy("word", "pair").agg(F.bit_or("classes").alias("classes"))
    return by_pair.groupBy("word").agg(
        F.count_if(F.col("classes") >= 2).alias("toxic"), F.count_if(F.col("classes") != 2).alias("ordinary"), F.count(F.lit(1)).alias("both")
    )


KINDS = ("toxic", "ordinary", "both")


class Sums(NamedTuple):
    """Over all words: followings, words, and what each discount leaves of the followings of a class."""

    totals: dict[str, float]
    n_words: int
    kept: dict[tuple[str, float], float]

    @property
    def size(self) -> float:
        return min(self.totals["toxic"], self.totals["ordinary"])

    @classmethod
    def of(cls, values: dict[str, np.ndarray], times: dict[str, np.ndarray], n_words: int) -> Sums | None:
        """From the different counts ``values`` and how many words have each; None without both classes."""
        sums = cls({name: float((values[name] * times[name]).sum()) for name in KINDS}, n_words, {})
        if not sums.size:
            return None
        for name in ("toxic", "ordinary"):
            for discount in DISCOUNTS:
                sums.kept[name, discount] = float((_kept(values[name], name, discount, sums) * times[name]).sum())
        return sums


def _kept(counts: np.ndarray, name: str, discount: float, sums: Sums) -> np.ndarray:
    return np.maximum(counts * (sums.size / sums.totals[name]) - discount, 0)


def log_ratios(columns: dict[str, np.ndarray], sums: Sums) -> np.ndarray:
    """By discount and word, the log probability in the toxic model less that in the ordinary one."""
    shared = (columns["both"] + UNSEEN) / (sums.totals["both"] + UNSEEN * sums.n_words)

    def log_p(name: str, discount: float) -> np.ndarray:
        return np.log((_kept(columns[name], name, discount, sums) + (sums.size - sums.kept[name, discount]) * shared) / sums.size)

    return np.array([log_p("toxic", d) - log_p("ordinary", d) for d in DISCOUNTS], np.float32)


def evidence_of_words(counts: pa.Table, sums: Sums | None = None) -> np.ndarray | None:
    """By discount and place, the :func:`log_ratios` of the words at the places ``word``; None without both classes.

    Without ``sums`` the words in ``counts`` are all there are.
    """
    columns = {}
    for name in KINDS:
        columns[name] = np.zeros(BUCKETS)
        columns[name][counts["word"].to_numpy()] = counts[name].to_numpy()
    sums = sums or Sums.of(columns, {name: np.ones(BUCKETS) for name in KINDS}, BUCKETS)
    return sums and log_ratios(columns, sums)


class Words(NamedTuple):
    """The evidence of all words: the broadcast ones sorted, ``of_places`` by discount and place, and a table of the others or None."""

    hot: np.ndarray
    of_places: np.ndarray
    others: DataFrame | None


def words_of(counts: DataFrame) -> Words | None:
    """What the :func:`followings` ``counts``, which are settled, say of each word; None without both classes.

    Only numbers of words by count, and the broadcast words, come to the driver.
    The table of the others has ``word, ratios``; those whose followings fall
    under every discount in both classes are left out, as their evidence is that
    of words without followings.
    """
    kinds = F.array(*[F.struct(F.lit(name).alias("kind"), F.col(name).alias("value")) for name in KINDS])
    seen = counts.select(F.inline(kinds)).groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "value").toArrow()
    kind, value, n = (seen[c].to_numpy() for c in ("kind", "value", "n"))
    values, times = ({name: column[kind == name].astype(float) for name in KINDS} for column in (value, n))
    sums = Sums.of(values, times, int(times["both"].sum()) + 1)
    if sums is None:
        return None
    from_most = np.cumsum(times["both"][::-1])[::-1]
    fitting = values["both"][from_most < BUCKETS]
    least = int(fitting.min()) if len(fitting) else int(values["both"].max()) + 1
    table = counts.where(F.col("both") >= least).toArrow().sort_by("word")
    hot = table["word"].to_numpy()
    of_places = evidence_of_words(table.set_column(table.schema.get_field_index("word"), "word", pa.array(np.arange(len(hot)))), sums)
    if from_most[0] < BUCKETS:
        return Words(hot, of_places, None)

    def ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = log_ratios({name: batch.column(name).to_numpy().astype(float) for name in KINDS}, sums).T
            rows = pa.array(found.astype(float).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("word"), rows], ["word", "ratios"])

    counts_left = [F.col(name) * F.lit(sums.size / sums.totals[name]) > min(DISCOUNTS) for name in ("toxic", "ordinary")]
    others = counts.where((F.col("both") < least) & (counts_left[0] | counts_left[1]))
    return Words(hot, of_places, settle(others.mapInArrow(ratios, "word long, ratios array<double>")))


def places(found: np.ndarray, hot: np.ndarray, free: int) -> np.ndarray:
    """Where the words lie in ``hot``; the place ``free`` for those that don't."""
    if not len(hot):
        return np.full(len(found), free)
    at = np.minimum(np.searchsorted(hot, found), len(hot) - 1)
    return np.where(hot[at] == found, at, free)


def evidence(found: np.ndarray, of_words: np.ndarray, margin: float) -> float:
    """The mean evidence of a text's words beyond the margin."""
    if not len(found):
        return 0.0
    each = of_words[found].astype(np.float64)
    return float((np.maximum(each - margin, 0) - np.maximum(-each - margin, 0)).mean())


def fitted_line(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Slope, intercept and mean loss of the logistic line for labels ``y``, by Newton's steps."""
    scale = x.std() or 1.0
    design = np.stack((x / scale, np.ones(len(x))))
    line = np.zeros(2)
    penalty = RIDGE * np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(line @ design, -30, 30)))
        slope = design @ (p - y) / len(y) + penalty * line
        curve = (design * (p * (1 - p))) @ design.T / len(y) + np.diag(penalty + 1e-9)
        line = line - np.linalg.solve(curve, slope)
    p = np.clip(1 / (1 + np.exp(-np.clip(line @ design, -30, 30))), 1e-12, 1 - 1e-12)
    return line[0] / scale, line[1], float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def evidences(texts: DataFrame, words: Words, tried: list[tuple[int, float]]) -> DataFrame:
    """``texts`` with ``evidence`` in place of ``body``: the :func:`evidence` for each pair of discount and margin in ``tried``.

    Words that aren't broadcast are counted as having no followings at first.
    If the table has others, each row's are joined to it, and what they differ
    by is added; a frequent word's line of the table is broadcast.
    """
    rest = [c for c in texts.columns if c != "body"]
    sent = texts.sparkSession.sparkContext.broadcast((words.hot, words.of_places))
    joins = words.others is not None
    other_type = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())]))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, of_places = sent.value
        free = of_places.shape[1] - 1
        for batch in batches:
            values, n_words, others = [], [], []
            for text in batch.column("body"):
                found = numbers(text.as_py())
                at = places(found, hot, free)
                values.append([evidence(at, of_places[i], margin) for i, margin in tried])
                n_words.append(len(found))
                each, times = np.unique(found[at == free], return_counts=True) if joins else ([], [])
                others.append([{"word": int(w), "n": int(n)} for w, n in zip(each, times, strict=True)])
            columns = [pa.array(values, pa.list_(pa.float64())), pa.array(n_words, pa.int64()), pa.array(others, other_type)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *columns], [*rest, "evidence", "_n", "_others"])

    kinds = "".join(f"`{c}` {texts.schema[c].dataType.simpleString()}, " for c in rest)
    found = texts.select(*rest, "body").mapInArrow(first, f"{kinds}evidence array<double>, _n long, _others array<struct<word: long, n: long>>")
    if not joins:
        return found.drop("_n", "_others")
    # The row numbers are fixed by being written.
    found = settle(found.withColumn("_row", F.monotonically_increasing_id()))
    each = found.select("_row", F.inline("_others"))
    sizes = each.groupBy("word").agg(F.count(F.lit(1)).alias("size"))
    known = settle(sizes.join(words.others, "word", "left"))
    met = attach(each, known, "word", "size", each.count()).where("ratios is not null")
    beyond = lambda x, margin: F.greatest(x - margin, F.lit(0.0)) - F.greatest(-x - margin, F.lit(0.0))
    unseen = [float(x) for x in words.of_places[:, -1]]
    more = [F.sum(F.col("n") * (beyond(F.col("ratios")[i], margin) - beyond(F.lit(unseen[i]), margin))).alias(f"_{k}") for k, (i, margin) in enumerate(tried)]
    added = met.groupBy("_row").agg(*more)
    sums = [F.col("evidence")[k] + F.coalesce(F.col(f"_{k}") / F.col("_n"), F.lit(0.0)) for k in range(len(tried))]
    return found.join(added, "_row", "left").select(*rest, F.array(*sums).alias("evidence"))


class Model(NamedTuple):
    words: Words
    discount: int
    margin: float
    slope: float
    intercept: float


def train(rows: DataFrame, labels: DataFrame, learning: Column, fitting: Column) -> Model | None:
    """The models of ``rows``, columns ``id, body, fold``, by ``labels``, columns ``id, toxic``.

    Rows where ``learning`` holds make the models; of those where ``fitting``
    holds a bounded sample, which is broadcast, sets discount, margin and line.
    """
    labels = settle(labels)
    learned = with_few(rows.where(learning).where("id is not null"), labels, "id", MAX_LABELS).where("toxic is not null")
    words = words_of(settle(followings(learned)))
    if words is None:
        return None
    labelled = rows.where(fitting).select("id").join(labels, "id").distinct()
    chosen = settle(labelled.select("id", "toxic", F.xxhash64("id").alias("order")).orderBy("order", "id").limit(FIT_ROWS))
    sample = rows.where(fitting).select("id", "body").join(F.broadcast(chosen.select("id", "toxic")), "id").select("body", "toxic")
    seen = evidences(sample, words, TRIED).limit(2 * FIT_ROWS).toArrow()
    truth = seen["toxic"].to_numpy().astype(float)
    if not 0 < truth.sum() < len(truth):
        # Nothing to fit a line on: a text without evidence is as likely toxic as those learned from are.
        n, toxic = rows.where(learning).select("id").join(labels, "id").agg(F.count(F.lit(1)), F.sum("toxic")).first()
        return Model(words, 0, MARGINS[0], 1.0, float(np.log(toxic / (n - toxic))))
    found = np.array(seen["evidence"].to_pylist())
    lines = [fitted_line(found[:, i], truth) for i in range(len(TRIED))]
    best = min(range(len(TRIED)), key=lambda i: lines[i][2])
    return Model(words, *TRIED[best], *map(float, lines[best][:2]))


def score(texts: DataFrame, model: Model | None) -> DataFrame:
    """``texts`` with ``score`` in place of ``body``."""
    rest = [c for c in texts.columns if c != "body"]
    if model is None:
        return texts.select(*rest, F.lit(0.0).alias("score"))
    found = evidences(texts, model.words, [(model.discount, model.margin)])
    line = F.lit(model.slope) * F.col("evidence")[0] + F.lit(model.intercept)
    return found.select(*rest, (1 / (1 + F.exp(-F.greatest(F.least(line, F.lit(30.0)), F.lit(-30.0))))).alias("score"))


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5
) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score``, ``predicted``.

    Rows are dealt to folds by the CRC-32 of the id as text. Fold 0 is held out,
    fold 1 is what margin and line are fitted on, the others make the models.
    """
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"), fold.alias("fold"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("toxic in (0, 1)")
    # A label that contradicts another one of its id is not a label.
    known = known.groupBy("id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").drop("most")
    model = train(rows, known, F.col("fold") > 1, F.col("fold") == 1)
    scored = score(rows, model)
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(F.col("fold") == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
