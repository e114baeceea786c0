"""Groups of spelling variants by pivotal grams.

Words and how often they occur are counted in every task and added up. Two words
are near if one insertion, deletion or replacement of a code point makes one of
the other. Candidates come from bigrams, ordered by how many words have them,
rare ones first. A word's prefix is its three rarest bigrams, with those as rare
as the third. Of these, dynamic programming picks the two that don't overlap and
are rarest together: the pivots. One edit can't touch both, so of two near words
the one whose prefix ends earlier in the order has a pivot in the prefix of the
other.

The pivot's place and the lengths of both words say where the edit is. It is
left or right of the pivot; on the other side the words are the same. So a pivot
looks up its bigram under the place it must have in a word of that length, with
a digest of the side that must be equal, and only words that also agree there
meet. What meets is verified by edit distance inside the join.

A word of n code points can have no more than 1 * n + 90 * (2 * n + 1) near ones
in an alphabet of 90, so no word gathers a share of all rows. Bigrams are at
most 90 * 90; their counts are the one thing that every task gets.

Words follow their forms up to a last one. Each form occurs at least ``ratio``
times as often as its word, so chains are short: at most log(n) / log(ratio).
They are followed by doubling.

Defined results for odd input: null and empty texts have no words; a null id
counts as an empty string in the digest of an occurrence; rows that repeat an id
or a text count each; near words of equal number go by code points; an empty
table gives an empty result. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators.pin import settle

#: Maximal runs of these are words; only A to Z have a lower case here.
RUN = re.compile("[A-Za-zÀ-ÿ]+")

#: Shortest word, fewest occurrences, and how many times as often a form occurs.
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5

#: A run loses a code point where this divides the digest of its occurrence.
NOISE = 199

#: Characters that are cut into runs at a time, and words that a task counts before it gives them out.
SLICE = 1 << 20
MAX_COUNTED = 400_000

#: Bigrams of the shortest prefix: one more than an edit can touch.
PREFIX = 3


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words with at least ``min_length`` code points and ``min_count`` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("_id"), batch.column("_text"), strict=True):
                for word, n in spelt_words(doc.as_py() or "", text.as_py() or "").items():
                    if len(word) >= min_length:
                        counts[word] += n
                if len(counts) > MAX_COUNTED:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_text"))
    found = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= min_count)


def spelt_words(doc: str, text: str) -> Counter[str]:
    """The runs of a text, lower-cased and with the code point deleted that the digest of id and run says."""
    runs: Counter[str] = Counter()
    at = 0
    while at < len(text):
        end = at + SLICE
        # A run isn't cut: the slice goes on to its end.
        if end < len(text) and (rest := RUN.match(text, end)):
            end = rest.end()
        runs.update(RUN.findall(text, at, end))
        at = end
    lowered: Counter[str] = Counter()
    for run, n in runs.items():
        lowered[run if run.islower() and run.isascii() else _lower(run)] += n
    words: Counter[str] = Counter()
    start = zlib.crc32(f"{doc}:".encode())
    for run, n in lowered.items():
        h = zlib.crc32(run.encode(), start)
        if h % NOISE == 0:
            gone = h % len(run)
            run = run[:gone] + run[gone + 1 :]
        words[run] += n
    return words


def _lower(run: str) -> str:
    return run.encode().lower().decode()


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])


def bigrams(word: str) -> list[str]:
    return [word[i : i + 2] for i in range(len(word) - 1)]


def prefix(grams: list[str], order: dict[str, tuple[int, str]]) -> list[int]:
    """Places of the rarest bigrams: three of them, and those that equal the third."""
    ranked = sorted(range(len(grams)), key=lambda i: (order[grams[i]], i))
    last = order[grams[ranked[PREFIX - 1]]]
    return sorted(i for i in ranked if order[grams[i]] <= last)


def pivots(places: list[int], costs: list[int]) -> tuple[int, int]:
    """The two places at least two apart with the least sum of costs, by dynamic programming over ``places`` in order.

    ``best`` is the cheapest single place among those that the current one doesn't overlap.
    """
    best, ahead, chosen = None, 0, None
    for k, place in enumerate(places):
        while places[ahead] <= place - 2:
            if best is None or costs[ahead] < costs[best]:
                best = ahead
            ahead += 1
        if best is not None:
            total = costs[best] + costs[k]
            if chosen is None or total < chosen[0]:
                chosen = total, places[best], place
    return chosen[1], chosen[2]


LEFT, RIGHT = "<", ">"


def _key(gram: str, place: int, length: int, side: str, same: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{gram}{place}/{length}{side}{same}") - (1 << 63)


def indexed_keys(word: str, places: list[int]) -> list[int]:
    """Keys under which a word's prefix is found: each bigram at its place, with the text on its left or on its right."""
    keys = []
    for i in places:
        gram = word[i : i + 2]
        keys += [_key(gram, i, len(word), LEFT, word[:i]), _key(gram, i, len(word), RIGHT, word[i + 2 :])]
    return keys


def probing_keys(word: str, places: tuple[int, int]) -> list[int]:
    """Keys that a near word has if it has one of these pivots.

    An edit on the right leaves the pivot's place and the text on its left; one
    on the left moves the pivot by the difference of lengths and leaves the text
    on its right.
    """
    keys = []
    for i in places:
        gram, left, right = word[i : i + 2], word[:i], word[i + 2 :]
        for more in (-1, 0, 1):
            keys += [_key(gram, i, len(word) + more, LEFT, left), _key(gram, i + more, len(word) + more, RIGHT, right)]
    return keys


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: every word of ``words`` with each of its near ones, once."""
    grams = words.select(F.explode(F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))")).alias("gram"))
    # At most the square of the alphabet.
    order = {row.gram: (row.m, row.gram) for row in grams.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).collect()}

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                indexed, probing = [], []
                for word in part.column("word").to_pylist():
                    found = bigrams(word)
                    places = prefix(found, order)
                    indexed.append(indexed_keys(word, places))
                    probing.append(probing_keys(word, pivots(places, [order[found[i]][0] for i in places])))
                both = [pa.array(column, pa.list_(pa.int64())) for column in (indexed, probing)]
                yield pa.RecordBatch.from_arrays([part.column("word"), part.column("n"), *both], ["word", "n", "indexed", "probing"])

    keyed = settle(words.mapInArrow(keys, "word string, n long, indexed array<long>, probing array<long>"))
    asked = keyed.select(F.explode("probing").alias("key"), "word", "n")
    index = keyed.select(F.explode("indexed").alias("key"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = settle(asked.join(index, "key").where(F.levenshtein("word", "near", 1) == 1).drop("key"))
    other_way = found.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.unionByName(other_way).distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: where following forms ends, for every word that has one."""
    roots = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = roots.join(further, "root", "left")
        longer = settle(stepped.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        roots = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return roots


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
) -> DataFrame:
    """Per word: ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word of largest n, where that is at least ``ratio``
    times the word's own; ``root`` is where forms end. Words of fewer than four
    code points have too few bigrams, so ``min_length`` is at least that.
    """
    if min_length <= PREFIX:
        raise ValueError(f"min_length is at least {PREFIX + 1}")
    words = settle(word_counts(docs, id_col, text_col, min_length, min_count))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    near = near_pairs(words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best)
    near = settle(near.select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"), (-F.col("best.less") >= ratio * F.col("n")).alias("is_form")))
    roots = last_forms(near.where("is_form"))
    found = words.join(near, "word", "left").join(roots, "word", "left")
    return found.select(
        "word",
        F.when(F.col("is_form"), F.col("form")).alias("form"),
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("is_form"), F.col("form_n")).alias("form_n"),
    )
