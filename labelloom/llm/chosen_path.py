"""Set similarity join of documents by chosen paths.

A document is the set of its five-word shingles; two are linked when the Jaccard
similarity of their sets is 0.8 or more. Documents with the same set form a
class, and only one document of a class takes part in what follows.

A run splits the classes: each follows some tokens of its MinHash signature,
chosen by a hash that the run and the path so far seed, so that similar classes
tend to choose the same ones. Buckets of classes that share a path are split
again until they are small, or so alike inside that splitting is in vain. Small
buckets are compared by brute force. Large ones are cut into blocks, and each
pair of blocks is compared as a small bucket is: nothing is left out, and no
task gets more than two blocks. Runs are repeated until two linked classes meet
in one of them with the recall that is asked for.

Brute force has two steps. The first compares sketches and says which classes of
a bucket may have a partner there; most have none. The second fetches the sets
of those from the texts and counts shared shingles exactly, so that links are
never false. A pair that meets in several buckets counts in the first of them
alone, so pairs needn't be gathered to be told apart: a task gives out each
class's number of links and one edge to the least class of its group.

A group of m mutually similar texts has m * m links to count, spread over
blocks; its rows and shuffles grow with m times the number of blocks.

Defined results for odd input: words are runs of anything but ASCII white space,
in lower case; a text of one to four words is one shingle; null and empty texts
have no set and are linked to nothing, not even to each other; rows that repeat
an id count as one document; a null id is an id of its own; an empty table gives
an empty result. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.components import components
from labelloom.llm.shared import ROW, among, attach, numbered, without
from labelloom.operators.pin import settle, settle_alone

SHINGLE_WORDS = 5
THRESHOLD = 0.8

#: Linked pairs to find at least, of those at the threshold; more similar ones are found more often.
RECALL = 0.999

#: Tokens of a class that a path goes on with, on average.
BRANCHES = 2.0

#: MinHash values of a signature. A byte of each makes the sketch.
TOKENS = 64

#: A bucket of more classes is split; beyond MAX_DEPTH, or if it is alike inside, it is compared by blocks of so many buckets' size.
BUCKET = 256
MAX_DEPTH = 4

BLOCK_BUCKETS = 2

#: Mean share of equal signature tokens from which a bucket isn't split; and the tokens looked at.
ALIKE = 0.5
PROBES = 4

#: Standard deviations of a sketch's similarity below the threshold that are still compared exactly.
SKETCH_MARGIN = 5.0

#: Shingles of a text that are hashed at a time, and cells of a comparison's matrix.
BLOCK_SHINGLES = 2048
BLOCK_CELLS = 1 << 22

#: Shingles of a comparison's sets that are counted at a time.
PART_SHINGLES = 1 << 20

#: Words whose hashes a worker remembers.
MAX_WORDS = 150_000

ODD = np.uint64(0x9E3779B97F4A7C15)


def runs_for(recall: float, threshold: float = THRESHOLD, branches: float = BRANCHES) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``.

    Of a pair's shared tokens a path takes ``branches * threshold`` on average,
    each with its own fate below: the chance p to stay together at any depth
    solves p = 1 - exp(-branches * threshold * p).
    """
    p = 1.0
    for _ in range(1000):
        p = 1 - math.exp(-branches * threshold * p)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_WORDS = _WordHashes()


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    if len(_WORDS) > MAX_WORDS:
        _WORDS.clear()
    hashes = np.array(list(map(_WORDS.__getitem__, text.lower().encode().split())), dtype=np.uint64)
    if not len(hashes):
        return hashes
    width = min(SHINGLE_WORDS, len(hashes))
    n = len(hashes) - width + 1
    found = np.zeros(n, np.uint64)
    for k in range(width):
        found = mix((found ^ hashes[k : k + n]) + ODD)
    return np.unique(found)


#: Odd multipliers, one for each hash function of the signature.
_FACTORS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * ODD).astype(np.uint32) | np.uint32(1)


def signature(found: np.ndarray) -> np.ndarray:
    """The MinHash tokens of a set of shingles."""
    low = found.astype(np.uint32)
    tokens = np.full(TOKENS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), BLOCK_SHINGLES):
        np.minimum(tokens, (low[at : at + BLOCK_SHINGLES, None] * _FACTORS).min(axis=0), out=tokens)
    return tokens


def token_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, n_shingles, print, tokens``: size, 64-bit fingerprint and signature of every set; null where it is empty."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, tokens = [], [], []
            for text in batch.column("body"):
                found = shingles(text.as_py() or "")
                sizes.append(len(found))
                prints.append(xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63) if len(found) else None)
                tokens.append(signature(found).view(np.int32) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int32()), pa.array(prints, pa.int64()), pa.array(tokens, pa.list_(pa.int32()))],
                ["id", "n_shingles", "print", "tokens"],
            )
        # The worker goes on to other tasks.
        _WORDS.clear()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    return rows.mapInArrow(sets, "id long, n_shingles int, print long, tokens array<int>")


def classes(sets: DataFrame) -> DataFrame:
    """One row per distinct set: ``print, n_shingles, rep, copies, tokens, sketch``; ``rep`` is the least id, ``copies`` the rows."""
    sketch = F.transform("tokens", lambda t: (t.bitwiseAND(F.lit(255)) - 128).cast("tinyint"))
    found = sets.where("print is not null and id is not null").groupBy("print", "n_shingles")
    found = found.agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("tokens").alias("tokens"))
    return found.select("*", sketch.alias("sketch"))


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(kind).reshape(len(column), -1)


def chosen(tokens: np.ndarray, paths: np.ndarray, branches: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``tokens`` and the longer paths that they take, from the paths in ``paths`` or from one path for all.

    What a token does depends on the path, its place and its value alone.
    """
    place = np.arange(TOKENS, dtype=np.uint64) * ODD
    hashes = mix(mix(tokens.astype(np.uint64) + place) ^ np.atleast_1d(paths).astype(np.uint64)[:, None])
    rows, places = np.nonzero(hashes < np.uint64(branches / TOKENS * 2**64))
    return rows, mix(hashes[rows, places] + ODD)


def _entries(reps: np.ndarray, paths: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), pa.array(reps)], ["path", "rep"])


def start_paths(found: DataFrame, runs: int, branches: float) -> DataFrame:
    """``path, rep``: the first step of every run."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, tokens = batch.column("rep").to_numpy(), _matrix(batch.column("tokens"), np.uint32)
            for at in range(0, len(reps), 1024):
                for run in mix(np.arange(1, runs + 1, dtype=np.uint64) * ODD):
                    rows, paths = chosen(tokens[at : at + 1024], run, branches)
                    yield _entries(reps[at : at + 1024][rows], paths)

    return found.select("rep", "tokens").mapInArrow(start, "path long, rep long")


def longer_paths(entries: DataFrame, branches: float) -> DataFrame:
    """``path, rep`` one step on, from rows ``path, rep, tokens``."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, tokens = batch.column("rep").to_numpy(), _matrix(batch.column("tokens"), np.uint32)
            paths = batch.column("path").to_numpy().view(np.uint64)
            for at in range(0, len(reps), 1024):
                rows, further = chosen(tokens[at : at + 1024], paths[at : at + 1024], branches)
                yield _entries(reps[at : at + 1024][rows], further)

    return entries.select("path", "rep", "tokens").mapInArrow(step, "path long, rep long")


def final_buckets(found: DataFrame, runs: int, branches: float, bucket: int, max_depth: int) -> DataFrame:
    """``path, rep, n``: the buckets that are compared, each with ``n`` classes, two or more."""
    done, entries = [], settle(start_paths(found, runs, branches))
    for depth in range(1, max_depth + 1):
        sizes = settle(entries.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        placed = settle(attach(entries, sizes, "path", "n", entries.count()).where("n is not null"))
        large = placed.where(F.col("n") > bucket)
        if depth == max_depth or large.isEmpty():
            done.append(placed)
            break
        done.append(placed.where(F.col("n") <= bucket))
        large = settle(large.join(found.select("rep", "tokens"), "rep"))
        probes = []
        for place in range(PROBES):
            same = large.groupBy("path", "n", F.get("tokens", F.lit(place)).alias("token")).agg(F.count(F.lit(1)).alias("m"))
            # The share of pairs of the bucket that have the token of this place in common.
            probes.append(same.groupBy("path", "n").agg((F.sum(F.col("m") * F.col("m")) / (F.col("n") * F.col("n"))).alias("alike")))
        alike = reduce(DataFrame.unionByName, probes).groupBy("path", "n").agg(F.avg("alike").alias("alike"))
        marked = settle(attach(large.drop("n"), settle(alike), "path", "n", large.count()))
        done.append(marked.where(F.col("alike") >= ALIKE).select("path", "rep", "n"))
        entries = settle(longer_paths(marked.where(F.col("alike") < ALIKE), branches))
    buckets = done[0]
    for more in done[1:]:
        buckets = buckets.unionByName(more)
    return buckets


def comparisons(buckets: DataFrame, found: DataFrame, block_size: int) -> DataFrame:
    """One row per class and comparison it takes part in: ``path, i, j, side, rep, copies, sketch, paths``.

    A small bucket is one comparison of all with all. A large one has a
    comparison of the classes in block i with those in block j for every i <= j.
    ``paths`` lists all buckets of the class, so that a pair can be counted in
    the least one that both are in.
    """
    own = buckets.groupBy("rep").agg(F.array_sort(F.collect_set("path")).alias("paths"))
    found = settle(found.select("rep", "copies", "n_shingles", "sketch").join(own, "rep"))
    n_blocks = F.ceil(F.col("n") / block_size)
    block = F.pmod(F.xxhash64("rep", "path"), n_blocks)
    dealt = buckets.select("path", "rep", block.alias("block"), F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("other"))
    dealt = dealt.select(
        "path",
        F.least("block", "other").cast("int").alias("i"),
        F.greatest("block", "other").cast("int").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
        "rep",
    )
    return dealt.join(found, "rep")


UNIT = ["path", "i", "j"]


def by_unit(rows: DataFrame, compare: Callable, schema: str) -> DataFrame:
    """``compare`` over the rows of each comparison; it gets a table of them and gives lists of values.

    Comparisons are small, many to a task; a task streams through them.
    """

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
            starts = _unit_starts(table)
            yield from compare(table, starts)
            rest = table.slice(starts[-1]) if len(starts) else None
        if rest is not None:
            yield from compare(rest, np.array([0, len(rest)]))

    return rows.repartition(*UNIT).sortWithinPartitions(*UNIT, "rep").mapInArrow(units, schema)


def _unit_starts(table: pa.Table) -> np.ndarray:
    """Where units begin; the last of them may go on in the next batch."""
    if not len(table):
        return np.array([], dtype=np.int64)
    columns = [table[c].to_numpy() for c in UNIT]
    new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.concatenate(([0], np.flatnonzero(new) + 1))


def _counted_here(path: int, paths: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of ``left`` and ``right`` rows have no bucket in common that comes before ``path``."""
    here = np.ones((len(left), len(right)), bool)
    earlier = [p[p < path] for p in paths]
    owners = np.repeat(np.arange(len(paths)), [len(p) for p in earlier])
    values = np.concatenate(earlier)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    bounds = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1], [True])))
    member = np.zeros(len(paths), bool)
    for a, b in zip(bounds, bounds[1:], strict=False):
        if b - a > 1:
            member[:] = False
            member[owners[a:b]] = True
            here &= ~(member[left][:, None] & member[right])
    return here


def _sides(side: np.ndarray, crossing: bool) -> tuple[np.ndarray, np.ndarray]:
    everyone = np.arange(len(side))
    return (everyone[side == 0], everyone[side == 1]) if crossing else (everyone, everyone)


def candidates(threshold: float) -> Callable:
    """Rows that may have a partner in their comparison that isn't found in an earlier bucket."""
    allowed = SKETCH_MARGIN * math.sqrt(threshold * (1 - threshold) / TOKENS)
    least_equal = max(1, math.ceil((threshold - allowed) * TOKENS))

    def compare(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        side, path = table["side"].to_numpy(), table["path"].to_numpy()
        crossing = table["i"].to_numpy() < table["j"].to_numpy()
        sketches, paths = _matrix(table["sketch"].combine_chunks(), np.int8), _lists(table["paths"])
        keep = np.zeros(len(table), bool)
        for a, b in zip(starts, starts[1:], strict=False):
            if b - a < 2:
                continue
            left, right = _sides(side[a:b], crossing[a])
            if not len(left) or not len(right):
                continue
            equal = np.zeros((len(left), len(right)), np.uint8)
            own = sketches[a:b].T
            for token in own:
                equal += token[left][:, None] == token[right]
            like = equal >= least_equal
            if not crossing[a]:
                np.fill_diagonal(like, False)
            if like.any():
                like &= _counted_here(path[a], paths[a:b], left, right)
                keep[a + left[like.any(axis=1)]] = True
                keep[a + right[like.any(axis=0)]] = True
        kept = table.drop_columns(["sketch"]).filter(pa.array(keep))
        yield from kept.to_batches()

    return compare


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(values, ends[:-1])


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles each of the ``left`` sets shares with each of the ``right`` ones, exactly.

    Shingles are hashes, so that their remainders deal them evenly to parts of a
    bounded size, which are counted one by one.
    """
    shared = np.zeros((len(left), len(right)), np.float32)
    parts = -(-sum(map(len, sets)) // PART_SHINGLES)
    for part in range(parts):
        some = sets if parts == 1 else [s[s % parts == part] for s in sets]
        _add_shared(some, left, right, shared)
    return shared


def _add_shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, shared: np.ndarray) -> None:
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = counts > 1
    column = (np.cumsum(several) - 1)[places]
    used = several[places]
    owners, column = owners[used], column[used]
    width, n_columns = max(1, BLOCK_CELLS // len(sets)), int(several.sum())
    order = np.argsort(column, kind="stable")
    owners, column = owners[order], column[order]
    for at in range(0, n_columns, width):
        a, b = np.searchsorted(column, [at, at + width])
        has = np.zeros((len(sets), min(width, n_columns - at)), np.float32)
        has[owners[a:b], column[a:b] - at] = 1
        shared += has[left] @ has[right].T


def links(threshold: float) -> Callable:
    """Per row: copies of its partners, and the least class of its group in this comparison."""

    def compare(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        side, path, rep = (table[c].to_numpy() for c in ("side", "path", "rep"))
        crossing = table["i"].to_numpy() < table["j"].to_numpy()
        copies, paths, sets = table["copies"].to_numpy(), _lists(table["paths"]), _lists(table["shingles"])
        for a, b in zip(starts, starts[1:], strict=False):
            left, right = _sides(side[a:b], crossing[a])
            if b - a < 2 or not len(left) or not len(right):
                continue
            sizes = np.array([len(s) for s in sets[a:b]])
            shared = shared_counts(sets[a:b], left, right)
            union = sizes[left][:, None] + sizes[right] - shared
            like = (shared >= threshold * union) & _counted_here(path[a], paths[a:b], left, right)
            if not crossing[a]:
                np.fill_diagonal(like, False)
            n_links, least = np.zeros(b - a, np.int64), np.arange(b - a)
            n_links[left] += like @ copies[a:b][right]
            if crossing[a]:
                n_links[right] += like.T @ copies[a:b][left]
            if not n_links.any():
                continue
            pairs = np.argwhere(like)
            ends = np.stack((left[pairs[:, 0]], right[pairs[:, 1]]))
            while True:  # rows are in the order of rep, so the least place is the least class
                before = least.copy()
                np.minimum.at(least, ends[0], before[ends[1]])
                np.minimum.at(least, ends[1], before[ends[0]])
                least = least[least]
                if (least == before).all():
                    break
            found = np.flatnonzero(n_links)
            own = rep[a:b]
            yield pa.RecordBatch.from_arrays([pa.array(own[found]), pa.array(n_links[found]), pa.array(own[least[found]])], ["rep", "links", "least"])

    return compare


def shingle_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rep, shingles`` for the ids in ``ids``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                found = [shingles(text.as_py() or "").view(np.int64) for text in part.column("body")]
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(found, pa.list_(pa.int64()))], ["rep", "shingles"])
        _WORDS.clear()

    rows = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("body"))
    return among(rows.where("rep is not null"), ids, "rep").mapInArrow(sets, "rep long, shingles array<long>")


def similar(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    branches: float = BRANCHES,
    bucket: int = BUCKET,
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """One row per row of ``docs``: id, ``class_id, n_links``.

    ``class_id`` is the least id that can be reached over links, ``n_links`` the
    number of other rows of ``docs`` with a set of the required similarity.
    """
    sets = settle(token_sets(docs, id_col, text_col))
    found = settle(classes(sets))
    buckets = settle(final_buckets(found, runs_for(recall, threshold, branches), branches, bucket, max_depth))
    pairs = comparisons(buckets, found, BLOCK_BUCKETS * bucket)
    kept_type = "rep long, path long, i int, j int, side int, copies long, n_shingles int, paths array<long>"
    kept = settle(by_unit(pairs, candidates(threshold), kept_type))
    texts = settle(shingle_sets(docs, settle(kept.select("rep").distinct()), id_col, text_col).dropDuplicates(["rep"]))
    exact = settle(by_unit(kept.join(texts, "rep"), links(threshold), "rep long, links long, least long"))
    grouped = components(exact.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    counted = exact.groupBy("rep").agg(F.sum("links").alias("links"))
    verdicts = (
        found.select("print", "n_shingles", "rep", "copies")
        .join(counted, "rep", "left")
        .join(grouped.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            F.struct("print", "n_shingles").alias("set"),
            "copies",
            F.coalesce("component", "rep").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    has_set = F.col("print").isNotNull() & F.col("id").isNotNull()
    members = sets.where(has_set).select("id", F.struct("print", "n_shingles").alias("set"))
    linked = attach(members, settle(verdicts), "set", "copies", sets.count())
    alone = sets.where(~has_set).select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    result = linked.select("id", "class_id", "n_links").unionByName(alone)
    return result.withColumnRenamed("id", id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class of :func:`similar`, of those with the least id; all columns stay.

    Rows are told apart by a number of their own, as an id may stand for several
    texts. Rows with a null id stay.
    """
    rows = numbered(docs)

    def others() -> DataFrame:
        known = rows.where(F.col(id_col).isNotNull()).select(ROW, F.col(id_col).alias("id"), text_col)
        found = similar(known, ROW, text_col, threshold).join(known.select(ROW, "id"), ROW)
        # A class of one row loses none.
        found = settle(found.where((F.col("n_links") > 0) | (F.col("class_id") != F.col(ROW))).select(ROW, "class_id", "id"))
        first = found.groupBy("class_id").agg(F.min(F.struct("id", ROW)).alias("first"))
        return found.select(ROW).join(first.select(F.col(f"first.{ROW}").alias(ROW)), ROW, "left_anti")

    return without(rows, settle_alone(others)).select(*docs.columns)
