"""Alignment of two tokenizers' encodings of the same texts.

Tokenizer A is a byte-level BPE and reads a space and the text; tokenizer B is a
piece model that adds that space itself. Both encodings are lists of byte ranges
over the same bytes. Places where tokens of both end are found by galloping: the
shorter list of ends drives, block by block, an exponential search followed by a
binary search into the longer one. The common places cut both encodings into
groups; differences of ranks give each group's tokens of A and of B, and the
tokens that end together are its link.

How often an id of A is linked with an id of B in the whole corpus is counted
from lists of pairs that each document keeps, combined in every task first. The
counts are looked up by the documents again: the most frequent pairs, a fixed
number at most, are broadcast; the others, each of which occurs seldom, are
joined. Both ways give the same figures.

A text is encoded by its stretches, each white space with the visible characters
behind it. No match of A's pattern and no piece of B goes on from a visible
character to a space, so the encodings of stretches, which come again and are
remembered, make up that of the text. The vocabulary of B is checked for that.

Defined results for odd input: a text that is null or empty, or whose tokens of
A or B don't spell a space and the text, has no tokens and zeros everywhere, and
an empty digest. Rows that repeat an id are documents of their own and count
each; null ids stay. An empty table gives an empty result. Pairs of equal count
are all best. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.shared import ROW
from labelloom.operators.pin import settle

#: Keys of the shorter list that gallop together.
BLOCK = 256

#: Stretches whose encodings a worker remembers, and characters of the longest that is.
MAX_STRETCHES = 300_000
MAX_STRETCH_CHARS = 40

#: Texts are read from Arrow in parts of so many rows.
ROWS = 64

#: Pairs whose counts are broadcast at most, 16 bytes each.
MAX_BROADCAST_PAIRS = 1 << 19

#: Pairs that a task counts before it gives them out.
MAX_COUNTED = 1 << 21

SPACE_MARK = "▁"

#: From a space to the last visible character before the next one.
STRETCH = re.compile(r" .*?(?:(?<=\S)(?= )|\Z)", re.DOTALL)

#: What keeps a text from being split at its single spaces alone.
IRREGULAR = re.compile(r"\A\s|\s\s|\s\Z")


def gallop(short: np.ndarray, long: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``short`` and in ``long`` of the values in both; both are ascending and without repeats.

    From where the last block ended, steps of doubling length go on until they
    pass the block's last key; the keys are then searched between the last two.
    """
    ours, theirs, at = [], [], 0
    for first in range(0, len(short), block):
        keys = short[first : first + block]
        low, step = at, 1
        while low + step < len(long) and long[low + step] < keys[-1]:
            step *= 2
        high = min(len(long), low + step + 1)
        found = low + np.searchsorted(long[low:high], keys)
        hit = np.flatnonzero(long[np.minimum(found, len(long) - 1)] == keys)
        ours.append(first + hit)
        theirs.append(found[hit])
        at = min(int(found[-1]), len(long) - 1)
    if not ours:
        return np.array([], np.int64), np.array([], np.int64)
    return np.concatenate(ours), np.concatenate(theirs)


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in A and in B of the ends they share."""
    if len(ends_a) <= len(ends_b):
        return gallop(ends_a, ends_b)
    in_b, in_a = gallop(ends_b, ends_a)
    return in_a, in_b


def overlap_ranges(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last rank of every group, from the ranks of the groups' last tokens."""
    return np.concatenate(([0], at[:-1] + 1)) if len(at) else at, at + 1


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the stretches they have met."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = SentencePieceProcessor(model_file=path_b)
        own_byte = _bytes_of_characters()
        size_a = 1 + max(self._a.get_vocab().values())
        self._bytes_a = [b"".join(own_byte.get(c, c.encode()) for c in self._a.id_to_token(i) or "") for i in range(size_a)]
        self._bytes_b = [self._piece_bytes(i) for i in range(self._b.get_piece_size())]
        if any(SPACE_MARK in self._b.id_to_piece(i).lstrip(SPACE_MARK) for i in range(len(self._bytes_b))):
            raise ValueError("tokenizer B has pieces that go on over a space")
        self.n_b = len(self._bytes_b)
        self._len_a = np.array([len(t) for t in self._bytes_a])
        self._len_b = np.array([len(t) for t in self._bytes_b])
        # How a token is written in a list of groups: inside its side, and as the last of it.
        ids_a, ids_b = range(len(self._bytes_a)), range(self.n_b)
        written = [f"{i}," for i in ids_a] + [f"{i}|" for i in ids_a] + [f"{i}," for i in ids_b] + [f"{i};" for i in ids_b]
        self._written = np.array(written, dtype=object)
        self._stretches: dict[str, tuple[bytes, bytes, bool]] = {}

    def _piece_bytes(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self._b.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and of B; None where either doesn't spell a space and the text."""
        stretches = STRETCH.findall(" " + text) if IRREGULAR.search(text) else [" " + word for word in text.split(" ")]
        known = self._stretches
        if len(known) > MAX_STRETCHES:
            known.clear()
        found = list(map(known.get, stretches))
        if None in found:
            new = self._encode_all(list(dict.fromkeys([s for s, ids in zip(stretches, found, strict=True) if ids is None])))
            found = [new[s] if ids is None else ids for s, ids in zip(stretches, found, strict=True)]
            known.update({s: ids for s, ids in new.items() if len(s) <= MAX_STRETCH_CHARS})
        a = np.frombuffer(b"".join([ids[0] for ids in found]), np.int32)
        b = np.frombuffer(b"".join([ids[1] for ids in found]), np.int32)
        if any(ids[2] for ids in found):
            spelt = (" " + text).encode()
            if b"".join(map(self._bytes_a.__getitem__, a)) != spelt or b"".join(map(self._bytes_b.__getitem__, b)) != spelt:
                return None
        return a, b

    def _encode_all(self, stretches: list[str]) -> dict[str, tuple[bytes, bytes, bool]]:
        """:meth:`_encode` of each stretch; all are encoded as one text, which is cut where they end."""
        joined = "".join(stretches)
        sides = (self._a.encode(joined, add_special_tokens=False).ids, self._b.encode(joined[1:]))
        spelt, found = joined.encode(), []
        ends = np.cumsum([len(s.encode()) for s in stretches])
        for ids, tokens, lengths in zip(sides, (self._bytes_a, self._bytes_b), (self._len_a, self._len_b), strict=True):
            if b"".join(map(tokens.__getitem__, ids)) != spelt:
                return {s: self._encode(s) for s in stretches}
            ids = np.array(ids, np.int32)
            past = (np.searchsorted(np.cumsum(lengths[ids]), ends) + 1) * ids.itemsize
            raw, at = ids.tobytes(), past.tolist()
            found.append([raw[i:j] for i, j in zip([0, *at], at, strict=False)])
        return {s: (a, b, False) for s, a, b in zip(stretches, *found, strict=True)}

    def _encode(self, stretch: str) -> tuple[bytes, bytes, bool]:
        """Ids of the stretch as bytes, and whether one of the two spells something else."""
        a = self._a.encode(stretch, add_special_tokens=False).ids
        # B adds its space to anything but an empty text.
        b = self._b.encode(stretch[1:]) or [self._b.piece_to_id(SPACE_MARK)]
        spelt = stretch.encode()
        odd = b"".join(map(self._bytes_a.__getitem__, a)) != spelt or b"".join(map(self._bytes_b.__getitem__, b)) != spelt
        return np.array(a, np.int32).tobytes(), np.array(b, np.int32).tobytes(), odd

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the tokens of A and B that end together."""
        return common_ends(np.cumsum(self._len_a[a]), np.cumsum(self._len_b[b]))

    def write_groups(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group in order."""
        size_a = len(self._bytes_a)
        first, past = overlap_ranges(at_a)
        group_a = np.repeat(np.arange(len(at_a)) * 2, past - first)
        first, past = overlap_ranges(at_b)
        group_b = np.repeat(np.arange(len(at_b)) * 2 + 1, past - first)
        form_a, form_b = a.astype(np.int64), b + np.int64(2 * size_a)
        form_a[at_a] += size_a
        form_b[at_b] += self.n_b
        order = np.argsort(np.concatenate((group_a, group_b)), kind="stable")
        return "".join(self._written[np.concatenate((form_a, form_b))[order]].tolist())[:-1]


def _bytes_of_characters() -> dict[str, bytes]:
    """What byte each character of a byte-level vocabulary stands for: visible Latin-1 ones for themselves, the others shifted."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = [b for b in range(256) if b not in own]
    return {chr(b): bytes([b]) for b in own} | {chr(256 + n): bytes([b]) for n, b in enumerate(shifted)}


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


#: One document: its figures, and the pairs that its links hold with the times they do, as little-endian 64- and 32-bit numbers.
ALIGNED = "n_a long, n_b long, n_groups long, groups_sha256 string, pairs binary, times binary"


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id and :data:`ALIGNED`; a pair is ``a * number of B's ids + b``."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                rows = [_figures(aligner, text.as_py()) for text in batch.column("_text")]
                made = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), KINDS, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("_id"), *made], ["_id", *NAMES])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(align, f"_id {kind}, {ALIGNED}")


NAMES = ["n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
NOTHING = (0, 0, 0, "", b"", b"")


def _figures(aligner: Aligner, text: str | None) -> tuple:
    encoded = aligner.encode(text) if text else None
    if encoded is None:
        return NOTHING
    a, b = encoded
    at_a, at_b = aligner.align(a, b)
    groups = hashlib.sha256(aligner.write_groups(a, b, at_a, at_b).encode()).hexdigest()
    pairs, times = np.unique(a[at_a].astype(np.int64) * aligner.n_b + b[at_b], return_counts=True)
    return len(a), len(b), len(at_a), groups, pairs.astype("<i8").tobytes(), times.astype("<i4").tobytes()


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, n`` over all rows of :func:`aligned`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for at in range(0, len(batch), 1024):
                parts.append(_joined(batch.slice(at, 1024)))
                size += len(parts[-1][0])
                if size > MAX_COUNTED:
                    parts = [_added(parts)]
                    size = len(parts[0][0])
                    if size > MAX_COUNTED // 2:
                        yield _counts(*parts[0])
                        parts, size = [], 0
        if parts:
            yield _counts(*_added(parts))

    return found.select("pairs", "times").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _joined(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    pairs, times = (b"".join(batch.column(c).to_pylist()) for c in ("pairs", "times"))
    return np.frombuffer(pairs, "<i8"), np.frombuffer(times, "<i4").astype(np.int64)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, times = (np.concatenate(columns) for columns in zip(*parts, strict=True))
    distinct, places = np.unique(pairs, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, places, times)
    return distinct, total


def _counts(pairs: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], ["pair", "n"])


def scored(found: DataFrame, frequent: DataFrame) -> DataFrame:
    """``found`` with ``n_best, count_sum`` over the pairs in ``frequent``, and the pairs that it lacks in ``pairs, times``.

    ``frequent`` has rows ``pair, n, best`` and a bounded number of them.
    """
    table = frequent.orderBy("pair").toArrow()
    columns = [table[name].to_numpy() for name in ("pair", "n", "best")]
    shared = found.sparkSession.sparkContext.broadcast(columns)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = shared.value
        for batch in batches:
            n_best, count_sum, pairs, times = [], [], [], []
            for own_pairs, own_times in zip(batch.column("pairs"), batch.column("times"), strict=True):
                own, often = np.frombuffer(own_pairs.as_py(), "<i8"), np.frombuffer(own_times.as_py(), "<i4")
                place = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
                hit = known[place] == own if len(known) else np.zeros(len(own), bool)
                place, weight = place[hit], often[hit].astype(np.int64)
                n_best.append(int(weight[best[place]].sum()))
                count_sum.append(int((weight * counts[place]).sum()))
                pairs.append(own[~hit].tolist())
                times.append(often[~hit].tolist())
            made = [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), pa.array(pairs, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))]
            kept = [batch.column(name) for name in KEPT]
            yield pa.RecordBatch.from_arrays(kept + made, [*KEPT, "n_best", "count_sum", "pairs", "times"])

    kept = ", ".join(f"{name} {found.schema[name].dataType.simpleString()}" for name in KEPT)
    return found.mapInArrow(score, f"{kept}, n_best long, count_sum long, pairs array<long>, times array<int>")


KEPT = [ROW, "_id", "n_a", "n_b", "n_groups", "groups_sha256"]


def alignment(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_broadcast: int = MAX_BROADCAST_PAIRS,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    found = settle(aligned(docs, path_a, path_b, id_col, text_col).withColumn(ROW, F.monotonically_increasing_id()))
    counts = settle(pair_counts(found))
    n_b = _aligner(path_a, path_b).n_b
    highest = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("highest"))
    ranked = counts.withColumn("b", F.col("pair") % n_b).join(highest, "b")
    ranked = settle(ranked.select("pair", "n", (F.col("n") == F.col("highest")).alias("best")))
    least = _least_broadcast(ranked, max_broadcast)
    documents = settle(scored(found, ranked.where(F.col("n") >= least)))
    seldom = documents.where(F.size("pairs") > 0).select(ROW, F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    seldom = seldom.select(ROW, F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    added = seldom.join(ranked.where(F.col("n") < least), "pair").groupBy(ROW)
    added = added.agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    whole = documents.drop("pairs", "times")
    if least > 1:
        whole = whole.join(added, ROW, "left")
    else:
        whole = whole.withColumns({"more_best": F.lit(0), "more_sum": F.lit(0)})
    return whole.select(
        F.col("_id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def _least_broadcast(ranked: DataFrame, max_rows: int) -> int:
    """The least count from which on at most ``max_rows`` pairs are left; 1 if all of them fit."""
    if ranked.count() <= max_rows:
        return 1
    # One row per power of two: how many pairs have a count from there on.
    power = (F.length(F.bin("n")) - 1).alias("power")
    sizes = {row.power: row.m for row in ranked.groupBy(power).agg(F.count(F.lit(1)).alias("m")).collect()}
    total = 0
    for level in range(max(sizes), -1, -1):
        total += sizes.get(level, 0)
        if total > max_rows:
            return 1 << (level + 1)
    return 1
