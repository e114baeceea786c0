"""Repeated passages by content-defined chunking.

A gear hash rolls over the bytes of a text. A chunk ends where the hash is the
largest for some way around, so that cuts depend on nothing but the bytes near
them: an insertion shifts a passage but not the cuts inside it. Cuts move on to
the start of a word. A chunk and its successor share one digest, so that a match
is a piece of a passage and not a phrase. Digests found in two documents or more
are joined back to the chunks, and chunks in a row make up passages. Only
passages of some length count. Of the copies, those in the document with the
smallest id stay; wherever a chunk is removed, the first document that has it
keeps it.

Repeats within one document alone are left to the quality rules. Digests have
64 bits; a chance match would have to come twice in a row to be a passage.

Defined results for odd input: null, empty and very short texts have no passage;
a text without white space or change has few chunks or a single one, and a
passage is found in it only as far as its chunks are whole; rows that repeat an
id count as one document, and each loses what its own text repeats; a null id is left alone,
its row stays as it is and gives no copies to others; an empty table gives an
empty result. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.shared import ROW, attach, numbered, with_few
from labelloom.operators.pin import settle, settle_alone

#: A cut's hash is the largest among so many bytes on either side: chunks of about 40 bytes.
RADIUS = 20

#: Bytes that a gear hash depends on, a power of two.
WINDOW = 16

#: A cut moves on to the next start of a word if there is one this near.
MAX_SNAP = 64

#: Words that repeated chunks in a row must have. Cuts leave up to about a chunk
#: and a window at each end of a passage, so that one of 50 words has these.
MIN_WORDS = 25

#: Rows are given out in lots of about this many.
LOT = 100_000

#: Documents whose pairs are looked at together.
ROWS = 128

GEAR = np.array([xxhash.xxh32_intdigest(bytes([b])) for b in range(256)], dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the WINDOW bytes up to it, by doubling the window."""
    h = GEAR[data]
    width = 1
    while width < WINDOW:
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h, width = wider, 2 * width
    return h


def _largest_ahead(h: np.ndarray, width: int) -> np.ndarray:
    """At i the largest of h[i : i + width]."""
    largest, done = h, 1
    while done < width:
        step = min(done, width - done)
        ahead = largest.copy()
        np.maximum(ahead[:-step], largest[step:], out=ahead[:-step])
        largest, done = ahead, done + step
    return largest


def boundaries(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks begin, with the end of the data; and the starts of words."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    word_starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if len(data) <= 2 * RADIUS:
        return np.array([0, len(data)]), word_starts
    h = gear_hashes(data)
    ahead = _largest_ahead(h, RADIUS)
    middle = h[RADIUS:-RADIUS]
    is_cut = (middle > ahead[: len(middle)]) & (middle >= ahead[RADIUS + 1 : RADIUS + 1 + len(middle)])
    cuts = np.flatnonzero(is_cut) + RADIUS + 1
    at = np.searchsorted(word_starts, cuts)
    snapped = np.append(word_starts, len(data))[at]
    far = snapped - cuts > MAX_SNAP
    if far.any():
        whole = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        snapped[far] = whole[np.searchsorted(whole, cuts[far])]
    inner = np.unique(snapped)
    return np.concatenate(([0], inner[(inner > 0) & (inner < len(data))], [len(data)])), word_starts


CHUNKS = "id long, part long, pair int, start long, end long, first_word int, last_word int, digest long"


def chunk_pairs(docs: DataFrame, id_col: str, text_col: str, part: Column) -> DataFrame:
    """One row per chunk that has a successor: where the two lie in bytes and in words, and their digest. ``part`` tells rows of one id apart."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "part", "pair", "start", "end", "first_word", "last_word", "digest"]
        types = [np.int64, np.int64, np.int32, np.int64, np.int64, np.int32, np.int32, np.uint64]

        def rows(lot: list[tuple]) -> pa.RecordBatch:
            columns = [np.concatenate(parts).astype(t, copy=False) for parts, t in zip(zip(*lot, strict=True), types, strict=True)]
            columns[-1] = columns[-1].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        lot, held = [], 0
        for batch in batches:
            for doc, part, text in zip(batch.column("id").to_pylist(), batch.column("part").to_pylist(), batch.column("body"), strict=True):
                raw = memoryview(text.as_buffer())
                data = np.frombuffer(raw, np.uint8)
                bounds, word_starts = boundaries(data)
                n = len(bounds) - 2
                if n < 1:
                    continue
                start, end = bounds[:-2], bounds[2:]
                digest = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                words = (np.searchsorted(word_starts, start), np.searchsorted(word_starts, end))
                lot.append((np.full(n, doc), np.full(n, part), np.arange(n), start, end, *words, np.array(digest, np.uint64)))
                held += n
                if held >= LOT:
                    yield rows(lot)
                    lot, held = [], 0
        if lot:
            yield rows(lot)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), part.cast("long").alias("part"), F.col(text_col).cast("binary").alias("body"))
    return rows.where("id is not null and length(body) > 0").mapInArrow(pairs, CHUNKS)


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, part: Column | None = None
) -> DataFrame:
    """One row per repeated passage of a document, first copies too.

    ``id_col, part`` of the document, where ``part`` tells rows of one id apart, by their number of bytes if it isn't given; ``start_byte, end_byte, n_words`` of the
    passage, ``first_id``, the smallest id that has a part of it, and ``cuts``,
    the spans of bytes in it that smaller ids have as well, for removal.
    Digests are shuffled with a few numbers each, never texts; a digest is
    counted in each task before that, and a frequent one isn't shuffled again.
    """
    pairs = settle(chunk_pairs(docs, id_col, text_col, F.octet_length(text_col) if part is None else part))
    digests = pairs.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    shared = settle(digests.where("first_id < last_id").drop("last_id"))
    repeated = attach(pairs, shared, "digest", "n", pairs.count()).where("first_id is not null")
    pair = F.struct("pair", "start", "end", "first_word", "last_word", "first_id")
    # The pairs of one document: no more than its own length gives.
    by_doc = repeated.groupBy("id", "part").agg(F.array_sort(F.collect_set(pair)).alias("pairs"))
    return by_doc.mapInArrow(_passages(min_words), PASSAGES).withColumnRenamed("id", id_col)


PASSAGES = (
    "id long, part long, start_byte long, end_byte long, n_words int, first_id long, "
    "cuts array<struct<start: long, end: long>>"
)


def _runs(pairs: list[dict], min_words: int, goes_on) -> Iterator[list[dict]]:
    """Neighbours in ``pairs`` as long as each goes on from the one before, where that gives enough words."""
    first = 0
    for i in range(1, len(pairs) + 1):
        if i == len(pairs) or not goes_on(pairs[i - 1], pairs[i]):
            if pairs[i - 1]["last_word"] - pairs[first]["first_word"] >= min_words:
                yield pairs[first:i]
            first = i


def _passages(min_words: int):
    def next_to(a: dict, b: dict) -> bool:
        return b["pair"] == a["pair"] + 1

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), cut]
        names = ["id", "part", "start_byte", "end_byte", "n_words", "first_id", "cuts"]
        schema = pa.schema(list(zip(names, types, strict=True)))
        # Pairs become Python objects here, so few documents at a time.
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, len(whole), ROWS)):
            found = []
            for doc, part, pairs in zip(*(batch.column(c).to_pylist() for c in ("id", "part", "pairs")), strict=True):
                for run in _runs(pairs, min_words, next_to):
                    later = [p for p in run if p["first_id"] < doc]
                    cuts = [{"start": r[0]["start"], "end": r[-1]["end"]} for r in _runs(later, min_words, next_to)]
                    n_words = run[-1]["last_word"] - run[0]["first_word"]
                    first_id = min(p["first_id"] for p in run)
                    values = (doc, part, run[0]["start"], run[-1]["end"], n_words, first_id, cuts)
                    found.append(dict(zip(names, values, strict=True)))
            yield pa.RecordBatch.from_pylist(found, schema)

    return passages


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with all but the first copies of repeated passages cut out of the texts.

    Documents that have no word left by that go; all other rows and columns stay.
    """
    rows = numbered(docs)

    def cut_spans() -> DataFrame:
        spans = repeated_passages(rows, id_col, text_col, min_words, F.col(ROW)).where("size(cuts) > 0")
        cuts = F.array_sort(F.flatten(F.collect_list("cuts"))).alias("_passages_cuts")
        return spans.groupBy(F.col("part").alias(ROW)).agg(cuts)

    joined = with_few(rows, settle_alone(cut_spans))
    body = F.col(text_col).cast("binary")
    n_cuts = F.size("_passages_cuts")

    def between(i):
        start = F.when(i == 0, 0).otherwise(F.get("_passages_cuts", i - 1)["end"])
        end = F.when(i == n_cuts, F.octet_length(body)).otherwise(F.get("_passages_cuts", i)["start"])
        # Cuts may touch but don't overlap by more than a chunk.
        return F.substring(body, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int")).cast("string")

    rest = F.array_join(F.transform(F.sequence(F.lit(0), n_cuts), between), "")
    changed = F.col("_passages_cuts").isNotNull()
    texts = joined.withColumn(text_col, F.when(changed, rest).otherwise(F.col(text_col)))
    return texts.where(~changed | F.col(text_col).rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)
