"""Byte-level BPE as a tree reduction.

The encoding of a text is put together from the encodings of its halves, down
to leaves of some thousand characters. Two neighbours are joined by encoding
again a window around the seam. The window grows until both its edges stand
where every encoding has a boundary; tokens outside can't change then:

* The pattern matches white space only by itself or as one character in front
  of a match, so between a visible character and white space behind it one
  match ends and the next begins, whatever stands further left or right.
* Matches are encoded separately, so a boundary of matches is one of tokens.

Joining is associative, with the empty encoding as its unit. Decoding joins
the bytes of the tokens up the same kind of tree.

Defined results for odd input: a null text encodes as an empty one; an empty
text has no tokens; a text without white space is encoded whole at each join.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF_CHARS = 4096
LEAF_IDS = 4096
FIRST_WINDOW = 32

#: White space in the pattern as well as in Python.
SURE_SPACE = frozenset(" \t\n\r")


class TreeEncoder:
    """Encodes and decodes by the ranks in a file, one ``base64 rank`` a line."""

    def __init__(self, ranks_path: str, pattern: str, leaf_chars: int = LEAF_CHARS):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._leaf = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._leaf_chars = leaf_chars
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self._n_bytes = {rank: len(token) for token, rank in ranks.items()}
        self.decimal = {rank: str(rank) for rank in self.token_bytes}

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, low: int, high: int) -> list[int]:
        if high - low <= self._leaf_chars:
            return self._leaf(text[low:high])
        middle = (low + high) // 2
        return self._join(text, low, middle, high, self._encode(text, low, middle), self._encode(text, middle, high))

    def _join(self, text: str, low: int, middle: int, high: int, left: list[int], right: list[int]) -> list[int]:
        window = FIRST_WINDOW
        while (start := _stable_before(text, max(low, middle - window), middle, low)) is None:
            window *= 2
        while (end := _stable_after(text, middle, min(high, middle + window), high)) is None:
            window *= 2
        if start == end:
            return left + right
        kept = self._count(reversed(left), len(text[start:middle].encode()))
        dropped = self._count(right, len(text[middle:end].encode()))
        return left[: len(left) - kept] + self._leaf(text[start:end]) + right[dropped:]

    def _count(self, ids: Iterator[int] | list[int], n_bytes: int) -> int:
        """How many of the first ``ids`` make up ``n_bytes``."""
        count = 0
        for i in ids:
            if n_bytes <= 0:
                break
            n_bytes -= self._n_bytes[i]
            count += 1
        if n_bytes:
            raise ValueError("the window's edge is not a token boundary")
        return count

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join([self.token_bytes[i] for i in ids])
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def _is_stable(text: str, at: int) -> bool:
    return text[at] in SURE_SPACE and not text[at - 1].isspace()


def _stable_before(text: str, start: int, middle: int, low: int) -> int | None:
    """The last stable boundary from ``start`` to ``middle``; ``low`` is always one."""
    for at in range(min(middle, len(text) - 1), start, -1):
        if _is_stable(text, at):
            return at
    return low if start == low else None


def _stable_after(text: str, middle: int, end: int, high: int) -> int | None:
    for at in range(middle, end):
        if _is_stable(text, at):
            return at
    return high if end == high else None


@lru_cache(maxsize=2)
def _encoder(ranks_path: str, pattern: str) -> TreeEncoder:
    return TreeEncoder(ranks_path, pattern)


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids array<int>`` in place of the text."""
    rest = [c for c in docs.columns if c not in (text_col, "ids")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for batch in batches:
            ids = [encoder.encode(text or "") for text in batch.column("_text").to_pylist()]
            columns = [batch.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.list_(pa.int32()))], [*rest, "ids"])

    rows = docs.select(*rest, F.col(text_col).alias("_text"))
    fields = [docs.schema[c].simpleString().split(":", 1) for c in rest]
    schema = ", ".join([*(f"`{name}` {kind}" for name, kind in fields), "ids array<int>"])
    return rows.mapInArrow(encode, schema)


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``bytes binary`` beside the ids."""
    columns = [c for c in encoded.columns if c != "bytes"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for batch in batches:
            data = [encoder.decode(ids or []) for ids in batch.column(ids_col).to_pylist()]
            arrays = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(data, pa.binary())], [*columns, "bytes"])

    fields = [encoded.schema[c].simpleString().split(":", 1) for c in columns]
    schema = ", ".join([*(f"`{name}` {kind}" for name, kind in fields), "bytes binary"])
    return encoded.select(*columns).mapInArrow(decode, schema)


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, digest of the ids in decimal, digest of the decoded bytes.

    Encoding and decoding run in one pass, so that the ids of a text needn't
    leave the task.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for batch in batches:
            counts, id_digests, byte_digests = [], [], []
            for text in batch.column("_text"):
                ids = encoder.encode(text.as_py() or "")
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(" ".join([encoder.decimal[i] for i in ids]).encode()).hexdigest())
                byte_digests.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(counts, pa.int64()), pa.array(id_digests), pa.array(byte_digests)],
                ["_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(digests, schema).withColumnRenamed("_id", id_col)
