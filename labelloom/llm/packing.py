"""Best-fit packing by a tree of residual merges.

Documents become pieces of at most ``capacity`` tokens. Each partition packs its
own pieces, longest first, into the fullest sequence that still takes them, and
gives out the sequences that are nearly full. The others go up a tree as items
of their own: the nodes above gather the underfull sequences of several nodes
below and best-fit them again, until one node or as many as are needed to keep
a node's items bounded are left. A sequence holds its pieces with it, at most
``capacity`` of them, so nothing has to be looked up afterwards.

Defined results for odd input: a null text counts as empty and its document is
the end id alone; a text that holds an added token's string has its id there, as
the tokenizer gives it; pieces of equal length go by their place in the task; rows that repeat an id are packed each for itself; an empty
table gives an empty result. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators.pin import settle

CAPACITY = 4096
END_ID = 1

#: A sequence with at most this many free places is given out.
SLACK = 8

#: Nodes that meet in one node of the next level, and the items a node takes at most.
FAN_IN = 8
MAX_ITEMS = 200_000

#: Words, and parts of words, whose ids a worker remembers.
MAX_WORDS = 250_000

#: Texts are encoded in groups of about this many characters.
GROUP_CHARS = 1 << 20

ID_BYTES = 4

#: Visible ASCII that is neither letter nor digit.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class _Remembered(dict):
    """A dictionary that makes what it lacks."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, key):
        made = self[key] = self._make(key)
        return made


class WordEncoder:
    """Ids of whole texts as bytes, four a little-endian id.

    The tokenizer's added tokens are found first, as it does. It drops white
    space and never joins across it, so a text's other ids are its words' ids in turn. Words come again, and so do the parts that the
    tokenizer's own normalizer and splitter make of them; each is encoded once.
    A word of letters that the normalizer wouldn't change, with or without
    punctuation behind it, takes a shorter way to the same parts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self._normalize = tokenizer.normalizer.normalize_str
        self._split = tokenizer.pre_tokenizer.pre_tokenize_str
        self._merge = tokenizer.model.tokenize
        # Tokens that the tokenizer finds in a text before anything else is done to it.
        added = {token.content: token_id.to_bytes(ID_BYTES, "little") for token_id, token in tokenizer.get_added_tokens_decoder().items()}
        self._added = added
        self._find_added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self._alphabet = _Remembered(lambda code: self._split(chr(code))[0][0])
        self._words = _Remembered(self._word)
        self._parts = _Remembered(self._part)

    def encode(self, texts: list[str]) -> list[bytes]:
        for known in (self._words, self._parts):
            if len(known) > MAX_WORDS:
                known.clear()
        return [self._encode(text) for text in texts]

    def forget(self) -> None:
        self._words.clear()
        self._parts.clear()

    def _encode(self, text: str) -> bytes:
        if not self._find_added or not self._find_added.search(text):
            return self._without_added(text)
        ids, at = [], 0
        for met in self._find_added.finditer(text):
            ids += [self._without_added(text[at : met.start()]), self._added[met.group()]]
            at = met.end()
        return b"".join([*ids, self._without_added(text[at:])])

    def _without_added(self, text: str) -> bytes:
        return b"".join(map(self._words.__getitem__, text.encode().split()))

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        letters = text.rstrip(PUNCTUATION)
        if letters.isascii():
            letters = letters.lower()
        if letters.isalpha() and letters.islower() and unicodedata.is_normalized("NFC", letters):
            tail = text[len(letters) :]
            ids = self._parts[letters.translate(self._alphabet)]
            return ids + self._parts[tail] if tail else ids
        return b"".join([self._parts[part] for part, _ in self._split(self._normalize(text))])

    def _part(self, part: str) -> bytes:
        return b"".join([token.id.to_bytes(ID_BYTES, "little") for token in self._merge(part)])


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """``(piece, start, length, crc)`` of a document's ids with the end id."""
    ids += END_ID.to_bytes(ID_BYTES, "little")
    step = capacity * ID_BYTES
    for piece, at in enumerate(range(0, len(ids), step)):
        part = ids[at : at + step]
        yield piece, at // ID_BYTES, len(part) // ID_BYTES, zlib.crc32(part)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions in ``lengths``: longest first, each into the fullest bin that takes it.

    Bins wait by their free places; a bit per number of free places finds the
    next larger one in a step.
    """
    bins: list[list[int]] = []
    waiting: dict[int, list[int]] = {}
    free_sizes = 0
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        length = lengths[item]
        fitting = free_sizes >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            chosen = waiting[free].pop()
            if not waiting[free]:
                free_sizes &= ~(1 << free)
        else:
            free, chosen = capacity, len(bins)
            bins.append([])
        bins[chosen].append(item)
        rest = free - length
        if rest:
            waiting.setdefault(rest, []).append(chosen)
            free_sizes |= 1 << rest
    return bins


def _sequence_type(id_type: pa.DataType) -> pa.Schema:
    piece = [("id", id_type), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("offset", pa.int64())]
    return pa.schema([("sequence", pa.int64()), ("used", pa.int32()), ("pieces", pa.list_(pa.struct(piece)))])


def _packed(items: list[tuple[int, list[dict]]], first: int, capacity: int, schema: pa.Schema) -> pa.Table:
    """The sequences that best fit makes of ``items``, pairs of a length and the pieces it consists of."""
    rows = []
    for number, members in enumerate(best_fit([used for used, _ in items], capacity)):
        pieces, offset = [], 0
        for piece in (piece for m in members for piece in items[m][1]):
            pieces.append(piece | {"offset": offset})
            offset += piece["length"]
        rows.append({"sequence": first + number, "used": offset, "pieces": pieces})
    return pa.Table.from_pylist(rows, schema)


def _first_number(level: int, node: int) -> int:
    """First of the sequence numbers of a node; nodes share none."""
    return (level << 57) + (node << 28)


def pack_partitions(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int) -> DataFrame:
    """Level 0: texts to ids, documents to pieces, and the pieces of a partition to ``sequence, used, pieces``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, items, schema = _encoder(tokenizer_path), [], None

        def add(ids: list, texts: list[str]) -> None:
            for doc, found in zip(ids, encoder.encode(texts), strict=True):
                for piece, start, length, crc in cut(found, capacity):
                    items.append((length, [{"id": doc, "piece": piece, "start": start, "length": length, "crc": crc}]))

        for batch in batches:
            schema = schema or _sequence_type(batch.schema.field("_id").type)
            ids, texts, chars = [], [], 0
            for doc, text in zip(batch.column("_id"), batch.column("_text"), strict=True):
                ids.append(doc.as_py())
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if chars >= GROUP_CHARS:
                    add(ids, texts)
                    ids, texts, chars = [], [], 0
            add(ids, texts)
        # The worker goes on to tasks of other kinds.
        encoder.forget()
        if items:
            yield from _packed(items, _first_number(0, TaskContext.get().partitionId()), capacity, schema).to_batches()

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(pack, _row_type(docs, id_col))


def _row_type(docs: DataFrame, id_col: str) -> str:
    piece = f"id: {docs.schema[id_col].dataType.simpleString()}, piece: int, start: long, length: long, crc: long, offset: long"
    return f"sequence long, used int, pieces array<struct<{piece}>>"


def merge_level(sequences: DataFrame, level: int, nodes: int, capacity: int, row_type: str) -> DataFrame:
    """One level up: ``sequences`` as items, dealt out to ``nodes`` nodes and best-fitted in each."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("sequence")
        items = list(zip(table["used"].to_pylist(), table["pieces"].to_pylist(), strict=True))
        id_type = table.schema.field("pieces").type.value_type.field("id").type
        return _packed(items, _first_number(level, key[0].as_py()), capacity, _sequence_type(id_type))

    node = F.pmod(F.xxhash64("sequence"), F.lit(nodes)).alias("node")
    return sequences.select(node, "*").groupBy("node").applyInArrow(merge, row_type)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Per piece: id, ``piece, start, length, ids_crc32, sequence_id, offset``.

    Every level is written to the shared folder before the next one reads its
    underfull sequences, so a lost executor costs a part of one level.
    """
    row_type = _row_type(docs, id_col)
    is_open = F.col("used") < capacity - SLACK
    packed = settle(pack_partitions(docs, tokenizer_path, id_col, text_col, capacity))
    node = F.shiftright("sequence", 28)
    n_open, nodes = packed.agg(F.count_if(is_open), F.count_distinct(node)).first()
    levels = []
    while n_open > 1 and (above := max(-(-n_open // MAX_ITEMS), -(-nodes // FAN_IN))) < nodes:
        levels.append(packed.where(~is_open))
        packed = settle(merge_level(packed.where(is_open), len(levels), above, capacity, row_type))
        n_open, nodes = packed.where(is_open).count(), above
    for level in levels:
        packed = packed.unionByName(level)
    return packed.select("sequence", F.explode("pieces").alias("p")).select(
        F.col("p.id").alias(id_col),
        F.col("p.piece").alias("piece"),
        F.col("p.start").alias("start"),
        F.col("p.length").alias("length"),
        F.col("p.crc").alias("ids_crc32"),
        F.col("sequence").alias("sequence_id"),
        F.col("p.offset").alias("offset"),
    )
