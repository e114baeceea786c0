import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from labelloom.llm import packing
from llm.conftest import ODD_ROWS

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_words_give_what_whole_texts_give(tokenizer):
    draw = random.Random(3)
    alphabet = ["a", "The", "thEr", " ", "\n", "\x1c", "\x85", " ", "é", "É", "é", "İ", "Σ", "ς", "ǅ", "ﬁ", "½", "²", "中", "'s", "'", "''", "..", "12", "_", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|"]
    texts = ["".join(draw.choices(alphabet, k=draw.randrange(40))) for _ in range(3000)]
    encoder = packing.WordEncoder(PATH)
    for ids, whole in zip(encoder.encode(texts), tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == whole.ids


def check(rows, documents, tokenizer, capacity):
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    expected = defaultdict(list)
    for doc, text in documents:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected[doc].append((piece, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert {d: sorted(p) for d, p in pieces.items()} == {d: sorted(p) for d, p in expected.items()}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r.length for r in rows)


def test_odd_input(odd, empty, tokenizer):
    rows = packing.pack(odd, PATH).collect()
    n, tokens = check(rows, [r[:2] for r in ODD_ROWS], tokenizer, packing.CAPACITY)
    assert n == -(-tokens // packing.CAPACITY)
    assert packing.pack(empty, PATH).count() == 0


@pytest.mark.parametrize("max_items", [packing.MAX_ITEMS, 40])
def test_tree_packs_nearly_as_well_as_one_task(texts, tokenizer, monkeypatch, max_items):
    monkeypatch.setattr(packing, "MAX_ITEMS", max_items)
    draw = random.Random(5)
    found = ["word " * draw.choice([3, 9, 25, 40, 55, 70, 130]) for _ in range(600)]
    rows = packing.pack(texts(found).repartition(24), PATH, capacity=64).collect()
    n, _ = check(rows, list(enumerate(found)), tokenizer, 64)
    lengths = [r.length for r in rows]
    assert n <= 1.02 * len(packing.best_fit(lengths, 64)) + 1


def test_best_fit():
    assert sorted(map(sorted, packing.best_fit([6, 5, 4, 5], 10))) == [[0, 2], [1, 3]]
    assert packing.best_fit([], 10) == []
