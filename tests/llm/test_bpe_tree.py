import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from labelloom.llm import bpe_tree
from llm.conftest import ODD_ROWS

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def whole():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@pytest.mark.parametrize("leaf", [1, 2, 7, 64])
def test_tree_gives_what_the_whole_gives(whole, leaf):
    encoder = bpe_tree.TreeEncoder(RANKS, PATTERN, leaf)
    draw = random.Random(leaf)
    alphabet = ["a", "the", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "12", "é", "中文", "🙂", " ", "　", "\x1c", "\x85", ".", "!!", "<|endoftext|>", "́"]
    for _ in range(400):
        text = "".join(draw.choices(alphabet, k=draw.randrange(60)))
        ids = encoder.encode(text)
        assert ids == whole(text)
        assert encoder.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["", " ", "a" * 20_000, " " * 20_000, "ab c" * 5000, "x\n" * 9000, "word " * 9000])
def test_long_and_even_texts(whole, text):
    encoder = bpe_tree.TreeEncoder(RANKS, PATTERN)
    assert encoder.encode(text) == whole(text)
    assert encoder.decode(encoder.encode(text)) == text.encode()


def test_odd_input(odd, empty, whole):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_tree.round_trip_digests(odd, RANKS, PATTERN).collect()}
    sha = lambda data: hashlib.sha256(data).hexdigest()
    expected = set()
    for doc, text, *_ in ODD_ROWS:
        ids = whole(text or "")
        expected.add((doc, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())))
    assert got == expected
    assert bpe_tree.round_trip_digests(empty, RANKS, PATTERN).count() == 0


def test_ids_and_bytes_as_columns(odd):
    decoded = bpe_tree.decode_ids(bpe_tree.encode_texts(odd, RANKS, PATTERN), RANKS, PATTERN)
    assert sorted(bytes(r["bytes"]) for r in decoded.collect()) == sorted((r[1] or "").encode() for r in ODD_ROWS)
    assert "lang" in decoded.columns and "text" not in decoded.columns
