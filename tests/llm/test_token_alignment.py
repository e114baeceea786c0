import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from labelloom.llm import token_alignment as ta

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = [
    "plain words of one line",
    "two  spaces,   three and a tab\tand\n\n lines \n ",
    " leading and trailing ",
    "   ",
    " ",
    "<|endoftext|> <s>x</s> <unk> <0x41>",
    "a ▁ mark",
    "naïve café — 中文字符 😀 é",
    "a\x1c b\x85 c\xa0 d　 e \x00 f",
    "don't we'll I'm 12345 67 ?!... x",
    "nospaces" * 500,
    "word " * 3000 + "end",
]


def whole(text, tokenizer, pieces):
    """Ids and byte ends of both encodings, each of the text at once; None where one spells something else."""
    spelt = (" " + text).encode()
    own_byte = ta._bytes_of_characters()
    found = tokenizer.encode(" " + text, add_special_tokens=False).ids
    a = [(i, b"".join(own_byte[c] for c in tokenizer.id_to_token(i))) for i in found]
    b = []
    for i in pieces.encode(text):
        piece = pieces.id_to_piece(i)
        b.append((i, bytes([int(piece[3:-1], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()))
    return None if any(b"".join(t for _, t in side) != spelt for side in (a, b)) else (a, b)


def brute_force(texts):
    tokenizer, pieces = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
    tokenizer.encode_special_tokens = True
    rows, counts = [], Counter()
    for text in texts:
        encoded = whole(text, tokenizer, pieces) if text else None
        links, groups = [], []
        if encoded:
            ends = []
            for side in encoded:
                at, found = 0, []
                for i, token in side:
                    at += len(token)
                    found.append((at, i))
                ends.append(found)
            together = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
            before = 0
            for end in together:
                of = [[i for e, i in side if before < e <= end] for side in ends]
                groups.append("|".join(",".join(map(str, ids)) for ids in of))
                links.append((of[0][-1], of[1][-1]))
                before = end
        counts.update(links)
        rows.append((encoded, groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    for encoded, groups, links in rows:
        if encoded is None:
            yield (0, 0, 0, 0, 0, 0, "")
            continue
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        n_best = sum(counts[p] == best[p[1]] for p in links)
        yield (len(encoded[0]), len(encoded[1]), len(groups), len(links), n_best, sum(counts[p] for p in links), digest)


def rows_of(found):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(((r.doc_id is not None, r.doc_id), tuple(r[n] for n in names)) for r in found.collect())


@pytest.mark.parametrize("max_broadcast", [ta.MAX_BROADCAST_PAIRS, 40, 0])
def test_like_brute_force(texts, max_broadcast):
    given = [*ODD_TEXTS, *ODD_TEXTS[:3]]
    expected = [((True, i), row) for i, row in enumerate(brute_force(given))]
    assert rows_of(ta.alignment(texts(given).repartition(3), *PATHS, max_broadcast=max_broadcast)) == expected


def test_driver_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    given = sorted((r.doc_id, r.text) for r in docs.collect())
    expected = [((True, i), row) for (i, _), row in zip(given, brute_force([t for _, t in given]), strict=True)]
    assert rows_of(ta.alignment(docs, *PATHS)) == expected


def test_odd_rows(odd, empty):
    found = ta.alignment(odd, *PATHS)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = found.collect()
    assert len(rows) == odd.count()
    assert all(r.n_a == r.n_b == r.count_sum == 0 and r.groups_sha256 == "" for r in rows if r.doc_id in (3, 4))
    assert len({tuple(r)[1:] for r in rows if r.doc_id in (1, 2)}) == 1
    assert ta.alignment(empty, *PATHS).count() == 0


def test_galloping():
    random.seed(3)
    for n, m, block in [(0, 5, 4), (5, 0, 4), (1, 1000, 4), (300, 4000, 16), (50, 60, 256), (40, 40, 1)]:
        short = np.array(sorted(random.sample(range(5000), n)), np.int64)
        long = np.array(sorted(random.sample(range(5000), m)), np.int64)
        if not m:
            continue
        ours, theirs = ta.gallop(short, long, block)
        both = sorted(set(short) & set(long))
        assert list(short[ours]) == list(long[theirs]) == both
        assert list(theirs) == [bisect_left(list(long), v) for v in both]
