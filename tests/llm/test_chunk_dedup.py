import random

import numpy as np
import pytest

from labelloom.llm import chunk_dedup, shared
from llm.conftest import ODD_ROWS


def prose(draw, n):
    return " ".join("".join(draw.choices("abcdefghijklmnop", k=draw.randrange(1, 10))) for _ in range(n))


def bounds(text):
    return chunk_dedup.boundaries(np.frombuffer(text.encode(), np.uint8))[0]


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(prose(random.Random(1), 50).encode(), np.uint8)
    rolled, expected = np.uint64(0), []
    for b in data:
        rolled = (rolled << np.uint64(1)) + np.uint64(chunk_dedup.GEAR[b])
        expected.append(rolled)
    # A byte is shifted out of 32 bits later than out of the window; the bits in it are the same.
    for i in range(chunk_dedup.WINDOW, len(data)):
        window = data[i - chunk_dedup.WINDOW + 1 : i + 1]
        direct = sum(int(chunk_dedup.GEAR[b]) << (len(window) - 1 - k) for k, b in enumerate(window)) % 2**32
        assert int(chunk_dedup.gear_hashes(data)[i]) == direct
    assert len(expected) == len(data)


def test_cuts_follow_the_text_and_not_its_place():
    draw = random.Random(2)
    passage = prose(draw, 200)
    one, two = prose(draw, 30) + " " + passage, prose(draw, 7) + " " + passage
    ends = [{t[a:b] for a, b in zip(x, x[1:], strict=False)} for t in (one, two) for x in [bounds(t).tolist()]]
    assert len(ends[0] & ends[1]) > 15
    assert all(one.encode()[a - 1 : a].isspace() for a in bounds(one)[1:-1])


@pytest.mark.parametrize("share", [shared.HOT_SHARE, 1.0])
def test_planted_passages_are_found_and_others_left(texts, monkeypatch, share):
    monkeypatch.setattr(shared, "HOT_SHARE", share)
    draw = random.Random(3)
    found = [prose(draw, 120) for _ in range(120)]
    planted = {}
    for p in range(12):
        passage = prose(draw, 51 + p)
        for doc in draw.sample(range(40), 2 + p % 3):
            # Between prose of its own, wherever that puts it.
            found[doc] = " ".join([found[doc], passage, prose(draw, draw.randrange(15, 40))])
            planted.setdefault(p, []).append(doc)
    rows = chunk_dedup.repeated_passages(texts(found)).collect()
    assert {r.doc_id for r in rows} == {d for docs in planted.values() for d in docs}
    for r in rows:
        copy = found[r.doc_id].encode()[r.start_byte : r.end_byte].decode()
        assert len(copy.split()) == r.n_words >= chunk_dedup.MIN_WORDS
        assert sum(copy in other for other in found) > 1
    rest = {r.doc_id: r.text for r in chunk_dedup.remove_repeats(texts(found)).collect()}
    assert set(rest) == set(range(120)) and all(rest[i] == found[i] for i in range(40, 120))
    assert chunk_dedup.repeated_passages(texts([rest[i] for i in range(120)])).where("size(cuts) > 0").count() == 0
    # Nothing is lost: every removed chunk is still in some text.
    corpus = " ".join(rest.values())
    for i in range(40):
        for a, b in zip(bounds(found[i]), bounds(found[i])[1:], strict=False):
            assert found[i].encode()[a:b].decode().strip() in corpus


def test_odd_input(odd, empty):
    rows = chunk_dedup.repeated_passages(odd).collect()
    assert {r.doc_id for r in rows} == {6, 7}
    assert chunk_dedup.repeated_passages(empty).count() == 0
    rest = chunk_dedup.remove_repeats(odd)
    assert rest.columns == odd.columns
    by_id = {r.doc_id: r.text for r in rest.collect()}
    same = {r[0]: r[1] for r in ODD_ROWS if r[0] != 7}
    assert {d: t for d, t in by_id.items() if d != 7} == same
    assert 7 not in by_id or len(by_id[7]) < 200
    assert chunk_dedup.remove_repeats(empty).count() == 0


def test_rows_of_one_id_and_length_lose_their_own_passages_alone(spark):
    draw = random.Random(8)
    passage = prose(draw, 90)
    first, second = prose(draw, 40) + " " + passage, prose(draw, 20) + " " + passage + " " + prose(draw, 20)
    other = prose(draw, 400)[: len(second)]
    rows = [(1, first), (7, second), (7, other)]
    rest = [r.text for r in chunk_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    assert len(other) == len(second) and other in rest and first in rest and second not in rest
