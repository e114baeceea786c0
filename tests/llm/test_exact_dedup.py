import hashlib
import re
from collections import defaultdict

import pytest

from labelloom.llm import exact_dedup, shared
from llm.conftest import ODD_ROWS


def brute_force(rows):
    same = defaultdict(list)
    for doc, text in rows:
        same[re.sub("[ \t-\r]+", " ", text or "")].append(doc)
    found = []
    for doc, text in rows:
        norm = re.sub("[ \t-\r]+", " ", text or "")
        keep = min((d for d in same[norm] if d is not None), default=None)
        found.append((doc, keep, len(same[norm]), doc == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(found, key=str)


def test_odd_input(odd, empty):
    got = exact_dedup.mark_duplicates(odd)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force([r[:2] for r in ODD_ROWS])
    assert exact_dedup.mark_duplicates(empty).count() == 0
    kept = exact_dedup.drop_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "5", "6", "7", "8", "9", "None"]


@pytest.mark.parametrize("share", [shared.HOT_SHARE, 0.0, 1.0])
def test_hot_and_usual_groups_agree(texts, monkeypatch, share):
    monkeypatch.setattr(shared, "HOT_SHARE", share)
    found = ["x y"] * 30 + ["x\ty", "x  y", " x y"] + [f"x {i}" for i in range(40)] + ["p" * 200 + str(i % 3) for i in range(9)]
    got = exact_dedup.mark_duplicates(texts(found))
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(list(enumerate(found)))


def test_only_survivors_are_read_again(texts):
    found = ["alone", "short", "same", "same", "q" * 150 + "1", "q" * 150 + "2"]
    got = exact_dedup.survivors(texts(found), "doc_id", "text")
    assert sorted(r.id for r in got.collect()) == [0, 1, 2, 3, 4, 5][2:]
    assert [r.group_size for r in exact_dedup.duplicate_groups(texts(found)).collect()] == [2]


def test_one_row_of_each_text_stays(spark):
    rows = [(3, "A"), (7, "A"), (7, "B"), (5, "C"), (5, "C"), (None, "D"), (None, "D"), (None, "E"), (9, "E")]
    kept = exact_dedup.drop_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(3, "A"), (7, "B"), (5, "C"), (None, "D"), (9, "E")], key=str)
