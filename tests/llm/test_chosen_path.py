import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from labelloom.llm import chosen_path, components, shared
from llm.conftest import ODD_ROWS


def sets_of(found):
    return {i: set(chosen_path.shingles(t or "").tolist()) for i, t in found}


def brute_force(found):
    sets = sets_of(found)
    links, least = defaultdict(int), {i: i for i in sets}
    pairs = [(a, b) for a, b in combinations(sorted(sets), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return {i: (least[i], links[i]) for i in sets}


def corpus(seed, n_groups, size, n_alone):
    """Groups of edited copies, some of them exact, between texts that have nothing or a passage in common."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefghij", k=draw.randrange(2, 8)))
    passage = [word() for _ in range(40)]
    found = []
    for _ in range(n_groups):
        base = [word() for _ in range(draw.randrange(40, 200))]
        for _ in range(draw.randrange(2, size)):
            copy = list(base)
            for _ in range(draw.randrange(0, 4)):
                copy[draw.randrange(len(copy))] = word()
            found.append(" ".join(copy))
    for _ in range(n_alone):
        found.append(" ".join([word() for _ in range(draw.randrange(1, 60))] + passage * draw.randrange(2)))
    draw.shuffle(found)
    return found


@pytest.mark.parametrize("bucket, max_depth, share", [(256, 4, shared.HOT_SHARE), (8, 2, 0.0), (16, 3, 1.0)])
def test_links_and_classes_are_those_of_brute_force(texts, monkeypatch, bucket, max_depth, share):
    monkeypatch.setattr(shared, "HOT_SHARE", share)
    found = corpus(bucket, 25, 30, 100)
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.similar(texts(found), bucket=bucket, max_depth=max_depth).collect()}
    expected = brute_force(list(enumerate(found)))
    assert set(got) == set(expected)
    links_got, links = (sum(n for _, n in x.values()) for x in (got, expected))
    assert links > 500 and 0.999 * links <= links_got <= links
    assert sum(got[i][0] == expected[i][0] for i in got) >= 0.99 * len(got)


def test_odd_input(odd, empty):
    rows = chosen_path.similar(odd)
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in rows.collect())
    alone = [(str(d), str(d), 0) for d in (3, 4, 5, 8, 9, None)]
    assert got == sorted([("1", "1", 2), ("2", "1", 2), ("2", "1", 2), ("6", "6", 1), ("7", "6", 1), *alone])
    assert chosen_path.similar(empty).count() == 0
    kept = chosen_path.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 3, 4, 5, 6, 8, 9, None]))
    assert len(ODD_ROWS) == 11


def test_runs_grow_with_recall():
    runs = [chosen_path.runs_for(recall) for recall in (0.5, 0.9, 0.99, 0.999)]
    assert runs == sorted(runs) and runs[0] >= 1 and runs[-1] <= 10


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(200, 260)] + [(500, 400), (400, 300), (7, 7)]
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    got = {r.node: r.component for r in found.collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in range(200, 260))
    assert got[500] == got[400] == got[300] == 300 and found.count() == len(got)
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert components.components(none).count() == 0


def test_one_row_of_each_class_stays(spark):
    one, other = (" ".join(f"{x}{i}" for i in range(80)) for x in "ab")
    rows = [(3, one), (7, one + " tail"), (7, other), (5, "c " + other), (5, "c " + other), (None, one)]
    kept = chosen_path.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(3, one), (5, "c " + other), (None, one)], key=str)
    alone = [(3, one), (7, one + " tail"), (7, other)]
    kept = chosen_path.keep_one(spark.createDataFrame(alone, "doc_id bigint, text string"))
    assert sorted(map(tuple, kept.collect())) == sorted([(3, one), (7, other)])


def test_shared_shingles_are_counted_in_parts(monkeypatch):
    draw = np.random.default_rng(4)
    pool = draw.integers(-(2**63), 2**63 - 1, 400)
    sets = [np.unique(draw.choice(pool, draw.integers(0, 200))) for _ in range(12)]
    left, right = np.arange(5), np.arange(5, 12)
    expected = [[len(np.intersect1d(sets[i], sets[j])) for j in right] for i in left]
    for size in (1 << 20, 100, 7):
        monkeypatch.setattr(chosen_path, "PART_SHINGLES", size)
        assert chosen_path.shared_counts(sets, left, right).tolist() == expected
