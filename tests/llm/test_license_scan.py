import math
import re
from collections import Counter

import pytest

from labelloom.llm import license_scan, shared

MIT, APACHE = license_scan.TEMPLATES["MIT"][1], license_scan.TEMPLATES["Apache-2.0"][0]
FILES = [
    ("a/LICENSE", MIT + " etc"), ("a/b/c.py", "x = 1"), ("a/b/d/e.py", "x"), ("a/x/LICENSE.txt", APACHE), ("a/x/y.py", None), ("z.py", ""),
    (None, "q"), ("/abs/COPYING", "This work is licensed under the GNU General Public License, version 3."), ("/abs/q/r.c", "int"),
    ("a//b/k.py", "foo"), ("a/own.py", "# Licensed under the Apache License, Version 2.0.\nimport os\n"), ("a/b/c.py", "x = 1"),
    ("long/t.txt", "the license of words " * 20_000 + "\n\nReleased under the MIT License.\n"),
]
EXPECTED = {
    "a/LICENSE": ("MIT", "own", None), "a/b/c.py": ("MIT", "inherited", "a"), "a/b/d/e.py": ("MIT", "inherited", "a"),
    "a/x/LICENSE.txt": ("Apache-2.0", "own", None), "a/x/y.py": ("Apache-2.0", "inherited", "a/x"), "z.py": (None, None, None),
    None: (None, None, None), "/abs/COPYING": ("GPL-3.0", "own", None), "/abs/q/r.c": ("GPL-3.0", "inherited", "/abs"),
    "a//b/k.py": ("MIT", "inherited", "a"), "a/own.py": ("Apache-2.0", "own", None), "long/t.txt": ("MIT", "own", None),
}


@pytest.mark.parametrize("share", [shared.HOT_SHARE, 0.0, 1.0])
def test_own_and_inherited(spark, monkeypatch, share):
    monkeypatch.setattr(shared, "HOT_SHARE", share)
    files = spark.createDataFrame(FILES, "path string, body string").selectExpr("*", "path as dir", "1 as n", "path as license", "2 as row")
    got = license_scan.licenses(files, "path", "body").collect()
    assert len(got) == len(FILES)
    assert {r.path: (r.license, r.origin, r.license_dir) for r in got} == EXPECTED
    assert license_scan.licenses(files.where("false"), "path", "body").count() == 0


def test_cosines_are_those_of_brute_force(spark):
    words = lambda text: Counter(re.findall(license_scan.WORD, text.lower()))
    texts = [b for _, b in FILES[:-1] if b] + ["Released under the MIT License, or the Apache License, Version 2.0", "released under licence"]
    n = len(texts)
    df = Counter(w for t in texts for w in words(t))
    vocabulary = {w for found in license_scan.TEMPLATES.values() for t in found for w in words(t)}
    idf = lambda w: math.log((n + 1) / ((df[w] if w in vocabulary else 0) + 1)) + 1
    vector = lambda text: {w: tf * idf(w) for w, tf in words(text).items()}

    def cosine(a, b):
        length = lambda v: math.sqrt(sum(x * x for x in v.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / (length(a) * length(b)) if a and b else 0

    expected = {}
    for i, text in enumerate(texts):
        lines = {*text.split("\n"), text}
        scores = [(-round(cosine(vector(s), vector(t)), 6), name) for s in lines for name, found in license_scan.TEMPLATES.items() for t in found]
        best = min(scores)
        expected[i] = (best[1], -best[0]) if -best[0] >= license_scan.THRESHOLD else (None, None)
    files = spark.createDataFrame(list(enumerate(texts)), "path int, body string").selectExpr("string(path) as path", "body")
    got = {int(r.path): r for r in license_scan.licenses(files, "path", "body").collect()}
    for i, (name, score) in expected.items():
        own = (got[i].license, got[i].cosine) if got[i].origin == "own" else (None, None)
        assert own[0] == name and (name is None or own[1] == pytest.approx(score, abs=2e-6))


def test_telling_words_cover_the_threshold():
    vectors = {"t": {"a": 3.0, "b": 2.0, "c": 1.0, "d": 0.5}}
    telling = license_scan.telling_words(vectors, 0.75)
    rest = [w for word, w in vectors["t"].items() if word not in telling]
    assert "a" in telling and math.sqrt(sum(w * w for w in rest)) < 0.75 * math.sqrt(sum(w * w for w in vectors["t"].values()))
