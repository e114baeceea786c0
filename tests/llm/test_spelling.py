import random
import re
import zlib
from collections import Counter

import pytest

from labelloom.llm import spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    """Whether exactly one code point was inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(rows, min_length=6, min_count=5, ratio=5):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    forms, near = {}, {}
    for w, n in words.items():
        near[w] = [v for v in words if one_edit(w, v)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= ratio * n else None
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        yield (w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None)


def key(row):
    return row[0]


def rows_of(found):
    return sorted((tuple(r[c] for c in COLUMNS) for r in found.collect()), key=key)


def test_like_brute_force(texts):
    random.seed(5)
    base = ["international", "recieve", "window", "aaaaaa", "ababababab", "überraschung", "éééééé", "zwölfter", "mississippi", "abcdef"]
    vocabulary = Counter()
    for word in base:
        level, n = {word}, 700
        while n >= 5:
            for w in level:
                vocabulary[w] = n
            grown = set()
            for w in level:
                for _ in range(4):
                    i, c = random.randrange(len(w) + 1), random.choice("abeizéÿ")
                    grown |= {w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]}
            level, n = set(random.sample(sorted(grown), min(12, len(grown)))), n // random.choice([3, 5, 6])
    words = [w for w, n in vocabulary.items() for _ in range(n)]
    random.shuffle(words)
    given = [" ".join(w.upper() if random.random() < 0.1 else w for w in words[i : i + 50]) + "." for i in range(0, len(words), 50)]
    expected = sorted(brute_force(enumerate(given)), key=key)
    assert sum(row[1] is not None for row in expected) > 50 and any(row[1] != row[2] for row in expected if row[1])
    assert rows_of(spelling.variants(texts(given).repartition(4))) == expected


def test_every_near_word_meets():
    random.seed(7)
    for _ in range(400):
        letters = random.choice(["ab", "abcdef", "aé"])
        word = "".join(random.choice(letters) for _ in range(random.randint(6, 12)))
        i, c = random.randrange(len(word)), random.choice(letters)
        other = random.choice([word[:i] + c + word[i:], word[:i] + c + word[i + 1 :], (word + c)[:i] + (word + c)[i + 1 :]])
        if not one_edit(word, other):
            continue
        grams = Counter(g for w in (word, other) for g in spelling.bigrams(w))
        order = {g: (n, g) for g, n in grams.items()}
        indexed, probing = [], []
        for w in (word, other):
            found = spelling.bigrams(w)
            places = spelling.prefix(found, order)
            indexed.append(set(spelling.indexed_keys(w, places)))
            chosen = spelling.pivots(places, [order[found[p]][0] for p in places])
            assert chosen[1] - chosen[0] >= 2
            probing.append(set(spelling.probing_keys(w, chosen)))
        assert probing[0] & indexed[1] or probing[1] & indexed[0]


def test_driver_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = sorted(brute_force([(r.doc_id, r.text) for r in docs.collect()]), key=key)
    assert rows_of(spelling.variants(docs)) == expected


def test_chains_are_followed(texts):
    given = ["abcdefgh " * 625, "abcdefgx " * 125, "abcdefyx " * 25, "abcdezyx " * 5]
    found = {r.word: r for r in spelling.variants(texts(given)).collect()}
    expected = {row[0]: row for row in brute_force(enumerate(given))}
    assert {w: tuple(r) for w, r in found.items()} == expected
    assert found["abcdezyx"].root == "abcdefgh"


def test_odd_rows(odd, empty):
    found = spelling.variants(odd, min_count=1)
    assert found.columns == COLUMNS
    expected = sorted(brute_force([(r.doc_id, r.text) for r in odd.collect()], min_count=1), key=key)
    assert rows_of(found) == expected
    assert spelling.variants(empty).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(odd, min_length=3)


def test_slices_cut_no_run(monkeypatch):
    text = " ".join(["abcdefgh", "Übermut", "x"] * 50)
    whole = spelling.spelt_words("1", text)
    monkeypatch.setattr(spelling, "SLICE", 7)
    assert spelling.spelt_words("1", text) == whole
