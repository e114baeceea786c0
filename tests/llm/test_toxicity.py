import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from labelloom.llm import toxicity


def corpus(n=900, seed=2):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefghijkl", k=draw.randrange(2, 7))) for _ in range(300)]
    bad = [f"bad{i}" for i in range(8)]
    rows, labels = [], []
    for i in range(n):
        toxic = int(draw.random() < 0.2)
        text = draw.choices(words, k=draw.randrange(20, 200))
        if toxic:
            text = [draw.choice(bad) + draw.choice(["", "!", ","]) if draw.random() < 0.08 else w for w in text] + [draw.choice(bad)]
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    return rows, labels


def test_held_out_documents(spark):
    rows, labels = corpus()
    docs, known = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    got, truth = toxicity.toxicity(docs, known).collect(), dict(labels)
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    wrong = sum(r.predicted != truth[r.doc_id] for r in held)
    assert wrong <= 0.05 * len(held) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    one, two = (sorted(toxicity.toxicity(docs, spark.createDataFrame(x, "doc_id bigint, toxic int")).collect()) for x in (labels, flipped))
    assert one == two


def test_followings_are_distinct_pairs(spark):
    rows = [("a b a b", 1), ("a b c", 1), ("x b, A.", 0), ("", 0), (None, 1)]
    got = toxicity.followings(spark.createDataFrame(rows, "body string, toxic int")).collect()
    pairs = {0: set(), 1: set()}
    for text, toxic in rows:
        found = toxicity.numbers(text).tolist()
        pairs[toxic] |= set(zip([0, *found], found))
    for r in got:
        of = [{p for p in pairs[c] if p[1] == r.word} for c in (0, 1)]
        assert (r.ordinary, r.toxic, r.both) == (len(of[0]), len(of[1]), len(of[0] | of[1]))
    assert len(got) == len({w for c in pairs.values() for _, w in c})


def test_models_are_distributions_and_rare_words_tell_nothing():
    counts = pa.table({"word": [1, 2, 3], "toxic": [100, 0, 1], "ordinary": [100, 80, 0], "both": [150, 80, 1]})
    of_words = toxicity.evidence_of_words(counts)
    assert of_words.shape == (len(toxicity.DISCOUNTS), toxicity.BUCKETS)
    assert (of_words[:, 2] < -1).all() and (np.abs(of_words[:, 1]) < 0.7).all()
    # Under a discount above its count, the rare word is as likely in either class but for the models' shares of backoff.
    assert np.allclose(of_words[1:, 3], of_words[1:, 5])
    assert toxicity.evidence_of_words(counts.slice(1, 1)) is None


def test_odd_input(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 0), (7, 1), (8, None), (None, 1), (9, 0), (9, 1)], "doc_id bigint, toxic int")
    rows = toxicity.toxicity(odd, labels).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(empty, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(odd, labels.where("false")).collect()} == {0.0}


@pytest.mark.parametrize("slope", [0.5, 5.0])
def test_line_is_found(slope):
    x = np.random.default_rng(1).normal(size=4000)
    y = (np.random.default_rng(2).random(4000) < 1 / (1 + np.exp(-(slope * x - 1)))).astype(float)
    a, b, _ = toxicity.fitted_line(x, y)
    assert a == pytest.approx(slope, rel=0.2) and b == pytest.approx(-1, abs=0.3)


def test_words_share_no_number(spark):
    words = [f"w{i}" for i in range(20_000)]
    assert len(set(toxicity.numbers(" ".join(words)).tolist())) == len(words)


@pytest.mark.parametrize("places", [1, 40])
def test_words_beyond_the_broadcast_ones_count_as_well(spark, monkeypatch, places):
    rows, labels = corpus(300)
    rows.append((300, None))
    docs, known = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    expected = {r.doc_id: r.score for r in toxicity.toxicity(docs, known).collect()}
    monkeypatch.setattr(toxicity, "BUCKETS", places)
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, known).collect()}
    assert got == pytest.approx(expected, abs=1e-6)
