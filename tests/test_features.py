"""Label index, TF-IDF and id sequences against the definitions written out in Python."""

import math
import re
from collections import Counter

import pytest
from pyspark.ml.linalg import SparseVector

from labelloom import Roles
from labelloom.operators import features

TEXTS = [
    "The cat sat on the mat, the CAT!",
    "Dogs and cats don't mix; dogs bark",
    "été à la plage d'été",
    ":-) !!",
    None,
    "cat dog cat bird zebra",
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, t, "ab"[i % 2]) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, label string")


def words(text):
    return re.findall(r"\b\w\w+\b", (text or "").lower())


def pieces(text):
    lowered = (text or "").lower()
    for c in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def expected_vocabulary(texts, k, stop):
    lists = [[w for w in words(t) if w not in stop] for t in texts]
    tf = Counter(w for ws in lists for w in ws)
    df = Counter(w for ws in lists for w in set(ws))
    top = sorted(sorted(tf, key=lambda w: (-tf[w], w))[:k])
    return {w: (i, tf[w], df[w], math.log((1 + len(texts)) / (1 + df[w])) + 1) for i, w in enumerate(top)}


@pytest.mark.parametrize("k", [3, 50])
@pytest.mark.parametrize("stop", [[], ["the", "and", "on"]])
def test_tfidf_vocabulary(docs, k, stop):
    found = {r["term"]: (r["term_id"], r["tf"], r["df"], r["idf"]) for r in features.tfidf_vocabulary(docs, "text", k, stop).collect()}
    expected = expected_vocabulary(TEXTS, k, stop)
    assert found.keys() == expected.keys()
    for term, values in expected.items():
        assert found[term] == pytest.approx(values)


def test_default_stop_words_are_left_out(docs):
    terms = {r["term"] for r in features.tfidf_vocabulary(docs).collect()}
    assert "the" not in terms and "cat" in terms
    with pytest.raises(ValueError):
        features.tfidf_vocabulary(docs, max_features=0)


def test_tfidf_weights_and_vectors(docs):
    vocabulary = features.tfidf_vocabulary(docs.where("doc_id < 3"), max_features=6, stop_words=[])
    known = expected_vocabulary(TEXTS[:3], 6, [])
    found = {(r["doc_id"], r["term"]): (r["tf"], r["weight"]) for r in features.tfidf_weights(docs, vocabulary).collect()}
    expected = {}
    for i, text in enumerate(TEXTS):
        tf = Counter(w for w in words(text) if w in known)
        norm = math.sqrt(sum((n * known[w][3]) ** 2 for w, n in tf.items()))
        expected.update({(i, w): (n, n * known[w][3] / norm) for w, n in tf.items()})
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        assert found[key] == pytest.approx(values)
    vectors = {r["doc_id"]: r["features"] for r in features.tfidf_vectors(docs, vocabulary).collect()}
    assert isinstance(vectors[0], SparseVector) and vectors[0].size == 6
    assert vectors[3].numNonzeros() == vectors[4].numNonzeros() == 0
    for (i, term), (_, weight) in expected.items():
        assert vectors[i][known[term][0]] == pytest.approx(weight)


def test_no_terms_left(docs):
    nothing = features.tfidf_vocabulary(docs.where("doc_id = 3"), stop_words=[])
    assert nothing.count() == 0
    with pytest.raises(ValueError, match="empty"):
        features.tfidf_vectors(docs, nothing)


def expected_ids(texts, size):
    seen = list(dict.fromkeys(w for t in texts for w in pieces(t)))
    n = Counter(w for t in texts for w in pieces(t))
    ranked = sorted(seen, key=lambda w: -n[w])  # stable: ties stay in order of first occurrence
    return {w: i + 2 for i, w in enumerate(ranked) if i + 2 < size}


@pytest.mark.parametrize("size", [2, 5, 100])
def test_sequence_vocabulary(docs, size):
    found = {r["word"]: r["word_id"] for r in features.sequence_vocabulary(docs.repartition(3), vocab_size=size).collect()}
    assert found == expected_ids(TEXTS, size)


def test_sequence_vocabulary_with_composite_order(spark):
    df = spark.createDataFrame([(0, 1, "b a"), (0, 0, "c"), (1, 0, "a")], "c int, t int, text string")
    found = {r["word"]: r["word_id"] for r in features.sequence_vocabulary(df, Roles(order=("c", "t"))).collect()}
    assert found == {"a": 2, "c": 3, "b": 4}
    padded = features.padded_sequences(df, features.sequence_vocabulary(df, Roles(order=("c", "t"))), Roles(order=("c", "t")), 3)
    assert {(r["c"], r["t"]): r["sequence"] for r in padded.collect()} == {(0, 0): [3, 0, 0], (0, 1): [4, 2, 0], (1, 0): [2, 0, 0]}


@pytest.mark.parametrize("padding", ["post", "pre"])
@pytest.mark.parametrize("truncating", ["post", "pre"])
@pytest.mark.parametrize("length", [1, 4, 20])
def test_padded_sequences(docs, padding, truncating, length):
    vocabulary = features.sequence_vocabulary(docs.where("doc_id < 2"), vocab_size=8)
    ids = expected_ids(TEXTS[:2], 8)
    found = {r["doc_id"]: r["sequence"] for r in features.padded_sequences(docs, vocabulary, Roles(), length, padding, truncating).collect()}
    for i, text in enumerate(TEXTS):
        sequence = [ids.get(w, 1) for w in pieces(text)] or [1]
        sequence = sequence[:length] if truncating == "post" else sequence[-length:]
        fill = [0] * (length - len(sequence))
        assert found[i] == (sequence + fill if padding == "post" else fill + sequence)


def test_label_index_round_trip(spark, docs):
    index = features.label_index(docs, expected=["a", "b"])
    assert {r["label"]: r["label_id"] for r in index.collect()} == {"a": 0, "b": 1}
    encoded = features.encode_labels(docs, index)
    decoded = features.decode_labels(encoded, index, out="decoded")
    assert decoded.where("label <> decoded or decoded is null").count() == 0
    with pytest.raises(ValueError, match="missing_one"):
        features.label_index(docs, expected=["a", "missing_one"])
    unknown = spark.createDataFrame([("zz",)], "label string")
    assert features.encode_labels(unknown, index).first()["label_id"] is None


def test_normalized_text(docs, spark):
    df = spark.createDataFrame([("@a http://b c", ), (None,)], "text string")
    assert [r["normalized"] for r in features.normalized_text(df).collect()] == ["<USER> <URL> c", None]


def test_sequences_are_looked_up_in_the_row(docs):
    vocabulary = features.sequence_vocabulary(docs)
    plan = features.padded_sequences(docs, vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


@pytest.mark.parametrize("size", [0, features.MAX_VOCABULARY + 1])
def test_sizes_are_bounded(docs, size):
    with pytest.raises(ValueError, match="must be from"):
        features.tfidf_vocabulary(docs, max_features=size)
    with pytest.raises(ValueError, match="must be from"):
        features.sequence_vocabulary(docs, vocab_size=size)


def test_a_label_with_too_many_values_is_refused(docs, monkeypatch):
    monkeypatch.setattr(features, "MAX_LABELS", 1)
    with pytest.raises(ValueError, match="isn't a class label"):
        features.label_index(docs)
