"""Profiling on hand-made rows; pandas gives the length statistics to match."""

import pandas as pd
import pytest

from labelloom import Roles
from labelloom.functions.numbers import LENGTH_STATS
from labelloom.operators import profile, validate

ROWS = [
    ("hello world", "a"),
    ("hello world", "a"),
    ("hello world", "b"),
    ("see www.x.y @me #t 😀 soooo", "b"),
    ("   ", None),
    (None, "a"),
    ("é", "c"),
]


def test_shape(labelled):
    rows = profile.shape(labelled(ROWS)).collect()
    assert [(r["ordinal"], r["column_name"], r["data_type"]) for r in sorted(rows)] == [
        (0, "doc_id", "bigint"), (1, "text", "string"), (2, "label", "string"),
    ]
    assert {(r["n_rows"], r["n_cols"]) for r in rows} == {(7, 3)}


def test_class_distribution_with_and_without_nulls(labelled):
    df = labelled(ROWS)
    kept = {r["label"]: (r["n"], r["pct"]) for r in profile.class_distribution(df).collect()}
    assert kept == {"a": (3, 42.8571), "b": (2, 28.5714), "c": (1, 14.2857), None: (1, 14.2857)}
    dropped = {r["label"]: (r["n"], r["pct"]) for r in profile.class_distribution(df, dropna=True).collect()}
    assert dropped == {"a": (3, 50.0), "b": (2, 33.3333), "c": (1, 16.6667)}


def test_zero_filled_distribution(labelled):
    df = labelled(ROWS)
    rows = profile.class_distribution_zero_filled(df.where("label = 'a'"), df).collect()
    assert {r["label"]: (r["n"], r["pct"]) for r in rows} == {"a": (3, 100.0), "b": (0, 0.0), "c": (0, 0.0)}
    rows = profile.class_distribution_zero_filled(df.limit(0), df).collect()
    assert {(r["n"], r["pct"]) for r in rows} == {(0, 0.0)}


def test_missing_blank_and_duplicates(labelled):
    df = labelled(ROWS)
    missing = {r["column_name"]: (r["missing"], r["missing_pct"]) for r in profile.missing_values(df).collect()}
    assert missing == {"doc_id": (0, 0.0), "text": (1, 14.2857), "label": (1, 14.2857)}
    assert tuple(profile.blank_texts(df).first()) == (1, 1)
    assert tuple(profile.duplicate_counts(df).first()) == (1, 2, 1)
    assert profile.duplicate_rows(df, ["text", "label"]).first()[0] == 1
    assert profile.duplicate_rows(df).first()[0] == 0


def test_duplicates_count_nulls_as_equal(labelled):
    df = labelled([(None, "a"), (None, "a"), (None, None), (None, None), ("x", None), ("x", None)])
    assert tuple(profile.duplicate_counts(df).first()) == (3, 4, 0)
    assert profile.duplicate_rows(df, ["text", "label"]).first()[0] == 3


@pytest.mark.parametrize("texts", [["a b c", "ddd", "", "é é", "x" * 40, "lorem ipsum dolor"], ["one"]])
def test_length_statistics_match_pandas(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts + [None]], "text string")
    for operator, lengths in (
        (profile.char_length_stats, [len(t) for t in texts]),
        (profile.word_length_stats, [len(t.split()) for t in texts]),
    ):
        s = pd.Series(lengths)
        expected = {
            "min": s.min(), "max": s.max(), "mean": s.mean(), "median": s.median(), "std": s.std(),
            **{f"p{p}": s.quantile(p / 100) for p in (25, 75, 90, 95, 99)},
        }
        row = operator(df).first()
        for name in LENGTH_STATS:
            if pd.isna(expected[name]):
                assert row[name] is None
            else:
                assert row[name] == pytest.approx(expected[name], abs=0.0051)


def test_length_statistics_of_nothing(spark):
    row = profile.char_length_stats(spark.createDataFrame([], "text string")).first()
    assert set(row) == {None}


def test_flags_and_presence(labelled):
    df = labelled(ROWS)
    flagged = {r["feature"]: (r["n"], r["pct"]) for r in profile.feature_presence(df).collect()}
    assert flagged["urls"] == flagged["mentions"] == flagged["hashtags"] == flagged["emojis"] == (1, 16.6667)
    assert flagged["repeated_chars"] == (2, 33.3333)  # one row with www and soooo, one of three blanks
    row = profile.text_flags(df).where("doc_id = 3").first()
    assert row["has_urls"] and row["has_emojis"]
    assert tuple(profile.non_ascii_rows(df).first()) == (2, 33.3333)


def test_examples_and_previews(labelled):
    df = labelled([("first\nline", "a"), ("x" * 300, "a"), ("third", "a"), ("ü", "b"), (None, "b"), ("q", None)])
    rows = sorted(profile.examples_per_class(df).collect())
    assert [(r["label"], r["rank"], r["example"]) for r in rows] == [
        ("a", 1, "first line"), ("a", 2, "x" * 200), ("b", 1, "ü"),
    ]
    assert [r["preview"] for r in profile.non_ascii_preview(df).collect()] == ["ü"]
    assert [len(r["preview"]) for r in profile.preview(df, k=2).collect()] == [10, 150]


def test_profile_report_agrees_with_its_parts(labelled):
    df = labelled(ROWS)
    found = {(r["section"], r["item"]): r["value"] for r in profile.profile_report(df).collect()}
    assert found["totals", "n_rows"] == 7
    assert found["totals", "null_text_values"] == 1 and found["totals", "empty_whitespace_texts"] == 1
    counts = profile.duplicate_counts(df).first().asDict()
    assert {k: found["totals", k] for k in counts} == counts
    for r in profile.feature_presence(df).collect():
        assert found["totals", r["feature"]] == r["n"]
    assert found["totals", "non_ascii_rows"] == 2
    for r in profile.class_distribution(df).collect():
        label = r["label"] or "null"
        assert (found["class_counts", label], found["class_percentages", label]) == (r["n"], r["pct"])
    for section, operator in (("char_length", profile.char_length_stats), ("word_length", profile.word_length_stats)):
        assert operator(df).first().asDict() == {s: found[section, s] for s in LENGTH_STATS}


def test_profile_report_works_with_a_composite_order(spark):
    df = spark.createDataFrame([(1, 1, "a b", "x"), (1, 2, "c", "y")], "conv int, turn int, text string, label string")
    found = {(r["section"], r["item"]): r["value"] for r in profile.profile_report(df, Roles(order=("conv", "turn"))).collect()}
    assert found["totals", "n_rows"] == 2 and found["word_length", "max"] == 2


def test_required_columns(labelled):
    with pytest.raises(ValueError, match="nope"):
        profile.class_distribution(labelled(ROWS), "nope")


def test_column_roles(spark):
    df = spark.createDataFrame([("t1", "a", 1), ("t2", "a", 2), ("t3", "b", 3)], "t string, l string, n int")
    for approximate in (False, True):
        roles = {r["column_name"]: (r["n_distinct"], r["role"]) for r in validate.column_roles(df, approximate).collect()}
        assert roles == {"t": (3, "text"), "l": (2, "label")}
    only = validate.column_roles(df.select("t")).collect()
    assert [(r["column_name"], r["role"]) for r in only] == [("t", "text")]
    tied = spark.createDataFrame([("x", "y", "z")], "a string, b string, c string")
    assert {r["column_name"]: r["role"] for r in validate.column_roles(tied).collect()} == {
        "a": "label+text", "b": "other", "c": "other",
    }
    with pytest.raises(ValueError):
        validate.column_roles(df.select("n"))


def test_column_roles_do_not_count_nulls(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), ("x", "a")], "l string, t string")
    assert {r["column_name"]: r["n_distinct"] for r in validate.column_roles(df).collect()} == {"l": 1, "t": 2}


def test_null_audit(labelled):
    df = labelled(ROWS)
    assert {r["column_name"]: (r["nulls"], r["passes"]) for r in validate.null_audit(df, ["doc_id", "text"]).collect()} == {
        "doc_id": (0, True), "text": (1, False),
    }
    with pytest.raises(ValueError, match="text"):
        validate.assert_no_nulls(df, ["text", "label"])
    validate.assert_no_nulls(df, ["doc_id"])


def test_class_coverage(spark):
    df = spark.createDataFrame([("a", "train"), ("b", "train"), ("a", "val")], "label string, split string")
    gaps = validate.class_coverage_gaps(df, ["a", "b"], ["train", "val"]).collect()
    assert [tuple(r) for r in gaps] == [("val", "b")]
    assert validate.class_coverage_gaps(df, ["a"], ["train", "val"]).count() == 0


def test_unique_texts(labelled):
    assert tuple(validate.unique_text_check(labelled([("a", "x"), ("b", "x")])).first()) == (2, 2, True)
    assert tuple(validate.unique_text_check(labelled([("a", "x"), ("a", "x")])).first()) == (2, 1, False)
    assert tuple(validate.unique_text_check(labelled([("a", "x"), (None, "x")])).first()) == (2, 1, False)
    assert tuple(validate.unique_text_check(labelled([])).first()) == (0, 0, True)
    with pytest.raises(ValueError, match="2 rows"):
        validate.assert_unique_texts(labelled([("a", "x"), ("a", "x")]))


def test_expected_values(spark):
    report = spark.createDataFrame([("m1", 1.0), ("m2", 2.0), ("m3", None)], "k string, value double")
    expected = spark.createDataFrame([("m1", 1.0), ("m2", 3.0), ("m3", None), ("m4", 4.0)], "k string, value double")
    rows = validate.expected_value_mismatches(report, expected, ["k"]).collect()
    assert sorted(tuple(r) for r in rows) == [("m2", 2.0, 3.0), ("m4", None, 4.0)]
