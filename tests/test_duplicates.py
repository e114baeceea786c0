"""Duplicate and conflict analysis on hand-made rows."""

import pytest

from labelloom.operators import duplicates

ROWS = [
    ("p", "a"), ("p", "a"), ("p", "a"),  # consistent, three times
    ("q", "b"), ("q", "a"),  # conflicting, tied
    ("r", "b"), ("r", "c"), ("r", "b"),  # conflicting, majority b
    ("s", "a"), ("s", "b"),  # conflicting, tied
    ("once", "c"),
    (None, "a"), (None, "a"),
]


@pytest.fixture
def df(labelled):
    return labelled(ROWS)


def one(frame):
    return frame.first().asDict()


def test_exact_duplicates(df):
    assert one(duplicates.exact_duplicates(df)) == {
        "all_copies": 7, "non_first_copies": 4, "unique_pairs_with_duplicates": 2,
    }


def test_samples(labelled):
    long = "z" * 60
    rows = [(long + "1", "a"), (long + "2", "a"), (long + "2", "a"), (long + "1", "a"), ("x", "b"), ("x", "b"), ("x", "c")]
    found = duplicates.duplicate_samples(labelled(rows)).collect()
    assert [(r["lead"], r["label"], r["first_order"], r["sample"]) for r in found] == [
        (long, "a", 0, long + "1"), ("x", "b", 4, "x"),
    ]
    assert len(duplicates.duplicate_samples(labelled(rows), k=1).collect()) == 1


def test_multiplicity(df):
    assert one(duplicates.text_multiplicity(df)) == {"unique_texts": 5, "texts_repeated": 4, "texts_once": 1}
    assert {tuple(r) for r in duplicates.multiplicity_histogram(df).collect()} == {(2, 2), (3, 2)}


def test_label_profile(df):
    rows = {r["text"]: (r["first_order"], r["labels"], r["n_labels"], r["n_rows"]) for r in duplicates.text_label_profile(df, with_text=True).collect()}
    assert rows["r"] == (5, ["b", "c"], 2, 3) and rows["p"] == (0, ["a"], 1, 3) and len(rows) == 5
    assert "text" not in duplicates.text_label_profile(df).columns


def test_consistent_and_conflicting(df):
    assert one(duplicates.consistent_vs_conflicting(df)) == {
        "repeated_texts": 4, "consistent_texts": 1, "consistent_rows": 3,
        "conflicting_texts": 3, "conflicting_rows": 7, "max_labels_per_text": 2,
    }


def test_combinations(df):
    assert [tuple(r) for r in duplicates.label_combinations(df).collect()] == [
        ("a + b", 2, 4, 66.67), ("b + c", 1, 3, 33.33),
    ]
    examples = {(r["combination"], r["label"]): (r["first_order"], r["sample"], r["n"]) for r in duplicates.combination_examples(df).collect()}
    assert examples == {
        ("a + b", "a"): (3, "q", 1), ("a + b", "b"): (3, "q", 1),
        ("b + c", "b"): (5, "r", 2), ("b + c", "c"): (5, "r", 1),
    }


def test_conflict_frequency(df):
    assert one(duplicates.conflict_frequency(df)) == {"seen_twice": 2, "seen_three_or_more": 1}


def test_impact_by_class(df):
    rows = {r["label"]: (r["rows_in_conflicts"], r["texts_in_conflicts"]) for r in duplicates.conflict_impact_by_class(df).collect()}
    assert rows == {"a": (2, 2), "b": (4, 3), "c": (1, 1)}


def test_majority(df):
    assert one(duplicates.majority_check(df)) == {"with_majority": 1, "tied": 2, "majority_applicable": True}


def test_majority_needs_more_than_half(labelled):
    rows = [("t", "a"), ("t", "a"), ("t", "b"), ("t", "c")]
    assert one(duplicates.majority_check(labelled(rows)))["with_majority"] == 0


def test_consistent_by_class(df):
    rows = {r["label"]: (r["all_copies"], r["redundant_copies"]) for r in duplicates.consistent_by_class(df).collect()}
    assert rows == {"a": (3, 2), "b": (0, 0), "c": (0, 0)}


def test_remaining(df):
    assert one(duplicates.remaining_duplicates(df)) == {"duplicate_texts": 4, "conflicting_texts": 3}


def test_report_agrees_with_its_parts(df):
    found = {(r["section"], r["item"]): r["value"] for r in duplicates.duplicate_report(df).collect()}
    assert found["texts", "total_rows"] == 13
    for section, part in (
        ("texts", duplicates.text_multiplicity(df)),
        ("exact_duplicates", duplicates.exact_duplicates(df)),
        ("repeated_texts", duplicates.consistent_vs_conflicting(df).drop("repeated_texts")),
    ):
        for item, value in one(part).items():
            assert found[section, item] == value, item
    assert found["multiplicity", "3"] == 2
    assert found["combination_rows", "b + c"] == 3 and found["combination_texts", "a + b"] == 2


def test_empty_table(labelled):
    empty = labelled([])
    assert one(duplicates.consistent_vs_conflicting(empty))["conflicting_rows"] == 0
    assert one(duplicates.exact_duplicates(empty)) == {
        "all_copies": 0, "non_first_copies": 0, "unique_pairs_with_duplicates": 0,
    }
    assert one(duplicates.majority_check(empty))["majority_applicable"] is False
    assert duplicates.label_combinations(empty).count() == 0


def test_combinations_are_not_gathered_for_their_total(labelled):
    df = labelled([("t", "a"), ("t", "b"), ("u", "a"), ("u", "c"), ("v", "a")])
    table = duplicates.label_combinations(df)
    assert "Window" not in table._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["combination"], r["pct_of_conflicts"]) for r in table.collect()] == [("a + b", 50.0), ("a + c", 50.0)]
