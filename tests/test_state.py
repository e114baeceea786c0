"""Per-text counts kept from one load to the next."""

import random

import pytest

from labelloom import Roles
from labelloom.operators import duplicates, policies, state

OPERATORS = [
    duplicates.exact_duplicates,
    duplicates.duplicate_samples,
    duplicates.text_multiplicity,
    duplicates.multiplicity_histogram,
    duplicates.text_label_profile,
    duplicates.consistent_vs_conflicting,
    duplicates.label_combinations,
    duplicates.combination_examples,
    duplicates.conflict_frequency,
    duplicates.conflict_impact_by_class,
    duplicates.majority_check,
    duplicates.consistent_by_class,
    duplicates.remaining_duplicates,
    duplicates.duplicate_report,
    policies.policy_summary,
]
BUCKETS = 8


@pytest.fixture(scope="module")
def table(spark):
    draw = random.Random(12)
    texts = [f"text {i}\n" + "long " * draw.randrange(60) for i in range(150)] + ["", None]
    rows = [(i, draw.choice(texts), draw.choice(["a", "b", "c", None])) for i in range(600)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, label string")


@pytest.fixture(scope="module")
def kept(spark, table, tmp_path_factory):
    """The first rows saved, others merged in and saved, and read again as a later session would."""
    folder = tmp_path_factory.mktemp("state")
    first = state.build(table.where("doc_id < 250")).save(str(folder / "one"), BUCKETS)
    first.merged(table.where("doc_id between 250 and 399")).save(str(folder / "two"), BUCKETS)
    return state.load(spark, str(folder / "two"), BUCKETS)


def rows_of(df):
    return sorted((str(tuple(r)) for r in df.collect()))


@pytest.mark.parametrize("operator", OPERATORS, ids=lambda f: f.__name__)
def test_state_and_new_rows_give_what_the_whole_table_gives(table, kept, operator):
    whole = kept.merged(table.where("doc_id >= 400"))
    assert rows_of(operator(whole, Roles())) == rows_of(operator(table, Roles()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_new_rows_move(spark, table, kept):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = plan(kept.merged(table.where("doc_id >= 400")).frame.where("text_key is not null")).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    (join,) = [k for k, line in enumerate(lines) if "SortMergeJoin" in line]
    (scan,) = [k for k, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line]
    # The stored side comes first below the join; its rows are sorted in their tasks and not moved.
    assert join < scan and not any("Exchange" in line for line in lines[join:scan])
    assert any("Exchange" in line for line in lines[scan:])


def test_what_a_state_lacks(table, kept):
    with pytest.raises(ValueError, match="characters"):
        duplicates.combination_examples(kept, width=10)
    with pytest.raises(ValueError, match="whole texts"):
        duplicates.text_label_profile(kept, with_text=True)
    with pytest.raises(ValueError, match="keep"):
        kept.label_counts({"length": None})


def test_empty_states(spark, table, tmp_path):
    nothing = state.build(table.where("false")).save(str(tmp_path / "s"), BUCKETS)
    assert nothing.frame.count() == 0
    assert rows_of(duplicates.duplicate_report(nothing.merged(table), Roles())) == rows_of(duplicates.duplicate_report(table))
    assert nothing.merged(table.where("false")).frame.count() == 0
