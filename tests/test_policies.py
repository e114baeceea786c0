"""Cleaning policies on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from labelloom import Roles
from labelloom.operators import duplicates, policies, profile
from labelloom.operators.groups import attach_by_text, is_conflicting, text_groups


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


MIXED = [
    ("both", "age"),  # 0 conflicting
    ("pair", "age"),  # 1 consistent
    ("both", "gender"),  # 2
    ("pair", "age"),  # 3
    ("one", "religion"),  # 4
    ("three", "age"),  # 5 conflicting, majority age
    ("three", "gender"),  # 6
    ("three", "age"),  # 7
    (None, "age"),  # 8 null texts never conflict
    (None, "gender"),  # 9
]


def test_conflicting_text_is_dropped_entirely(labelled):
    df = labelled([("c", "age"), ("c", "gender"), ("s", "religion")])
    assert [r["text"] for r in policies.policy_d(df).collect()] == ["s"]


def test_consistent_duplicate_collapses(labelled):
    df = labelled([("d", "age"), ("d", "age"), ("u", "gender")])
    assert ids(policies.policy_d(df)) == [0, 2]


def test_policies_on_mixed_rows(labelled):
    df = labelled(MIXED)
    assert ids(policies.policy_a(df)) == [1, 3, 4, 8, 9]
    assert ids(policies.policy_c(df)) == [1, 3, 4, 8, 9]
    assert ids(policies.policy_b(df)) == [0, 1, 4, 5, 8]
    assert ids(policies.policy_d(df)) == [1, 4, 8]
    assert ids(policies.majority_resolved(df)) == [1, 4, 5]


def test_kept_rows_are_untouched(labelled):
    text = "See https://x.y @me #tag 😀 — done\n\t'\"  "
    row = policies.policy_d(labelled([(text, "age"), ("other", "gender")])).where("doc_id = 0").first()
    assert (row["text"], row["label"]) == (text, "age")


def test_null_labels_do_not_make_a_conflict(labelled):
    df = labelled([("t", None), ("t", "age"), ("u", None)])
    assert ids(policies.policy_d(df)) == [0, 2]
    assert ids(policies.policy_a(df)) == [0, 1, 2]


def test_order_may_be_several_columns(spark):
    rows = [(1, 2, "t", "b"), (1, 1, "t", "a"), (0, 9, "u", "a"), (2, 0, "u", "a")]
    df = spark.createDataFrame(rows, "c int, t int, text string, label string")
    roles = Roles(order=("c", "t"))
    kept = lambda d: sorted((r["c"], r["t"]) for r in d.collect())
    assert kept(policies.policy_b(df, roles)) == [(0, 9), (1, 1)]
    assert kept(policies.policy_d(df, roles)) == [(0, 9)]
    assert kept(policies.policy_a(df, roles)) == [(0, 9), (2, 0)]


def test_empty_and_all_unique(labelled):
    assert policies.policy_d(labelled([])).count() == 0
    assert policies.policy_a(labelled([])).count() == 0
    rows = [(f"t{i}", "age") for i in range(5)]
    assert ids(policies.policy_d(labelled(rows))) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("missing", ["text", "label", "doc_id"])
def test_missing_column_is_named(labelled, missing):
    with pytest.raises(ValueError, match=missing):
        policies.policy_d(labelled(MIXED).drop(missing))


def test_clean_table_has_no_duplicates_or_conflicts(labelled):
    df = policies.policy_d(labelled(MIXED).where("text is not null"))
    assert duplicates.remaining_duplicates(df).first().asDict() == {"duplicate_texts": 0, "conflicting_texts": 0}


def test_unknown_policy(labelled):
    with pytest.raises(ValueError):
        policies.apply_policy(labelled(MIXED), "E")
    assert ids(policies.apply_policy(labelled(MIXED), "D")) == [1, 4, 8]


def test_summary_agrees_with_the_rows(labelled):
    df = labelled(MIXED)
    summary = {r["policy"]: r for r in policies.policy_summary(df).collect()}
    for name, policy in policies.POLICY_FUNCTIONS.items():
        kept = policy(df)
        row = summary[name]
        assert row["total_rows"] == kept.count()
        assert row["rows_removed"] == df.count() - kept.count()
        assert row["unique_texts"] == kept.where("text is not null").select("text").distinct().count()
        left = duplicates.remaining_duplicates(kept).first()
        assert row["duplicate_texts_remaining"] == left["duplicate_texts"]
        assert row["conflicting_texts_remaining"] == left["conflicting_texts"]
    assert summary["baseline"]["total_rows"] == 10 and summary["baseline"]["conflicting_texts_remaining"] == 2


def test_class_matrix_agrees_with_the_rows(labelled):
    df = labelled(MIXED)
    rows = policies.policy_class_matrix(df).collect()
    (total,) = [r for r in rows if r["is_total"]]
    matrix = {r["label"]: r for r in rows if not r["is_total"]}
    assert all(total[f"rows_{p}"] == sum(r[f"rows_{p}"] for r in matrix.values()) for p in policies.POLICIES)
    for name, policy in policies.POLICY_FUNCTIONS.items():
        counts = {r["label"]: r["count"] for r in policy(df).groupBy("label").count().collect()}
        assert {k: v[f"rows_{name}"] for k, v in matrix.items()} == {k: counts.get(k, 0) for k in matrix}


def report(df):
    return {(r["section"], r["item"]): r["value"] for r in df.collect()}


def test_cleaning_report(labelled):
    found = report(policies.cleaning_report(labelled(MIXED)))
    summary = {k: v for (s, k), v in found.items() if s == "summary"}
    assert summary == {
        "original_row_count": 10,
        "conflicting_text_count": 2,
        "conflicting_unique_texts": 2,
        "conflicting_rows_removed": 5,
        "consistent_duplicate_groups": 1,
        "redundant_duplicate_rows_removed": 2,
        "total_rows_removed": 7,
        "final_row_count": 3,
        "final_unique_text_count": 2,
        "final_duplicate_text_count": 0,
        "final_conflicting_text_count": 0,
        "pct_retained": 30.0,
    }
    assert found["class_counts", "gender"] == 0 and found["class_percentages", "age"] == 66.6667


def test_cleaning_report_of_an_empty_table(labelled):
    found = report(policies.cleaning_report(labelled([])))
    assert set(found.values()) == {0.0}


def test_impact_report_matches_its_parts(labelled):
    df = labelled(MIXED)
    found = report(policies.policy_impact_report(df))
    for row in policies.policy_summary(df).collect():
        for metric in policies.METRICS:
            assert found[f"policy_{row['policy']}", metric] == row[metric]
    assert found["majority", "with_majority"] == 1 and found["majority", "tied"] == 1
    assert found["conflicts", "rows"] == 5
    for row in duplicates.conflict_impact_by_class(df).collect():
        assert found["conflict_rows", row["label"]] == row["rows_in_conflicts"]
    for row in duplicates.consistent_by_class(df).collect():
        assert found["consistent_redundant_copies", row["label"]] == row["redundant_copies"]


def test_delta(labelled):
    df = labelled(MIXED[:8])
    before = profile.class_distribution(df, dropna=True)
    after = profile.class_distribution(policies.policy_d(df), dropna=True)
    rows = {r["label"]: r for r in policies.distribution_delta(before, after).collect()}
    assert rows["age"]["delta_rows"] == -4 and rows["age"]["change_pct"] == -80.0
    assert rows["gender"]["after_n"] is None and rows["gender"]["delta_rows"] is None


def test_frequent_texts_take_the_broadcast_path_with_the_same_answer(spark, labelled):
    rows = [("hot", "age")] * 300 + [("hot", "gender")] + [("warm", "age")] * 50 + MIXED + [(f"u{i}", "age") for i in range(50)]
    df = labelled(rows).repartition(5)
    groups = text_groups(df, Roles()).select(
        "text_key", "n_rows", F.when(is_conflicting(), F.lit(True)).alias("bad")
    )
    flagged = [
        sorted(r["doc_id"] for r in attach_by_text(df, Roles(), groups, "bad", hot).where("bad").collect())
        for hot in (1, 40, 200, 1_000_000)
    ]
    assert all(f == flagged[0] for f in flagged) and len(flagged[0]) == 301 + 5
    kept = set(range(len(rows))) - set(flagged[0])
    assert set(ids(policies.policy_a(df))) == kept


def test_frequent_texts_scatter_over_the_join(spark, labelled):
    """Rows of a frequent text must not meet in one task."""
    rows = [("hot", "age")] * 4000 + [(None, "age")] * 4000 + [(f"u{i}", "age") for i in range(100)]
    df = labelled(rows)
    groups = text_groups(df, Roles()).select("text_key", "n_rows", F.lit(True).alias("seen"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = (
            attach_by_text(df, Roles(), groups, "seen", hot_rows=1000)
            .where("text = 'hot' or text is null")
            .groupBy(F.spark_partition_id().alias("p"), "text")
            .agg(F.count(F.lit(1)).alias("rows"), F.count("seen").alias("seen"))
            .collect()
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(r["rows"] for r in spread) < 1000
    assert sum(r["seen"] for r in spread) == 4000


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_partitioning_does_not_matter(spark, labelled, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = labelled(MIXED * 3).repartition(partitions)
        answers = [ids(policy(df)) for policy in policies.POLICY_FUNCTIONS.values()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    base = labelled(MIXED * 3).coalesce(1)
    assert answers == [ids(policy(base)) for policy in policies.POLICY_FUNCTIONS.values()]


def test_majority_counts_votes_of_labelled_rows_only(labelled):
    rows = [("t", "a"), ("t", "a"), ("t", "b"), ("t", None), ("t", None), ("u", "a"), ("u", None), ("v", "a"), ("v", None), ("v", None), ("w", None)]
    got = sorted((r["text"], r["label"]) for r in policies.majority_resolved(labelled(rows)).collect())
    assert got == [("t", "a"), ("u", "a"), ("v", "a")]
