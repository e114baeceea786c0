"""Split quotas, assignment, audits and reports."""

import hashlib

import pytest
from pyspark.sql import functions as F

from labelloom import Roles
from labelloom.operators import pin as pinning
from labelloom.operators import split
from labelloom.operators.policies import policy_d

# Published class sizes of a 44,378-row table and of its 80/10/10 split, in
# the published order. Only the sizes matter to the quotas, so the classes go by number.
GOLDEN = {
    "class1": (7992, 6393, 800, 799),
    "class2": (7952, 6362, 795, 795),
    "class3": (7772, 6218, 777, 777),
    "class4": (6428, 5142, 643, 643),
    "class5": (6243, 4994, 624, 625),
    "class6": (7991, 6393, 799, 799),
}


def balanced(spark, per_class=100, classes="abcdef"):
    rows = [(i * len(classes) + j, f"text {i} {c}", c) for i in range(per_class) for j, c in enumerate(classes)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, label string")


def assignment(df):
    return {r["doc_id"]: r["split"] for r in df.select("doc_id", "split").collect()}


def counts(df):
    return {(r["label"], r["split"]): r["count"] for r in df.groupBy("label", "split").count().collect()}


def expected_assignment(rows, test, val, seed):
    """The definition, row by row: quotas by largest remainder, rows by rank of their hash."""
    sizes = {}
    for _, label in rows:
        sizes[label] = sizes.get(label, 0) + 1

    def shares(sizes, seats):
        total = sum(sizes.values())
        got = {k: v * seats // total for k, v in sizes.items()}
        by_rest = sorted(sizes, key=lambda k: (-(sizes[k] * seats % total), k))
        for k in by_rest[: seats - sum(got.values())]:
            got[k] += 1
        return got

    tests = shares(sizes, round(len(rows) * test))
    vals = shares({k: v - tests[k] for k, v in sizes.items()}, round(len(rows) * val))
    out = {}
    for label in sizes:
        ranked = sorted((hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), i) for i, l in rows if l == label)
        for place, (_, i) in enumerate(ranked):
            out[i] = "test" if place < tests[label] else "val" if place < tests[label] + vals[label] else "train"
    return out


def test_golden_quotas(spark):
    classes = spark.createDataFrame([(k, v[0]) for k, v in GOLDEN.items()], "label string, n bigint")
    found = {r["label"]: (r["n"], r["train_n"], r["val_n"], r["test_n"]) for r in split.split_quotas(classes).collect()}
    assert found == GOLDEN


def test_sizes_round_half_to_even(spark):
    classes = spark.createDataFrame([("a", 25)], "label string, n bigint")
    row = split.split_quotas(classes).first()
    assert (row["test_n"], row["val_n"], row["train_n"]) == (2, 2, 21)


def test_equal_remainders_go_by_label(spark):
    classes = spark.createDataFrame([(c, 5) for c in "dbca"], "label string, n bigint")
    rows = {r["label"]: r["test_n"] for r in split.split_quotas(classes).collect()}
    assert rows == {"a": 1, "b": 1, "c": 0, "d": 0}


def test_quotas_of_huge_classes_do_not_overflow(spark):
    big = 3 * 10**15
    classes = spark.createDataFrame([("a", big), ("b", big * 2), ("c", 1)], "label string, n bigint")
    rows = {r["label"]: r for r in split.split_quotas(classes).collect()}
    assert sum(r["train_n"] + r["val_n"] + r["test_n"] for r in rows.values()) == 3 * big + 1
    assert abs(rows["a"]["test_n"] - big // 10) <= 1


def test_balanced_split(spark):
    df = split.stratified_split(balanced(spark))
    assert {s: r for s, r in df.groupBy("split").count().collect()} == {"train": 480, "val": 60, "test": 60}
    assert set(counts(df).values()) == {80, 10}


@pytest.mark.parametrize("sizes", [{"a": 37, "b": 3, "c": 1}, {"a": 203, "b": 9}, {"a": 1}, {"a": 12}])
@pytest.mark.parametrize("digits", [1, 4])
def test_every_row_goes_where_its_rank_says(spark, monkeypatch, sizes, digits):
    monkeypatch.setattr(split, "BUCKET_DIGITS", digits)
    labels = [label for label, n in sizes.items() for _ in range(n)]
    rows = list(enumerate(labels))
    df = spark.createDataFrame([(i, f"t{i}", label) for i, label in rows], "doc_id bigint, text string, label string")
    found = assignment(split.stratified_split(df, train_ratio=0.6, val_ratio=0.15, test_ratio=0.25, seed=7))
    assert found == expected_assignment(rows, 0.25, 0.15, 7)


def test_rows_without_label_form_a_class(spark):
    df = spark.createDataFrame([(i, f"t{i}", None if i % 2 else "a") for i in range(40)], "doc_id bigint, text string, label string")
    assert counts(split.stratified_split(df)) == {
        (None, "train"): 16, (None, "val"): 2, (None, "test"): 2, ("a", "train"): 16, ("a", "val"): 2, ("a", "test"): 2,
    }


def test_copies_of_one_text_are_spread(spark):
    """A text that fills the table must not pile up in one bucket of the histogram."""
    df = spark.createDataFrame([(i, "same", "a") for i in range(500)], "doc_id bigint, text string, label string")
    assert counts(split.stratified_split(df)) == {("a", "train"): 400, ("a", "val"): 50, ("a", "test"): 50}


def test_empty_table(spark, labelled):
    assert split.stratified_split(labelled([])).count() == 0


@pytest.mark.parametrize("ratios, message", [((0.7, 0.1, 0.1), "sum"), ((0.9, 0.1, 0.0), "positive")])
def test_ratios(spark, ratios, message):
    with pytest.raises(ValueError, match=message):
        split.stratified_split(balanced(spark, 5), Roles(), *ratios)
    split.check_ratios(0.8, 0.1, 0.1 + 1e-9)


def test_seed_decides(spark):
    df = balanced(spark)
    first, again, other = (assignment(split.stratified_split(df, seed=s)) for s in (42, 42, 99))
    assert first == again != other


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_partitioning_does_not_matter(spark, partitions):
    df = balanced(spark, 30)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = assignment(split.stratified_split(df.repartition(partitions)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found == assignment(split.stratified_split(df.coalesce(1)))


def test_beyond_the_pin_bound_nothing_is_broadcast_and_the_split_is_the_same(spark, monkeypatch):
    df = balanced(spark, 20)
    expected = assignment(split.stratified_split(df))
    small = lambda frame: pinning.pin(frame, max_rows=2)
    monkeypatch.setattr(split, "pin", small)
    assert assignment(split.stratified_split(df)) == expected


def test_composite_order(spark):
    df = spark.createDataFrame([(i // 5, i % 5, f"t{i}", "a") for i in range(50)], "c int, t int, text string, label string")
    parts = split.stratified_split(df, Roles(order=("c", "t")))
    assert counts(parts) == {("a", "train"): 40, ("a", "val"): 5, ("a", "test"): 5}


def tagged(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, text string, label string, split string")


LEAKY = [
    ("t1", "a", "train"), ("t2", "a", "train"), ("t1", "a", "val"), ("v", "b", "val"),
    ("t2", "a", "test"), ("v", "b", "test"), ("w", "b", "test"), (None, "a", "train"), (None, "a", "test"),
]


def test_leakage(spark):
    row = split.leakage_audit(tagged(spark, LEAKY)).first().asDict()
    assert row == {"train_val_overlap": 1, "train_test_overlap": 1, "val_test_overlap": 1, "is_leakage_free": False}
    clean = split.leakage_audit(split.stratified_split(balanced(spark, 10))).first()
    assert clean["is_leakage_free"] is True


def test_cross_split_dedup(spark):
    df = split.cross_split_dedup(tagged(spark, LEAKY))
    assert sorted(r["doc_id"] for r in df.collect()) == [2, 4, 5, 6, 7, 8]
    assert split.leakage_audit(df).first()["is_leakage_free"]


def test_stats_and_matrix(spark):
    df = tagged(spark, LEAKY)
    rows = {(r["split"], r["label"]): (r["n"], r["total_rows"], r["num_classes"], r["pct"]) for r in split.split_stats(df).collect()}
    assert rows["train", "a"] == (3, 3, 1, 100.0) and rows["test", "b"] == (2, 4, 2, 50.0)
    matrix = {r["label"]: r.asDict() for r in split.class_split_matrix(df).collect()}
    assert matrix["a"]["total"] == 6 and matrix["b"]["train_n"] == 0 and matrix["a"]["val_pct"] == 50.0


def test_differences(spark):
    df = tagged(spark, LEAKY)
    same = split.split_differences(df, df.repartition(3)).first()
    assert tuple(same) == (9, 0, True)
    moved = df.withColumn("split", F.when(F.col("doc_id") < 2, "val").otherwise(F.col("split")))
    assert tuple(split.split_differences(df, moved).first()) == (7, 2, False)
    fewer = df.where("doc_id > 0")
    assert split.split_differences(df, fewer).first()["is_reproducible"] is False
    assert split.split_differences(fewer, df).first()["is_reproducible"] is False
    assert split.split_reproducible(balanced(spark, 10), seed=3).first()["is_reproducible"]


def test_report(spark):
    df = tagged(spark, LEAKY)
    found = {(r["section"], r["item"]): r["value"] for r in split.split_report(df, rerun=df).collect()}
    assert found["rows", "test"] == 4 and found["row_percentages", "train"] == 33.33
    assert found["leakage", "train_val_overlap"] == 1 and found["reproducibility", "verified"] == 1
    assert found["class_counts_val", "b"] == 1 and found["class_percentages_test", "a"] == 50.0


def test_clean_then_split_keeps_every_row_once(spark, labelled):
    df = labelled([(f"t{i % 50}", "ab"[i % 2]) for i in range(120)])
    clean = policy_d(df)
    parts = split.stratified_split(clean)
    assert sorted(assignment(parts)) == sorted(r["doc_id"] for r in clean.collect())
    assert parts.columns == [*clean.columns, "split"]
