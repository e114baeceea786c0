"""Duplicate texts and contradictory labels.

Every operator reads the aggregates of :mod:`labelloom.operators.groups`, so
each is one scan followed by shuffles of digests and counts. Each takes a table
or the counts kept of it, see :mod:`labelloom.operators.state`; texts themselves
and samples of other lengths need the table. Null texts belong to no group here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.numbers import over_all, percent
from labelloom.functions.text import shorten
from labelloom.operators import state
from labelloom.operators.groups import Counted, is_conflicting, label_counts, labelled_groups, text_groups
from labelloom.roles import Roles

# Fixed value: how the labels of a combination are joined.
SEPARATOR = " + "


def _texts(df: DataFrame | Counted, roles: Roles, **kwargs) -> DataFrame:
    return text_groups(df, roles, **kwargs).where(F.col("text_key").isNotNull())


def _same_width(df: DataFrame | Counted, width: int, kept: int) -> None:
    if not isinstance(df, DataFrame) and width != kept:
        raise ValueError(f"the state keeps {kept} characters, not {width}")


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0).cast("bigint"))


def _combination() -> Column:
    return F.array_join("labels", SEPARATOR)


def exact_duplicates(df: DataFrame | Counted, roles: Roles = Roles()) -> DataFrame:
    """One row about equal (text, label) pairs: all copies, copies beyond the first, pairs."""
    repeated = label_counts(df, roles).where(F.col("n") > 1)
    return repeated.agg(
        _total(F.col("n")).alias("all_copies"),
        _total(F.col("n") - 1).alias("non_first_copies"),
        F.count_if(F.col("text_key").isNotNull() & F.col("label").isNotNull()).alias(
            "unique_pairs_with_duplicates"
        ),
    )


def duplicate_samples(df: DataFrame | Counted, roles: Roles = Roles(), k: int = 4, width: int = 60) -> DataFrame:
    """The first ``k`` distinct (leading characters, label) pairs among exact duplicates."""
    _same_width(df, width, state.LEAD)
    lead = {"lead": F.substring(roles.text, 1, width), "sample": shorten(F.col(roles.text))}
    repeated = label_counts(df, roles, lead).where((F.col("n") > 1) & F.col("text_key").isNotNull())
    first = repeated.groupBy("lead", "label").agg(
        F.min(F.struct("first_order", "sample")).alias("first")
    )
    return first.select("lead", "label", "first.first_order", "first.sample").orderBy("first_order").limit(k)


def text_multiplicity(df: DataFrame | Counted, roles: Roles = Roles()) -> DataFrame:
    """One row: distinct texts, texts seen more than once, texts seen once."""
    return _texts(df, roles).agg(
        F.count(F.lit(1)).alias("unique_texts"),
        F.count_if(F.col("n_rows") > 1).alias("texts_repeated"),
        F.count_if(F.col("n_rows") == 1).alias("texts_once"),
    )


def multiplicity_histogram(df: DataFrame | Counted, roles: Roles = Roles()) -> DataFrame:
    """For repeated texts: how many texts are seen how often."""
    repeated = _texts(df, roles).where(F.col("n_rows") > 1)
    return repeated.groupBy(F.col("n_rows").alias("appearances")).agg(F.count(F.lit(1)).alias("texts"))


def text_label_profile(df: DataFrame | Counted, roles: Roles = Roles(), with_text: bool = False) -> DataFrame:
    """Per distinct text: its first row, sorted label set, number of labels and of rows.

    The text itself is represented by the order value of its first row;
    ``with_text`` fetches it by that value, which costs a shuffle of whole texts.
    """
    profile = _texts(df, roles, with_labels=True).select("first_order", "labels", "n_labels", "n_rows")
    if not with_text:
        return profile
    if not isinstance(df, DataFrame):
        raise ValueError("a state doesn't keep whole texts")
    texts = df.select(roles.order_value().alias("first_order"), F.col(roles.text).alias("text"))
    return profile.join(texts, "first_order")


def consistent_vs_conflicting(df: DataFrame | Counted, roles: Roles = Roles()) -> DataFrame:
    """One row: repeated texts with one label and with several, and the rows they cover."""
    repeated = F.col("n_rows") > 1
    consistent = repeated & (F.col("n_labels") == 1)
    conflicting = repeated & is_conflicting()
    zero = F.lit(0).cast("bigint")
    return _texts(df, roles).agg(
        F.count_if(repeated).alias("repeated_texts"),
        F.count_if(consistent).alias("consistent_texts"),
        _total(F.when(consistent, F.col("n_rows")).otherwise(zero)).alias("consistent_rows"),
        F.count_if(conflicting).alias("conflicting_texts"),
        _total(F.when(conflicting, F.col("n_rows")).otherwise(zero)).alias("conflicting_rows"),
        F.coalesce(F.max("n_labels"), zero).alias("max_labels_per_text"),
    )


def label_combinations(df: DataFrame | Counted, roles: Roles = Roles()) -> DataFrame:
    """Per label combination of conflicting texts: texts, rows, share of all conflicts.

    Ordered by texts, most first, then by name.
    """
    conflicting = _texts(df, roles, with_labels=True).where(is_conflicting())
    counts = conflicting.groupBy(_combination().alias("combination")).agg(
        F.count(F.lit(1)).alias("texts"), F.sum("n_rows").alias("n_rows")
    )
    # One number; combinations can be as many as subsets of the classes.
    total = conflicting.agg(F.count(F.lit(1)).alias("texts")).scalar()
    share = percent(F.col("texts"), total, 2)
    return counts.select("*", share.alias("pct_of_conflicts")).orderBy(F.desc("texts"), "combination")


def combination_examples(df: DataFrame | Counted, roles: Roles = Roles(), width: int = 120) -> DataFrame:
    """For each label combination the earliest conflicting text and its rows per label.

    The shortened text travels with the per-text group, so the table is not
    read again to fetch it.
    """
    _same_width(df, width, state.SAMPLE)
    sample = {"sample": shorten(F.col(roles.text), width)}
    per_text = (
        label_counts(df, roles, sample)
        .groupBy("text_key", "sample")
        .agg(
            F.count("label").alias("n_labels"),
            F.min("first_order").alias("first_order"),
            F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "n")))).alias("freq"),
        )
        .where(is_conflicting())
    )
    combined = per_text.withColumn("combination", F.array_join(F.col("freq.label"), SEPARATOR))
    first = combined.groupBy("combination").agg(
        F.min_by(F.struct("first_order", "sample", "freq"), "first_order").alias("e")
    )
    return first.select("combination", "e.first_order", "e.sample", F.inline("e.freq"))


def conflict_frequency(df: DataFrame | Counted, roles: Roles = Roles()) -> DataFrame:
    """One row: conflicting texts seen exactly twice, and three or more times."""
    return _texts(df, roles).where(is_conflicting()).agg(
        F.count_if(F.col("n_rows") == 2).alias("seen_twice"),
        F.count_if(F.col("n_rows") >= 3).alias("seen_three_or_more"),
    )


def conflict_impact_by_class(df: DataFrame | Counted, roles: Roles = Roles()) -> DataFrame:
    """Per class: rows and distinct texts that belong to conflicting texts; 0 where none."""
    conflict = is_conflicting()
    zero = F.lit(0).cast("bigint")
    return (
        labelled_groups(df, roles)
        .where(F.col("label").isNotNull())
        .groupBy("label")
        .agg(
            F.sum(F.when(conflict, F.col("n")).otherwise(zero)).alias("rows_in_conflicts"),
            F.count_if(conflict).alias("texts_in_conflicts"),
        )
    )


def majority_check(df: DataFrame | Counted, roles: Roles = Roles()) -> DataFrame:
    """One row: conflicting texts with a strict-majority label and without, and whether voting helps.

    The vote is among labelled rows: rows without a label do not take part.
    """
    votes = (
        label_counts(df, roles)
        .where(F.col("text_key").isNotNull() & F.col("label").isNotNull())
        .groupBy("text_key")
        .agg(F.count("label").alias("n_labels"), F.max("n").alias("most"), F.sum("n").alias("votes"))
        .where(is_conflicting())
    )
    won = F.col("most") * 2 > F.col("votes")
    return votes.agg(
        F.count_if(won).alias("with_majority"),
        F.count_if(~won).alias("tied"),
        (F.count_if(won) > 0).alias("majority_applicable"),
    )


def consistent_by_class(df: DataFrame | Counted, roles: Roles = Roles()) -> DataFrame:
    """Per class: rows of consistent repeated texts, and those beyond each first row."""
    consistent = F.col("text_key").isNotNull() & (F.col("n_rows") > 1) & (F.col("n_labels") <= 1)
    zero = F.lit(0).cast("bigint")
    first = (F.col("first_order") == F.col("text_first_order")).cast("bigint")
    return (
        labelled_groups(df, roles)
        .where(F.col("label").isNotNull())
        .groupBy("label")
        .agg(
            F.sum(F.when(consistent, F.col("n")).otherwise(zero)).alias("all_copies"),
            F.sum(F.when(consistent, F.col("n") - first).otherwise(zero)).alias("redundant_copies"),
        )
    )


def remaining_duplicates(df: DataFrame | Counted, roles: Roles = Roles()) -> DataFrame:
    """One row: distinct texts still repeated, and texts still conflicting."""
    return _texts(df, roles).agg(
        F.count_if(F.col("n_rows") > 1).alias("duplicate_texts"),
        F.count_if(is_conflicting()).alias("conflicting_texts"),
    )


def duplicate_report(df: DataFrame | Counted, roles: Roles = Roles()) -> DataFrame:
    """The whole duplicate analysis as ``section, item, value`` rows, from one scan.

    Texts are first counted by what the report distinguishes (how often they
    are seen, how many labels, which combination); the report is read off that
    small table.
    """
    per_text = (
        label_counts(df, roles)
        .groupBy("text_key")
        .agg(
            F.count("label").alias("n_labels"),
            F.sum("n").alias("n_rows"),
            F.array_sort(F.collect_list("label")).alias("labels"),
            F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("exact_all"),
            F.sum(F.col("n") - 1).alias("exact_extra"),
            F.count_if((F.col("n") > 1) & F.col("label").isNotNull()).alias("exact_pairs"),
        )
    )
    kinds = per_text.groupBy(
        F.col("text_key").isNotNull().alias("real"),
        "n_rows",
        "n_labels",
        F.when(is_conflicting(), F.array_join("labels", SEPARATOR)).alias("combination"),
    ).agg(F.count(F.lit(1)).alias("texts"), *[F.sum(c).alias(c) for c in ("exact_all", "exact_extra", "exact_pairs")])

    zero = F.lit(0).cast("bigint")
    real, texts = F.col("real"), F.col("texts")
    rows = texts * F.col("n_rows")
    repeated = real & (F.col("n_rows") > 1)
    consistent, conflicting = repeated & (F.col("n_labels") == 1), F.col("combination").isNotNull()

    def entry(section: str, item: Column | str, weight: Column, condition: Column | None = None) -> Column:
        item = F.lit(item) if isinstance(item, str) else item
        weight = weight if condition is None else F.when(condition, weight).otherwise(zero)
        return F.struct(F.lit(section).alias("section"), item.alias("item"), weight.alias("weight"))

    always = [
        entry("texts", "total_rows", rows),
        entry("texts", "unique_texts", texts, real),
        entry("texts", "texts_repeated", texts, repeated),
        entry("texts", "texts_once", texts, real & (F.col("n_rows") == 1)),
        entry("exact_duplicates", "all_copies", F.col("exact_all")),
        entry("exact_duplicates", "non_first_copies", F.col("exact_extra")),
        entry("exact_duplicates", "unique_pairs_with_duplicates", F.col("exact_pairs"), real),
        entry("repeated_texts", "consistent_texts", texts, consistent),
        entry("repeated_texts", "consistent_rows", rows, consistent),
        entry("repeated_texts", "conflicting_texts", texts, conflicting),
        entry("repeated_texts", "conflicting_rows", rows, conflicting),
        entry("max_labels", "max_labels_per_text", F.col("n_labels"), real),
    ]
    sometimes = F.filter(
        F.array(
            F.when(repeated, entry("multiplicity", F.col("n_rows").cast("string"), texts)),
            F.when(conflicting, entry("combination_texts", F.col("combination"), texts)),
            F.when(conflicting, entry("combination_rows", F.col("combination"), rows)),
        ),
        lambda e: e.isNotNull(),
    )
    entries = kinds.select(F.inline(F.concat(F.array(*always), sometimes)))
    totals = entries.groupBy("section", "item").agg(F.sum("weight").alias("added"), F.max("weight").alias("most"))
    is_max = F.col("section") == "max_labels"
    return totals.select(
        F.when(is_max, F.lit("repeated_texts")).otherwise(F.col("section")).alias("section"),
        "item",
        F.when(is_max, F.col("most")).otherwise(F.col("added")).cast("double").alias("value"),
    )
