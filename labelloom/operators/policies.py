"""Cleaning policies for duplicate texts and contradictory labels, and their reports.

Policies that keep whole groups (A, C), and majority resolution, look a verdict
up per text, and only texts that need one have it: rows of all others stay where
they are read. Policies that keep one row per text (B, D) work out *which* row on
narrow aggregates and then fetch exactly these rows by their order value. The
reports never touch rows at all: every number follows from the per-text
aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.numbers import long_form, over_all, percent
from labelloom.operators.groups import (
    NULL_KEY,
    attach_rare,
    is_conflicting,
    keep_rows,
    label_counts,
    labelled_groups,
    text_groups,
    whole_key,
)
from labelloom.operators.validate import require_columns
from labelloom.roles import Roles

# The policies, in report order, and the metrics compared.
POLICIES = ("baseline", "A", "B", "C", "D")
METRICS = (
    "total_rows",
    "rows_removed",
    "pct_retained",
    "unique_texts",
    "duplicate_texts_remaining",
    "conflicting_texts_remaining",
)


def _checked(df: DataFrame, roles: Roles) -> DataFrame:
    require_columns(df, roles.text, roles.label, *roles.order_columns)
    return df


def policy_a(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Drop every row of a text that carries more than one label; null texts stay."""
    conflicts = text_groups(_checked(df, roles), roles).where(is_conflicting())
    verdicts = conflicts.select("text_key", "n_rows", F.lit(True).alias("_conflicting"))
    flagged = attach_rare(df, roles, verdicts, "_conflicting")
    return flagged.where(F.col("_conflicting").isNull()).drop("_conflicting")


def chosen_rows(df: DataFrame, policy: str, roles: Roles = Roles()) -> DataFrame:
    """Order values (``first_order``) of the rows that B, D or ``majority`` keeps, one per text.

    Eight bytes or so per text: worth settling when several jobs need the cleaned rows.
    """
    _checked(df, roles)
    if policy == "B":
        rows = text_groups(df, roles)
    elif policy == "D":
        rows = text_groups(df, roles).where(~is_conflicting())
    elif policy == "majority":
        # Only rows with a label vote, and only a label can win.
        labelled = labelled_groups(df.where(F.col(roles.label).isNotNull()), roles)
        rows = labelled.where(F.col("n") * 2 > F.col("n_rows"))
    else:
        raise ValueError(f"policy {policy!r} does not keep one row per text")
    return rows.select("first_order")


def policy_b(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Keep the first row of each text, whatever its label."""
    return keep_rows(df, roles, chosen_rows(df, "B", roles))


def policy_c(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Keep consistent duplicates and drop conflicting texts: the same rows as A."""
    return policy_a(df, roles)


def policy_d(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Drop conflicting texts, then keep the first row of each remaining text."""
    return keep_rows(df, roles, chosen_rows(df, "D", roles))


def majority_resolved(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row per text: the first row that carries the strict-majority label.

    Only rows with a label vote. Texts without a strict majority, or without any
    label, are dropped; consistent texts always have one.
    """
    whole_text = Window.partitionBy("text_key")
    votes = F.when(F.col("label").isNotNull(), F.col("n")).otherwise(0)
    counted = label_counts(_checked(df, roles), roles).withColumn("votes", F.sum(votes).over(whole_text))
    wins = F.col("label").isNotNull() & (F.col("n") * 2 > F.col("votes"))
    per_text = counted.groupBy("text_key").agg(
        F.sum("n").alias("n_rows"), F.max(F.when(wins, F.col("first_order"))).alias("winner")
    )
    # A text of one row with a label needs no verdict; of the others one row stays, or none.
    open_texts = per_text.where((F.col("n_rows") > 1) | F.col("winner").isNull())
    verdicts = open_texts.select(
        F.coalesce("text_key", F.lit(NULL_KEY)).alias("text_key"), "n_rows", F.struct("winner").alias("_verdict")
    )
    judged = attach_rare(df, roles, verdicts, "_verdict", whole_key(F.col(roles.text)))
    stays = F.col("_verdict").isNull() | (F.col("_verdict.winner") == roles.order_value())
    return judged.where(stays).drop("_verdict")


POLICY_FUNCTIONS = {"A": policy_a, "B": policy_b, "C": policy_c, "D": policy_d}


def apply_policy(df: DataFrame, policy: str, roles: Roles = Roles()) -> DataFrame:
    if policy not in POLICY_FUNCTIONS:
        raise ValueError(f"unknown policy {policy!r}; choose one of {sorted(POLICY_FUNCTIONS)}")
    return POLICY_FUNCTIONS[policy](df, roles)


def _kept(rows: Column, first: Column) -> dict[str, Column]:
    """Rows each policy keeps of a group with ``rows`` rows, ``first`` of them first of their text."""
    spared = ~is_conflicting()
    nothing = F.lit(0).cast("bigint")
    return {
        "baseline": rows,
        "A": F.when(spared, rows).otherwise(nothing),
        "B": first,
        "C": F.when(spared, rows).otherwise(nothing),
        "D": F.when(spared, first).otherwise(nothing),
    }


def policy_summary(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row per policy with the metrics in ``METRICS``.

    ``duplicate_texts_remaining`` counts distinct texts still repeated, not rows.
    """
    one = F.lit(1).cast("bigint")
    kept = _kept(F.col("n_rows"), one)
    labels_left = {p: F.col("n_labels") if p == "baseline" else F.least(F.col("n_labels"), one) for p in POLICIES}
    per_policy = text_groups(df, roles).select(
        "text_key",
        "n_rows",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(p).alias("policy"),
                        kept[p].alias("kept"),
                        F.when(kept[p] > 0, labels_left[p]).alias("labels_left"),
                    )
                    for p in POLICIES
                ]
            )
        ),
    )
    real = F.col("text_key").isNotNull()
    totals = per_policy.groupBy("policy").agg(
        F.sum("kept").alias("total_rows"),
        F.sum("n_rows").alias("original"),
        F.count_if(real & (F.col("kept") > 0)).alias("unique_texts"),
        F.count_if(real & (F.col("kept") > 1)).alias("duplicate_texts_remaining"),
        F.count_if(real & (F.col("labels_left") > 1)).alias("conflicting_texts_remaining"),
    )
    return totals.select(
        "policy",
        "total_rows",
        (F.col("original") - F.col("total_rows")).alias("rows_removed"),
        percent(F.col("total_rows"), F.col("original")).alias("pct_retained"),
        "unique_texts",
        "duplicate_texts_remaining",
        "conflicting_texts_remaining",
    )


def policy_comparison(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Metric by policy, baseline included."""
    rows = long_form(policy_summary(df, roles), ["policy"], list(METRICS), "metric", "value")
    return rows.groupBy("metric").pivot("policy", list(POLICIES)).agg(F.first("value"))


def policy_class_matrix(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Rows and percentage per class under every policy, and a last row for the whole table.

    Percentages divide by all rows the policy keeps. The total is the row with
    ``is_total``; its label is ``TOTAL``, also where a class has that name.
    """
    first = (F.col("first_order") == F.col("text_first_order")).cast("bigint")
    kept = _kept(F.col("n"), first)
    # At most one row per class and one for the total from here on.
    counts = (
        labelled_groups(df, roles)
        .rollup("label")
        .agg(F.grouping("label").cast("int").alias("is_total"), *[F.sum(kept[p]).alias(f"rows_{p}") for p in POLICIES])
    )
    whole = [F.max(F.when(F.col("is_total") == 1, F.col(f"rows_{p}"))).over(Window.partitionBy()) for p in POLICIES]
    shares = [percent(F.col(f"rows_{p}"), total).alias(f"pct_{p}") for p, total in zip(POLICIES, whole, strict=True)]
    label = F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("label").cast("string")).alias("label")
    sized = counts.select(label, (F.col("is_total") == 1).alias("is_total"), *[f"rows_{p}" for p in POLICIES], *shares)
    return sized.where(F.col("label").isNotNull() & F.col("rows_baseline").isNotNull())


def distribution_delta(before: DataFrame, after: DataFrame, digits: int = 2) -> DataFrame:
    """Two class distributions side by side: counts, shares, change in rows and percent.

    Both inputs are ``label, n, pct`` as :func:`profile.class_distribution` gives them.
    """
    b = before.select("label", F.col("n").alias("before_n"), F.round("pct", digits).alias("before_pct"))
    a = after.select("label", F.col("n").alias("after_n"), F.round("pct", digits).alias("after_pct"))
    change = F.col("after_n") - F.col("before_n")
    ratio = F.try_divide(change.cast("double"), F.col("before_n").cast("double")) * 100
    return b.join(a, "label", "full_outer").select(
        "*", change.alias("delta_rows"), F.round(ratio, digits).alias("change_pct")
    )


def cleaning_report(df: DataFrame, roles: Roles = Roles(), cleaned: DataFrame | None = None) -> DataFrame:
    """What policy D does to a table, as ``section, item, value`` rows.

    Everything named ``final_`` is measured on ``cleaned``, the table that came
    out; without it policy D is applied here.

    Section ``summary`` holds the scalars; ``class_counts`` and
    ``class_percentages`` cover every label of the *original* table. Two
    narrow aggregates feed it: per text for the scalars, per (text, label) for
    the classes.
    """
    real = F.col("text_key").isNotNull()
    conflict = is_conflicting()
    n = F.col("n_rows")
    cleaned = policy_d(df, roles) if cleaned is None else cleaned
    before = text_groups(df, roles).withColumn("after", F.lit(False))
    both = before.unionByName(text_groups(cleaned, roles).withColumn("after", F.lit(True)))

    def counted(condition: Column, weight: Column | int = 1) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight).otherwise(0)), F.lit(0))

    was, now = ~F.col("after"), F.col("after")
    totals = both.agg(
        counted(was, n).alias("original_row_count"),
        counted(was & conflict).alias("conflicting_text_count"),
        counted(was & conflict, n).alias("conflicting_rows_removed"),
        counted(was & real & ~conflict & (n > 1)).alias("consistent_duplicate_groups"),
        counted(was & ~conflict, n - 1).alias("redundant_duplicate_rows_removed"),
        counted(now, n).alias("final_row_count"),
        counted(now & real).alias("final_unique_text_count"),
        counted(now, n - 1).alias("final_duplicate_text_count"),
        counted(now & conflict).alias("final_conflicting_text_count"),
    )
    removed = F.col("original_row_count") - F.col("final_row_count")
    # The names of the metrics.
    scalars = {
        "original_row_count": F.col("original_row_count"),
        "conflicting_text_count": F.col("conflicting_text_count"),
        "conflicting_unique_texts": F.col("conflicting_text_count"),
        "conflicting_rows_removed": F.col("conflicting_rows_removed"),
        "consistent_duplicate_groups": F.col("consistent_duplicate_groups"),
        "redundant_duplicate_rows_removed": F.col("redundant_duplicate_rows_removed"),
        "total_rows_removed": removed,
        "final_row_count": F.col("final_row_count"),
        "final_unique_text_count": F.col("final_unique_text_count"),
        "final_duplicate_text_count": F.col("final_duplicate_text_count"),
        "final_conflicting_text_count": F.col("final_conflicting_text_count"),
        "pct_retained": percent(F.col("final_row_count"), F.col("original_row_count")),
    }
    summary = totals.select(
        F.lit("summary").alias("section"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("item"),
                        F.coalesce(v.cast("double"), F.lit(0.0)).alias("value"),
                    )
                    for k, v in scalars.items()
                ]
            )
        ),
    )
    classes = policy_class_matrix(df, roles).where("not is_total").select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("class_counts").alias("section"),
                    F.col("label").cast("string").alias("item"),
                    F.col("rows_D").cast("double").alias("value"),
                ),
                F.struct(
                    F.lit("class_percentages").alias("section"),
                    F.col("label").cast("string").alias("item"),
                    F.col("pct_D").alias("value"),
                ),
            )
        )
    )
    return summary.unionByName(classes)


def policy_impact_report(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Conflicts, consistent duplicates, majority vote and every policy as ``section, item, value`` rows.

    One scan and one table of sums per class feed everything: numbers about
    whole texts are added up under the label of the text's first row.
    """
    whole_text = Window.partitionBy("text_key")
    labels = labelled_groups(df, roles).select(
        "*",
        F.max(F.when(F.col("label").isNotNull(), F.col("n"))).over(whole_text).alias("most"),
        F.sum(F.when(F.col("label").isNotNull(), F.col("n"))).over(whole_text).alias("votes"),
    )
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    first = F.col("first_order") == F.col("text_first_order")
    real, conflict = F.col("text_key").isNotNull(), is_conflicting()
    consistent = real & (F.col("n_rows") > 1) & ~conflict
    won = F.col("most") * 2 > F.col("votes")

    def counted(condition: Column, weight: Column = one) -> Column:
        return F.sum(F.when(condition, weight).otherwise(zero))

    per_class = {
        "conflict_rows": counted(conflict, F.col("n")),
        "conflict_texts": counted(conflict),
        "consistent_all_copies": counted(consistent, F.col("n")),
        "consistent_redundant_copies": counted(consistent, F.col("n") - first.cast("bigint")),
    }
    kept_here = _kept(F.col("n"), first.cast("bigint"))
    per_class.update({f"policy_{p}_class_counts": F.sum(kept_here[p]) for p in POLICIES})
    per_table = {
        ("conflicts", "texts"): counted(first & conflict),
        ("conflicts", "rows"): counted(first & conflict, F.col("n_rows")),
        ("majority", "with_majority"): counted(first & conflict & won),
        ("majority", "tied"): counted(first & conflict & ~won),
    }
    kept_text = _kept(F.col("n_rows"), one)
    for p in POLICIES:
        left = F.col("n_labels") if p == "baseline" else F.least(F.col("n_labels"), one)
        kept = kept_text[p]
        per_table[f"policy_{p}", "total_rows"] = counted(first, kept)
        per_table[f"policy_{p}", "unique_texts"] = counted(first & real & (kept > 0))
        per_table[f"policy_{p}", "duplicate_texts_remaining"] = counted(first & real & (kept > 1))
        per_table[f"policy_{p}", "conflicting_texts_remaining"] = counted(first & real & (kept > 0) & (left > 1))

    sums = labels.groupBy("label").agg(
        *[c.alias(name) for name, c in per_class.items()],
        *[c.alias(f"{section}.{item}") for (section, item), c in per_table.items()],
    )
    cells = [
        F.struct(F.lit(name).alias("section"), F.col("label").cast("string").alias("item"), F.col(name).alias("n"))
        for name in per_class
    ] + [
        F.struct(F.lit(section).alias("section"), F.lit(i).alias("item"), F.col(f"`{section}.{i}`").alias("n"))
        for section, i in per_table
    ]
    totals = sums.select(F.inline(F.array(*cells))).groupBy("section", "item").agg(F.sum("n").alias("n"))
    is_original = (F.col("section") == "policy_baseline") & (F.col("item") == "total_rows")
    sized = totals.select(
        "*",
        F.sum("n").over(Window.partitionBy("section")).alias("in_section"),
        over_all(F.max(F.when(is_original, F.col("n")))).alias("original"),
    )

    def line(section: Column | str, item: Column | str, value: Column) -> Column:
        section = F.lit(section) if isinstance(section, str) else section
        item = F.lit(item) if isinstance(item, str) else item
        return F.struct(section.alias("section"), item.alias("item"), value.cast("double").alias("value"))

    n, section = F.col("n"), F.col("section")
    plain = line(section, F.col("item"), n)
    shares = line(F.replace(section, F.lit("counts"), F.lit("percentages")), F.col("item"), percent(n, F.col("in_section")))
    lines = (
        F.when(section.endswith("_class_counts"), F.array(plain, shares))
        .when(
            section.startswith("policy_") & (F.col("item") == "total_rows"),
            F.array(
                plain,
                line(section, "rows_removed", F.col("original") - n),
                line(section, "pct_retained", percent(n, F.col("original"))),
            ),
        )
        .when(
            F.col("item") == "with_majority",
            F.array(plain, line("majority", "applicable", (n > 0).cast("double"))),
        )
        .otherwise(F.array(plain))
    )
    # Rows without a label count in every total but are no class of their own.
    return sized.select(F.inline(lines)).where(F.col("item").isNotNull())
