"""Exact-quota stratified train/val/test split, and audits of it.

How rows are assigned: every row has a rank value, ``md5(seed | order)``, that
depends on nothing but the seed and its order value. Within a class the
smallest ranks go to test, the next to val, the rest to train, as many as the
class quotas say.

Nothing is sorted or numbered class-wide for that. A histogram of rank
prefixes locates the two buckets per class in which the quotas run out; only
rows of those buckets are ranked, which yields two cut-off values per class;
and every row is then assigned by comparing its own rank with the cut-offs of
its class. Both preparatory passes read only label and order, the final pass
has no shuffle, and a class may be any share of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.numbers import over_all, percent
from labelloom.functions.text import text_key
from labelloom.operators.groups import attach_rare
from labelloom.operators.pin import pin
from labelloom.operators.validate import require_columns
from labelloom.roles import Roles

# Split names, in report order.
SPLITS = ("train", "val", "test")
PAIRS = (("train", "val"), ("train", "test"), ("val", "test"))
# Fixed value: how far the ratios may add up from one.
RATIO_TOLERANCE = 1e-8 + 1e-5

#: Hexadecimal digits of the rank that form a histogram bucket. Four digits
#: make 65,536 buckets per class, so 10 billion rows of one class leave about
#: 150,000 narrow rows to be ranked in one task.
BUCKET_DIGITS = 4


def check_ratios(train: float, val: float, test: float) -> None:
    """Ratios must add up to one, and each must be positive."""
    total = train + val + test
    if abs(total - 1.0) > RATIO_TOLERANCE:
        raise ValueError(f"split ratios must sum to 1.0, got {train} + {val} + {test} = {total}")
    if min(train, val, test) <= 0:
        raise ValueError("split ratios must all be positive")


def _with_share(classes: DataFrame, count: str, seats: str, out: str) -> DataFrame:
    """Largest-remainder shares of ``seats`` in proportion to ``count``, one row per class.

    Equal remainders go by label. Integer arithmetic throughout, wide enough
    for any class count.
    """
    return (
        classes.selectExpr(
            "*",
            f"cast({count} as decimal(20,0)) * cast({seats} as decimal(18,0)) as _exact",
            f"nullif(cast(sum({count}) over () as decimal(20,0)), 0) as _whole",
        )
        .selectExpr("*", "coalesce(_exact div _whole, 0) as _floor", "_exact % _whole as _rest")
        .selectExpr(
            *classes.columns,
            f"_floor + if(row_number() over (order by _rest desc, label) <= {seats} - sum(_floor) over (), 1, 0) as {out}",
        )
    )


def split_quotas(
    class_counts: DataFrame, train_ratio: float = 0.8, val_ratio: float = 0.1, test_ratio: float = 0.1
) -> DataFrame:
    """``label, n, train_n, val_n, test_n`` from ``label, n`` with one row per class.

    Test and val sizes are shares of the whole table, rounded half to even;
    test quotas come first, val quotas from what is left, train is the rest.
    """
    check_ratios(train_ratio, val_ratio, test_ratio)
    total = over_all(F.sum("n")).cast("double")
    sized = class_counts.select(
        "label",
        "n",
        F.bround(total * F.lit(float(test_ratio)), 0).cast("bigint").alias("test_size"),
        F.bround(total * F.lit(float(val_ratio)), 0).cast("bigint").alias("val_size"),
    )
    tested = _with_share(sized, "n", "test_size", "test_n").withColumn("left_n", F.col("n") - F.col("test_n"))
    both = _with_share(tested, "left_n", "val_size", "val_n")
    return both.select(
        "label", "n", (F.col("left_n") - F.col("val_n")).alias("train_n"), "val_n", "test_n"
    )


def _rank(roles: Roles, seed: int) -> Column:
    order = [F.col(c).cast("string") for c in roles.order_columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *order))


def split_cutoffs(
    df: DataFrame,
    roles: Roles = Roles(),
    train_ratio: float = 0.8,
    val_ratio: float = 0.1,
    test_ratio: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Per class the last (rank, order) that goes to test, and the last that goes to val.

    A cut-off is null where the class has no row to give.
    """
    require_columns(df, roles.label, *roles.order_columns)
    ranked = df.select(
        F.col(roles.label).alias("label"),
        _rank(roles, seed).alias("rank"),
        roles.order_value().alias("row_order"),
    ).withColumn("bucket", F.substring("rank", 1, BUCKET_DIGITS))

    histogram = ranked.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n"))
    one_class = Window.partitionBy("label")
    so_far = one_class.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    running = histogram.select(
        "label", "bucket", "n", F.sum("n").over(so_far).alias("upto"), F.sum("n").over(one_class).alias("class_n")
    )
    # The last bucket of a class carries its size: one row per class.
    sizes = running.where(F.col("upto") == F.col("class_n")).select("label", F.col("class_n").alias("n"))
    quotas = split_quotas(sizes, train_ratio, val_ratio, test_ratio).selectExpr(
        "label as q_label", "test_n as test_upto", "test_n + val_n as val_upto"
    )
    before = F.col("upto") - F.col("n")

    def place(target: str) -> Column:
        inside = (before < F.col(target)) & (F.col(target) <= F.col("upto"))
        return F.when(inside, F.col(target) - before)

    edges = pin(
        running.join(quotas, F.col("label").eqNullSafe(F.col("q_label")))
        .select(
            F.col("label").alias("e_label"),
            F.col("bucket").alias("e_bucket"),
            place("test_upto").alias("test_place"),
            place("val_upto").alias("val_place"),
        )
        .where(F.col("test_place").isNotNull() | F.col("val_place").isNotNull())
    )
    # Only rows of the edge buckets are numbered, a 16**-BUCKET_DIGITS share of their class each.
    inside = ranked.join(
        edges, F.col("label").eqNullSafe(F.col("e_label")) & (F.col("bucket") == F.col("e_bucket"))
    )
    numbered = inside.withColumn(
        "place", F.row_number().over(Window.partitionBy("label", "bucket").orderBy("rank", "row_order"))
    )
    cut = F.struct("rank", "row_order")
    return pin(
        numbered.groupBy(F.col("label").alias("c_label")).agg(
            F.max(F.when(F.col("place") == F.col("test_place"), cut)).alias("test_cut"),
            F.max(F.when(F.col("place") == F.col("val_place"), cut)).alias("val_cut"),
        )
    )


def stratified_split(
    df: DataFrame,
    roles: Roles = Roles(),
    train_ratio: float = 0.8,
    val_ratio: float = 0.1,
    test_ratio: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """``df`` with a ``split`` column. Same seed and data give the same split, however partitioned.

    Computing the cut-offs runs two narrow jobs when this is called.
    """
    check_ratios(train_ratio, val_ratio, test_ratio)
    cutoffs = split_cutoffs(df, roles, train_ratio, val_ratio, test_ratio, seed)
    position = F.struct(_rank(roles, seed).alias("rank"), roles.order_value().alias("row_order"))
    split = (
        F.when(position <= F.col("test_cut"), F.lit("test"))
        .when(position <= F.col("val_cut"), F.lit("val"))
        .otherwise(F.lit("train"))
    )
    joined = df.join(cutoffs, F.col(roles.label).eqNullSafe(F.col("c_label")), "left")
    return joined.select(*[df[c] for c in df.columns], split.alias("split"))


def leakage_audit(df: DataFrame, roles: Roles = Roles(), split: str = "split") -> DataFrame:
    """One row: distinct texts shared by each pair of splits, and whether there are none."""
    require_columns(df, roles.text, split)
    per_text = (
        df.groupBy(text_key(F.col(roles.text)).alias("text_key"))
        .agg(*[F.max((F.col(split) == s).cast("int")).alias(s) for s in SPLITS])
        .where(F.col("text_key").isNotNull())
    )
    shared = {f"{a}_{b}_overlap": F.count_if((F.col(a) == 1) & (F.col(b) == 1)) for a, b in PAIRS}
    counts = per_text.agg(*[c.alias(name) for name, c in shared.items()])
    total = sum((F.col(name) for name in shared), F.lit(0))
    return counts.select("*", (total == 0).alias("is_leakage_free"))


def split_stats(df: DataFrame, label: str = "label", split: str = "split", digits: int = 4) -> DataFrame:
    """Per split and class: count and percentage, with rows and classes of the whole split."""
    require_columns(df, label, split)
    counts = (
        df.where(F.col(label).isNotNull())
        .groupBy(F.col(split).alias("split"), F.col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    one_split = Window.partitionBy("split")
    return counts.select(
        "*",
        F.sum("n").over(one_split).alias("total_rows"),
        F.count(F.lit(1)).over(one_split).alias("num_classes"),
    ).withColumn("pct", percent(F.col("n"), F.col("total_rows"), digits))


def class_split_matrix(df: DataFrame, label: str = "label", split: str = "split", digits: int = 2) -> DataFrame:
    """Class by split: total, counts, and share of each split."""
    require_columns(df, label, split)
    counts = (
        df.where(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("label"))
        .agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(F.col(split) == s).alias(f"{s}_n") for s in SPLITS],
        )
    )
    return counts.select(
        "*", *[percent(F.col(f"{s}_n"), over_all(F.sum(f"{s}_n")), digits).alias(f"{s}_pct") for s in SPLITS]
    )


def split_differences(first: DataFrame, second: DataFrame, roles: Roles = Roles(), split: str = "split") -> DataFrame:
    """One row: rows assigned alike, rows assigned differently, and whether all agree.

    Both frames are reduced to (order, split) and counted against each other.
    """
    sides = [
        f.select(roles.order_value().alias("row_order"), F.col(split).alias("split"), F.lit(sign).alias("side"))
        for f, sign in ((first, 1), (second, -1))
    ]
    pairs = (
        sides[0]
        .unionByName(sides[1])
        .groupBy("row_order", "split")
        .agg(F.sum("side").alias("balance"), F.count_if(F.col("side") == 1).alias("in_first"))
    )
    differing = F.coalesce(F.sum(F.greatest("balance", F.lit(0))), F.lit(0))
    return pairs.agg(
        F.coalesce(F.sum(F.col("in_first") - F.greatest("balance", F.lit(0))), F.lit(0)).alias("rows_alike"),
        differing.alias("rows_differing"),
        F.coalesce(F.max(F.abs("balance")) == 0, F.lit(True)).alias("is_reproducible"),
    )


def split_reproducible(df: DataFrame, roles: Roles = Roles(), **settings) -> DataFrame:
    """Run the split twice from the start and compare the assignments."""
    return split_differences(
        stratified_split(df, roles, **settings), stratified_split(df, roles, **settings), roles
    )


def split_report(
    df: DataFrame, roles: Roles = Roles(), rerun: DataFrame | None = None, source: DataFrame | None = None
) -> DataFrame:
    """Report on an assigned table as ``section, item, value`` rows.

    ``totals`` holds the rows of all splits and, if the ``source`` of the split
    is given, the rows of that.

    Sizes and class counts need the labels only; the leakage audit is the one
    pass over texts. ``rerun``, a second assignment of the same table, adds
    the reproducibility flag.
    """
    require_columns(df, roles.text, roles.label, "split")

    def line(section: Column | str, item: Column | str, value: Column) -> Column:
        section = F.lit(section) if isinstance(section, str) else section
        item = F.lit(item) if isinstance(item, str) else item
        return F.struct(section.alias("section"), item.alias("item"), value.cast("double").alias("value"))

    counts = df.groupBy("split", F.col(roles.label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    one_split = Window.partitionBy("split")
    sized = counts.select(
        "*",
        F.sum("n").over(one_split).alias("in_split"),
        F.row_number().over(one_split.orderBy("label")).alias("place"),
        over_all(F.sum("n")).alias("all_rows"),
    )
    split, label = F.col("split"), F.coalesce("label", F.lit("null"))
    per_class = F.array(
        line(F.concat(F.lit("class_counts_"), split), label, F.col("n")),
        line(F.concat(F.lit("class_percentages_"), split), label, percent(F.col("n"), F.col("in_split"))),
    )
    per_split = F.array(
        line("rows", split, F.col("in_split")),
        line("row_percentages", split, percent(F.col("in_split"), F.col("all_rows"), 2)),
    )
    sizes = sized.select(F.inline(F.when(F.col("place") == 1, F.concat(per_class, per_split)).otherwise(per_class)))

    names = [f"{a}_{b}_overlap" for a, b in PAIRS]
    leakage = leakage_audit(df, roles).select(
        F.inline(
            F.array(
                *[line("leakage", name, F.col(name)) for name in names],
                line("leakage", "is_leakage_free", F.col("is_leakage_free")),
            )
        )
    )
    totals = df.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(line("totals", "rows_in_splits", F.col("n")))))
    if source is not None:
        rows = source.agg(F.count(F.lit(1)).alias("n"))
        totals = totals.unionByName(rows.select(F.inline(F.array(line("totals", "source_rows", F.col("n"))))))
    report = sizes.unionByName(leakage).unionByName(totals)
    if rerun is None:
        return report
    check = split_differences(df, rerun, roles).select(
        F.inline(
            F.array(
                line("reproducibility", "rows_differing", F.col("rows_differing")),
                line("reproducibility", "verified", F.col("is_reproducible")),
            )
        )
    )
    return report.unionByName(check)


def cross_split_dedup(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Remove from train what also occurs in val or test, and from val what also occurs in test.

    For tables that were split before their duplicates were removed.
    """
    require_columns(df, roles.text, "split")
    groups = (
        df.groupBy(text_key(F.col(roles.text)).alias("text_key"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.max((F.col("split") == s).cast("int")).alias(s) for s in SPLITS],
        )
        .where((F.col("train") + F.col("val") + F.col("test") > 1) & F.col("text_key").isNotNull())
        .select("text_key", "n_rows", F.when(F.col("test") == 1, "test").otherwise("val").alias("_home"))
    )
    placed = attach_rare(df, roles, groups, "_home")
    return placed.where(F.col("_home").isNull() | (F.col("_home") == F.col("split"))).drop("_home")
