"""The per-text aggregates every duplicate, conflict and policy operator stands on.

Shape of the work, chosen for tables far larger than memory:

* Texts are replaced by their digest before the first shuffle, so a shuffle
  row is some tens of bytes however long the text is.
* The first aggregate is per (text, label) and the second per text. Both have
  only fixed-width buffers, so Spark hash-aggregates them before shuffling: a
  text that fills a third of the table leaves each task as one row per label.
* Where rows must learn something about their text, :func:`attach_by_text`
  keeps very frequent texts out of the join's shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.functions.text import text_key
from labelloom.operators import bloom
from labelloom.operators.pin import MAX_PINNED_ROWS, settle
from labelloom.roles import Roles

#: A text with more rows than this, and with more than one in MAX_HOT_TEXTS of the
#: table's rows, is handled by broadcast instead of shuffle. Fewer than
#: MAX_HOT_TEXTS texts can have that many, which bounds what is broadcast.
HOT_ROWS = 1_000_000
MAX_HOT_TEXTS = 20_000


class Counted(Protocol):
    """Per-text counts that stand in for a table."""

    def label_counts(self, carry: Mapping[str, Column] | None = None) -> DataFrame: ...


def label_counts(
    df: DataFrame | Counted, roles: Roles, carry: Mapping[str, Column] | None = None, sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per distinct (text, label): ``text_key, label, n, first_order``.

    ``carry`` adds columns that are functions of the text; they ride along as
    grouping keys and do not change the groups. ``sums`` adds up columns of the
    rows. Counts kept from earlier are given as they are.
    """
    if not isinstance(df, DataFrame):
        if sums:
            raise ValueError("kept counts have no rows to add up")
        return df.label_counts(carry)
    carry, sums = dict(carry or {}), dict(sums or {})
    keyed = df.select(
        text_key(F.col(roles.text)).alias("text_key"),
        F.col(roles.label).alias("label"),
        roles.order_value().alias("row_order"),
        *[c.alias(name) for name, c in (carry | sums).items()],
    )
    return keyed.groupBy("text_key", "label", *carry).agg(
        F.count(F.lit(1)).alias("n"), F.min("row_order").alias("first_order"), *[F.sum(name).alias(name) for name in sums]
    )


def text_groups(
    df: DataFrame | Counted,
    roles: Roles,
    carry: Mapping[str, Column] | None = None,
    with_labels: bool = False,
) -> DataFrame:
    """One row per distinct text: ``n_labels, n_rows, max_n, first_order``.

    ``n_labels`` counts distinct non-null labels and ``max_n`` the rows of the
    most frequent one. ``with_labels`` adds the sorted label set, whose size is
    bounded by the label domain. Null texts form one group with a null key.
    """
    carry = dict(carry or {})
    aggregates = [
        F.count("label").alias("n_labels"),
        F.sum("n").alias("n_rows"),
        F.max("n").alias("max_n"),
        F.min("first_order").alias("first_order"),
    ]
    if with_labels:
        aggregates.append(F.array_sort(F.collect_list("label")).alias("labels"))
    return label_counts(df, roles, carry).groupBy("text_key", *carry).agg(*aggregates)


def labelled_groups(df: DataFrame | Counted, roles: Roles) -> DataFrame:
    """:func:`label_counts` with the totals of the text beside each of its labels.

    The window runs over at most one row per label of a text.
    """
    whole_text = Window.partitionBy("text_key")
    return label_counts(df, roles).select(
        "*",
        F.count("label").over(whole_text).alias("n_labels"),
        F.sum("n").over(whole_text).alias("n_rows"),
        F.min("first_order").over(whole_text).alias("text_first_order"),
    )


def is_conflicting() -> Column:
    """Over text groups: the text carries more than one label. Never true for null texts."""
    return F.col("text_key").isNotNull() & (F.col("n_labels") > 1)


def keep_rows(df: DataFrame, roles: Roles, wanted: DataFrame, wanted_order: str = "first_order") -> DataFrame:
    """Rows of ``df`` whose order value is listed in ``wanted``.

    Order values identify rows, so the join key cannot be skewed, and Spark
    picks the join by the sizes it measures.
    """
    chosen = wanted.select(F.col(wanted_order).alias("_wanted_order"))
    return df.join(chosen, roles.order_value() == F.col("_wanted_order"), "left_semi")


def attach_by_text(
    df: DataFrame, roles: Roles, groups: DataFrame, value: str, hot_rows: int = HOT_ROWS, key: Column | None = None
) -> DataFrame:
    """``df`` with column ``value`` looked up by text, or by ``key``, in ``groups``; null where absent.

    ``groups`` has one row per ``text_key`` with ``n_rows`` and ``value``.
    Texts with more than ``hot_rows`` rows, or in a very large table more than
    its ``MAX_HOT_TEXTS``-th part, get their value from a broadcast and then
    spread evenly over the shuffle; all others are joined normally, so no join
    task holds more rows of one text than that.
    """
    known = groups.where(F.col("text_key").isNotNull())
    share = groups.agg((F.coalesce(F.sum("n_rows"), F.lit(0)) / MAX_HOT_TEXTS).alias("share")).scalar()
    is_hot = F.col("n_rows") > F.greatest(F.lit(float(hot_rows)), share)
    hot = known.where(is_hot).select(F.col("text_key").alias("_hot_key"), F.col(value).alias("_hot_value"))
    usual = known.where(~is_hot & F.col(value).isNotNull()).select(
        F.col("text_key").alias("_group_key"), F.col(value)
    )
    keyed = df.withColumn("_key", text_key(F.col(roles.text)) if key is None else key)
    marked = keyed.join(F.broadcast(hot), F.col("_key") == F.col("_hot_key"), "left")
    # Rows that need no join get a key of their own in place of the digest. It is
    # never 32 bytes long, so it matches nothing and only scatters these rows.
    scattered = F.xxhash64(*roles.order_columns).cast("string").cast("binary")
    settled = F.col("_key").isNull() | F.col("_hot_key").isNotNull()
    laned = marked.withColumn("_join_key", F.when(settled, scattered).otherwise(F.col("_key")))
    joined = laned.join(usual, F.col("_join_key") == F.col("_group_key"), "left")
    return joined.select(
        *[joined[c] for c in df.columns],
        F.coalesce(F.col("_hot_value"), F.col(value)).alias(value),
    )


#: Stands for the digest of a null text, where null texts have a verdict as well.
NULL_KEY = b"\x00"


def whole_key(text: Column) -> Column:
    """:func:`text_key`, with ``NULL_KEY`` for null."""
    return F.coalesce(text_key(text), F.lit(NULL_KEY))


def attach_rare(
    df: DataFrame,
    roles: Roles,
    verdicts: DataFrame,
    value: str,
    key: Column | None = None,
    max_broadcast: int = MAX_PINNED_ROWS,
    words: int = bloom.WORDS,
) -> DataFrame:
    """``df`` with column ``value`` looked up by text, or by ``key``, in ``verdicts``; null where absent. For verdicts on few texts.

    ``verdicts`` has one row per ``text_key`` with ``n_rows``, the rows of
    ``df`` that have it, and ``value``, which isn't null. Up to
    ``max_broadcast`` of them are broadcast. Beyond that a Bloom filter is, and
    only rows that it can't rule out are shuffled, with the texts of very many
    rows spread as :func:`attach_by_text` does; the others stay in the scan's
    stage. ``df`` is read twice then.
    """
    key = text_key(F.col(roles.text)) if key is None else key
    verdicts = settle(verdicts.select("text_key", "n_rows", value))
    n = verdicts.count()
    if not n:
        return df.withColumn(value, F.lit(None).cast(verdicts.schema[value].dataType))
    if n <= max_broadcast:
        few = F.broadcast(verdicts.select(F.col("text_key").alias("_verdict_key"), value))
        return df.join(few, key == F.col("_verdict_key"), "left").drop("_verdict_key")
    marked = bloom.possible(df, key, bloom.bloom_filter(verdicts, "text_key", words), words)
    ruled_out = marked.where(~F.col("bloom_hit")).drop("bloom_hit")
    ruled_out = ruled_out.withColumn(value, F.lit(None).cast(verdicts.schema[value].dataType))
    others = attach_by_text(marked.where("bloom_hit").drop("bloom_hit"), roles, verdicts, value, key=key)
    return ruled_out.unionByName(others)
