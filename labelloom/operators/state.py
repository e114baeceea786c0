"""Per-text counts that are kept from one load to the next.

The state is a table with one row per distinct text: its digest, its labels with
their rows and first row, and the two short samples that reports show. It is
bucketed by digest and sorted in its buckets, so rows that arrive later are
counted by themselves, a few bytes per text, and merged in by a join that moves
only them: what is stored stays where it is, however large it has grown.

A :class:`TextState` stands in for the table wherever an operator asks only for
per-text counts, as those of :mod:`duplicates` do. Which row is first goes by
the order value, so rows that arrive later need order values of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.text import shorten
from labelloom.operators import groups
from labelloom.operators.validate import require_columns
from labelloom.roles import Roles

#: Buckets of a state; some ten million texts each are well sized.
BUCKETS = 256

#: Characters of the two samples of a text that a state keeps.
LEAD, SAMPLE = 60, 120


def samples(text: Column) -> dict[str, Column]:
    return {"lead": F.substring(text, 1, LEAD), "sample": shorten(text, SAMPLE)}


def _per_text(df: DataFrame, roles: Roles) -> DataFrame:
    """``text_key, lead, sample, labels``: one row per text, with ``label, n, first_order`` for each of its labels."""
    require_columns(df, roles.text, roles.label, *roles.order_columns)
    counts = groups.label_counts(df, roles, samples(F.col(roles.text)))
    listed = F.collect_list(F.struct("label", "n", "first_order")).alias("labels")
    return counts.groupBy("text_key", "lead", "sample").agg(listed)


def _added(a: Column, b: Column) -> Column:
    """The labels of both lists, their rows added up; lists are as long as a text has labels."""
    both = F.concat(F.coalesce(a, F.array()), F.coalesce(b, F.array()))
    of = lambda label: F.filter(both, lambda x: x["label"].eqNullSafe(label))
    rows = lambda label: F.aggregate(of(label), F.lit(0).cast("long"), lambda total, x: total + x["n"])
    first = lambda label: F.array_min(F.transform(of(label), lambda x: x["first_order"]))
    names = F.array_distinct(F.transform(both, lambda x: x["label"]))
    return F.transform(names, lambda label: F.struct(label.alias("label"), rows(label).alias("n"), first(label).alias("first_order")))


@dataclass(frozen=True)
class TextState:
    """Per-text counts as rows ``text_key, lead, sample, labels``."""

    frame: DataFrame

    def label_counts(self, carry: Mapping[str, Column] | None = None) -> DataFrame:
        """As :func:`groups.label_counts` gives them; of samples those that are kept."""
        unknown = sorted(set(carry or {}) - {"lead", "sample"})
        if unknown:
            raise ValueError(f"the state doesn't keep {unknown}")
        return self.frame.select("text_key", *(carry or {}), F.inline("labels")).select("text_key", "label", *(carry or {}), "n", "first_order")

    def merged(self, df: DataFrame, roles: Roles = Roles()) -> TextState:
        """This state with the rows of ``df`` added."""
        new = _per_text(df, roles)
        new = new.select(F.col("text_key").alias("_key"), *[F.col(c).alias(f"_{c}") for c in ("lead", "sample", "labels")])
        old = self.frame
        # Null texts are one row on either side and equal to nothing in a join.
        joined = old.where("text_key is not null").join(new.where("_key is not null"), F.col("text_key") == F.col("_key"), "full_outer")
        columns = [F.coalesce(c, f"_{c}").alias(c) for c in ("lead", "sample")]
        known = joined.select(F.coalesce("text_key", "_key").alias("text_key"), *columns, _added(F.col("labels"), F.col("_labels")).alias("labels"))
        nulls = old.where("text_key is null").select("labels").unionByName(new.where("_key is null").select(F.col("_labels").alias("labels")))
        nulls = nulls.agg(F.flatten(F.collect_list("labels")).alias("all")).where(F.size("all") > 0)
        none = [F.lit(None).cast(known.schema[c].dataType).alias(c) for c in ("text_key", "lead", "sample")]
        return TextState(known.unionByName(nulls.select(*none, _added(F.col("all"), F.lit(None)).alias("labels"))))

    def save(self, path: str, buckets: int = BUCKETS) -> TextState:
        """Write the state to ``path``, which must be new, one sorted file to a bucket, and read it back."""
        spark = self.frame.sparkSession
        name = _table_name()
        dealt = self.frame.repartition(buckets, "text_key")
        dealt.write.format("parquet").bucketBy(buckets, "text_key").sortBy("text_key").option("path", path).saveAsTable(name)
        return TextState(spark.table(name))


def _table_name() -> str:
    return f"labelloom_state_{uuid.uuid4().hex}"


def build(df: DataFrame, roles: Roles = Roles()) -> TextState:
    """The state of a table."""
    return TextState(_per_text(df, roles))


def load(spark: SparkSession, path: str, buckets: int = BUCKETS) -> TextState:
    """The state that :meth:`TextState.save` wrote with so many buckets, in this or an earlier session."""
    name = _table_name()
    shape = spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape.fields)
    where = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (text_key) SORTED BY (text_key) INTO {buckets} BUCKETS LOCATION '{where}'"
    )
    return TextState(spark.table(name))
