"""Shares and length statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The points at which length distributions are reported.
QUANTILES = (("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p90", 0.90), ("p95", 0.95), ("p99", 0.99))
LENGTH_STATS = ("min", "max", "mean", "median", "std", "p25", "p75", "p90", "p95", "p99")


def percent(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part`` as a percentage of ``whole``; 0 when there is nothing to divide by."""
    share = F.try_divide(part.cast("double"), whole.cast("double")) * 100
    return F.coalesce(F.round(share, digits), F.lit(0.0))


def over_all(total: Column) -> Column:
    """A total over every row of a *finished report*.

    Only for frames with one row per class, split or policy: they are already
    aggregated, so the single partition this needs holds a handful of rows.
    """
    return total.over(Window.partitionBy())


def histogram_stats(value: str, weight: str) -> list[Column]:
    """Length statistics from a histogram of ``value`` with ``weight`` rows each.

    Working from the histogram means the exact percentiles see one row per
    distinct value, not one per text.
    """
    n = F.when(F.col(value).isNotNull(), F.col(weight))
    total = F.sum(n).cast("double")
    # Whole numbers add up to the same sum in any order, which doubles past 2^53 don't.
    whole = F.col(value).cast("decimal(19,0)")
    first, second = (F.sum((power * n.cast("decimal(19,0)")).cast("decimal(38,0)")).cast("double") for power in (whole, (whole * whole).cast("decimal(19,0)")))
    spread = F.greatest(second - first * first / F.nullif(total, F.lit(0.0)), F.lit(0.0))
    stats = {
        "min": F.min(value).cast("double"),
        "max": F.max(value).cast("double"),
        "mean": F.round(F.try_divide(first, total), 2),
        "std": F.round(F.sqrt(F.try_divide(spread, total - 1)), 2),
    }
    # One aggregate for all points: the engine keeps a single map of values.
    points = F.percentile(value, F.array(*[F.lit(p) for _, p in QUANTILES]), F.coalesce(n, F.lit(0)))
    for i, (name, _) in enumerate(QUANTILES):
        stats[name] = F.round(points[i], 2)
    return [stats[name].alias(name) for name in LENGTH_STATS]


def long_form(frame: DataFrame, keys: list[str], values: list[str], name: str, value: str) -> DataFrame:
    """One row per key and value column, values as doubles."""
    typed = frame.select(*keys, *[F.col(v).cast("double").alias(v) for v in values])
    return typed.unpivot(keys, values, name, value)
