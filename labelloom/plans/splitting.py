"""Splitting a clean table, writing the splits and reporting on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from labelloom.operators import split
from labelloom.sources import tables
from labelloom.sources.config import SplitSettings


@dataclass(frozen=True)
class SplitResult:
    table: DataFrame
    report: DataFrame
    paths: dict[str, str]


def split_table(spark: SparkSession, settings: SplitSettings) -> SplitResult:
    """Read and check the clean table, split it, write the splits, report on what was written.

    The report reads the written table and splits the source a second time,
    so its reproducibility flag speaks about the files.
    """
    roles = settings.roles
    source = tables.read_clean(
        spark, settings.source_dataset, roles, settings.format_of_source, encoding=settings.encoding
    )
    ratios = {
        "train_ratio": settings.train_ratio,
        "val_ratio": settings.val_ratio,
        "test_ratio": settings.test_ratio,
        "seed": settings.random_seed,
    }
    paths = tables.write_splits(
        split.stratified_split(source, roles, **ratios), settings.split_output, settings.split_format
    )
    written = tables.read_splits(spark, settings.split_output, settings.split_format, source.schema)
    report = split.split_report(written, roles, rerun=split.stratified_split(source, roles, **ratios), source=source)
    tables.write_report(report, settings.report_output, {"status": "COMPLETED", **settings.notes()})
    return SplitResult(written, tables.read_report(spark, settings.report_output), paths)
