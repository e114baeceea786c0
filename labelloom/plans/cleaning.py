"""Cleaning a raw table with one policy and reporting what it did."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from labelloom.operators import policies, validate
from labelloom.roles import Roles
from labelloom.sources import tables


@dataclass(frozen=True)
class CleaningResult:
    table: DataFrame
    report: DataFrame
    mismatches: list[str]

    @property
    def as_expected(self) -> bool:
        return not self.mismatches


def clean_table(
    spark: SparkSession,
    raw: DataFrame,
    output_path: str,
    report_path: str,
    roles: Roles = Roles(),
    output_format: str = "parquet",
    source_name: str = "",
    expected: DataFrame | None = None,
) -> CleaningResult:
    """Apply policy D to ``raw``, write table and report, and hold the report against ``expected``.

    ``expected`` has ``section, item, value``; only what it lists is compared.
    A raw table needs an order column: which row is first is never guessed.
    """
    validate.require_columns(raw, roles.text, roles.label, *roles.order_columns)
    validate.assert_order_identifies_rows(raw, roles)
    tables.write_table(policies.policy_d(raw, roles), output_path, output_format)
    # The names of the report's fields.
    notes = {
        "policy": "D",
        "policy_name": "Policy D",
        "policy_description": (
            "Texts with more than one label are removed; of the others the first row of each text is kept."
        ),
        "source_file": source_name,
        "output_file": output_path,
    }
    table = (
        spark.read.parquet(output_path)
        if output_format == "parquet"
        else tables.read_csv(spark, output_path, raw.schema)
    )
    tables.write_report(policies.cleaning_report(raw, roles, table), report_path, notes)
    report = tables.read_report(spark, report_path)
    mismatches = []
    if expected is not None:
        keys = ["section", "item"]
        listed = report.join(expected.select(*keys), keys, "left_semi")
        for row in validate.expected_value_mismatches(listed, expected, keys).orderBy(*keys).collect():
            mismatches.append(f"{row['section']}.{row['item']}: {row['actual']} instead of {row['expected']}")
    return CleaningResult(table, report, mismatches)
