"""Commands: ``python -m labelloom clean | split | report``.

Exit status: 0 if the job is done and as expected, 1 if a table or a setting
isn't as it has to be or a report differs from what was expected, 2 for usage.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from labelloom.operators.pin import release
from labelloom.plans.cleaning import clean_table
from labelloom.plans.reports import write_reports
from labelloom.plans.splitting import split_table
from labelloom.roles import Roles
from labelloom.sources import tables
from labelloom.sources.config import SplitSettings

FORMATS = ("parquet", "csv")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="labelloom", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, about: str) -> argparse.ArgumentParser:
        added = commands.add_parser(name, help=about, description=about)
        added.add_argument("--document", help="also write the report as one JSON document to this file")
        return added

    def source(added: argparse.ArgumentParser) -> None:
        added.add_argument("source", help="the raw table")
        added.add_argument("--format", choices=FORMATS, help="of the raw table; by the ending of its name if not given")
        added.add_argument("--encoding", default="UTF-8", help="of a CSV table")
        for role in ("text", "label", "order"):
            added.add_argument(f"--{role}", default=getattr(Roles(), role), help=f"the column of the {role}")

    clean = command("clean", "Drop contradictory and repeated texts, write the clean table and a report.")
    source(clean)
    clean.add_argument("output", help="where the clean table goes")
    clean.add_argument("report", help="where the report goes")
    clean.add_argument("--output-format", choices=FORMATS, default="parquet")
    clean.add_argument("--expected", help="a JSON file of sections, items and the values the report must have")

    split = command("split", "Split a clean table into train, val and test, and report on the splits.")
    split.add_argument("settings", help="a JSON file of settings")

    report = command("report", "Profile a raw table, its duplicates and what each policy would do.")
    source(report)
    report.add_argument("folder", help="where the reports go")
    return parser


def read_source(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, Roles]:
    """The raw table of a command and its roles; a table without the order column gets one from its files."""
    roles = Roles(args.text, args.label, args.order)
    if (args.format or ("csv" if args.source.lower().endswith(".csv") else "parquet")) == "parquet":
        return tables.read_parquet(spark, args.source, order_column=args.order), roles
    schema = tables.csv_schema(spark, args.source, roles)
    return tables.read_csv(spark, args.source, schema, args.encoding, order_column=roles.order_columns[0]), roles


def expected_values(spark: SparkSession, path: str) -> DataFrame:
    """``section, item, value`` from a JSON object of objects of numbers."""
    sections = json.loads(Path(path).read_text("utf-8"))
    rows = [(section, item, float(value)) for section, items in sections.items() for item, value in items.items()]
    return spark.createDataFrame(rows, "section string, item string, value double")


def clean(spark: SparkSession, args: argparse.Namespace) -> int:
    raw, roles = read_source(spark, args)
    expected = expected_values(spark, args.expected) if args.expected else None
    result = clean_table(spark, raw, args.output, args.report, roles, args.output_format, args.source, expected)
    if args.document:
        tables.write_document(result.report, args.document, tables.read_notes(spark, args.report))
    for line in result.mismatches:
        print(line, file=sys.stderr)
    return 0 if result.as_expected else 1


def split(spark: SparkSession, args: argparse.Namespace) -> int:
    if not Path(args.settings).exists():
        raise FileNotFoundError(f"no such settings: {args.settings}")
    settings = SplitSettings.from_json(args.settings)
    result = split_table(spark, settings)
    if args.document:
        tables.write_document(result.report, args.document, tables.read_notes(spark, settings.report_output))
    leaks = result.report.where("section = 'leakage' and item = 'is_leakage_free' and value = 0").count()
    if leaks:
        print("a text stands in more than one split", file=sys.stderr)
    return 1 if leaks else 0


def report(spark: SparkSession, args: argparse.Namespace) -> int:
    raw, roles = read_source(spark, args)
    written = write_reports(raw, args.folder, roles, args.source)
    if args.document:
        for name, path in written.items():
            file = Path(args.document)
            target = str(file.with_name(f"{file.stem}-{name}{file.suffix}"))
            tables.write_document(tables.read_report(spark, path), target, tables.read_notes(spark, path))
    return 0


COMMANDS = {"clean": clean, "split": split, "report": report}


def main(argv: Sequence[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"labelloom-{args.command}").getOrCreate()
    try:
        return COMMANDS[args.command](spark, args)
    except (ValueError, FileNotFoundError) as error:
        print(error, file=sys.stderr)
        return 1
    finally:
        release(spark)


if __name__ == "__main__":
    sys.exit(main())
