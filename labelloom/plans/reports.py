"""The read-only reports on a raw table, written side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions.text import text_key
from labelloom.operators import duplicates, policies, profile, validate
from labelloom.operators.pin import release, settle
from labelloom.roles import Roles
from labelloom.sources import tables


def stand_in(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """``df`` reduced to its roles, with each text replaced by a digest of fixed length.

    Duplicate and policy reports only ask whether texts are equal, so they
    give the same numbers on the stand-in and read a fraction of the bytes.
    """
    validate.require_columns(df, roles.text, roles.label, *roles.order_columns)
    return df.select(
        *roles.order_columns, F.hex(text_key(F.col(roles.text))).alias(roles.text), F.col(roles.label)
    )


def write_reports(df: DataFrame, folder: str, roles: Roles = Roles(), source_name: str = "") -> dict[str, str]:
    """Profile, duplicate and policy-impact reports as JSON lines; returns their paths."""
    folder = folder.rstrip("/")
    narrow = settle(stand_in(df, roles))
    notes = {"source_file": source_name}
    reports = {
        "profile": profile.profile_report(df, roles),
        "duplicates": duplicates.duplicate_report(narrow, roles),
        "policy_impact": policies.policy_impact_report(narrow, roles),
    }
    written = {name: tables.write_report(report, f"{folder}/{name}", notes) for name, report in reports.items()}
    release(df.sparkSession)
    return written
