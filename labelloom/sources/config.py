"""Settings of the split job."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields
from pathlib import Path
from typing import Any

from labelloom.roles import Roles


#: Keys of settings files that say nothing this job could do otherwise.
#: All splits go to one partitioned table, and the split is always stratified.
IGNORED = ("train_output", "val_output", "test_output", "stratify")


@dataclass(frozen=True)
class SplitSettings:
    """Every field has a default, so a settings file may name only what it changes.

    The source's format follows the ending of its name where it isn't given. A
    CSV source without the order column gets one from its files, see ``read_csv``.
    """

    random_seed: int = 42
    train_ratio: float = 0.8
    val_ratio: float = 0.1
    test_ratio: float = 0.1
    text_column: str = "text"
    label_column: str = "label"
    order_column: str = "doc_id"
    source_dataset: str = ""
    source_format: str = ""
    encoding: str = "UTF-8"
    split_output: str = ""
    split_format: str = "parquet"
    report_output: str = ""

    @classmethod
    def from_mapping(cls, values: Mapping[str, Any]) -> "SplitSettings":
        if values.get("stratify", True) is not True:
            raise ValueError("only stratified splits are made")
        values = {name: value for name, value in values.items() if name not in IGNORED}
        unknown = sorted(set(values) - {f.name for f in fields(cls)})
        if unknown:
            raise ValueError(f"unknown settings: {unknown}")
        return cls(**values)

    @classmethod
    def from_json(cls, path: str | Path) -> "SplitSettings":
        """Settings from a JSON object; an absent file means all defaults."""
        path = Path(path)
        return cls.from_mapping(json.loads(path.read_text("utf-8"))) if path.exists() else cls()

    @property
    def roles(self) -> Roles:
        return Roles(self.text_column, self.label_column, self.order_column)

    @property
    def format_of_source(self) -> str:
        return self.source_format or ("csv" if self.source_dataset.lower().endswith(".csv") else "parquet")

    def notes(self) -> dict[str, Any]:
        return asdict(self)
