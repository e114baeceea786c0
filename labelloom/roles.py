"""Which columns of a table play which part."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Roles:
    """Column roles of a labelled-text table.

    ``order`` stands in for the position of a row in a file: it must identify
    a row, and "first" always means the smallest value of it. Several columns
    together may form the order.
    """

    text: str = "text"
    label: str = "label"
    order: str | tuple[str, ...] = "doc_id"

    @property
    def order_columns(self) -> tuple[str, ...]:
        return (self.order,) if isinstance(self.order, str) else tuple(self.order)

    def order_value(self) -> Column:
        names = self.order_columns
        return F.col(names[0]) if len(names) == 1 else F.struct(*names)
