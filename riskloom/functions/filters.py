"""Optional dashboard filters folded into one Column."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FilterSpec:
    """A date range (both ends included) and value lists per column; an empty part restricts nothing."""

    start: dt.date | None = None
    end: dt.date | None = None
    selections: Mapping[str, Sequence] = field(default_factory=dict)
    date_column: str = "app_date"

    def condition(self) -> Column:
        keep = F.lit(True)
        if self.start is not None:
            keep = keep & (F.col(self.date_column) >= F.lit(self.start))
        if self.end is not None:
            keep = keep & (F.col(self.date_column) <= F.lit(self.end))
        for column, values in self.selections.items():
            if values:
                keep = keep & F.col(column).isin(list(values))
        return keep

    def columns(self) -> list[str]:
        """The columns the condition reads."""
        dated = [self.date_column] if self.start or self.end else []
        return dated + [column for column, values in self.selections.items() if values]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.where(self.condition())


def last_days(column: str, days: int, as_of: dt.date) -> Column:
    """Rows of the `days` days that end on `as_of`."""
    return (F.col(column) > F.date_sub(F.lit(as_of), days)) & (F.col(column) <= F.lit(as_of))


def previous_month(column: str, as_of: dt.date) -> Column:
    """Rows of the calendar month before the one holding `as_of`."""
    this_month = F.trunc(F.lit(as_of), "month")
    return (F.col(column) >= F.add_months(this_month, -1)) & (F.col(column) < this_month)
