"""Calendar helpers for short lists of as-of dates (driver side) and their Column forms."""

from __future__ import annotations

import calendar
import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INTERVAL = re.compile(r"^\s*(\d+)\s*(day|week|month|year)s?\s*$", re.I)
UNBOUNDED_MONTHS = 9999


def to_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def add_months(day: date, months: int) -> date:
    """Calendar shift that clamps to the last day of the target month."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    month += 1
    return date(year, month, min(day.day, calendar.monthrange(year, month)[1]))


def whole_months(start: date, end: date) -> int:
    """Complete calendar months from start to end, truncated towards zero."""
    months = (end.year - start.year) * 12 + end.month - start.month
    if months > 0 and add_months(start, months) > end:
        months -= 1
    elif months < 0 and add_months(start, months) < end:
        months += 1
    return months


@dataclass(frozen=True)
class Interval:
    """A calendar interval such as ``7 days``, ``1 month``, ``1 year`` or all history."""

    amount: int
    unit: str

    @classmethod
    def parse(cls, text: str | Interval) -> Interval:
        if isinstance(text, Interval):
            return text
        found = _INTERVAL.match(text)
        if not found:
            raise ValueError(f"not an interval: {text!r}")
        return cls(int(found.group(1)), found.group(2).lower())

    @property
    def months(self) -> int | None:
        return {"month": self.amount, "year": 12 * self.amount}.get(self.unit)

    @property
    def unbounded(self) -> bool:
        return (self.months or 0) >= UNBOUNDED_MONTHS

    @property
    def suffix(self) -> str:
        return f"{self.amount}{self.unit[0]}"

    def before(self, day: date) -> date:
        if self.months is not None:
            return add_months(day, -self.months)
        return day - timedelta(days=self.amount * (7 if self.unit == "week" else 1))

    def after(self, day: date) -> date:
        if self.months is not None:
            return add_months(day, self.months)
        return day + timedelta(days=self.amount * (7 if self.unit == "week" else 1))

    def before_col(self, day: Column) -> Column:
        if self.months is not None:
            return F.add_months(day, -self.months)
        return F.date_sub(day, self.amount * (7 if self.unit == "week" else 1))


def date_structs(rows: Sequence[dict[str, date | None]]) -> Column:
    """Literal array of structs, one per as-of date; its length is the number of dates."""
    text = lambda v: "cast(null as date)" if v is None else f"date'{v}'"
    structs = ["named_struct(" + ", ".join(f"'{k}', {text(v)}" for k, v in row.items()) + ")" for row in rows]
    return F.expr(f"array({', '.join(structs)})")


def fan_out(df: DataFrame, columns: Sequence[str | Column], rows: Sequence[dict[str, date | None]], keep) -> DataFrame:
    """Each row once per as-of date for which ``keep(window)`` holds, with the date's struct ``_w``.

    This turns "event within a window of as-of date" into a narrow step, so that what follows is
    an equi-key aggregate instead of a range join. Explode and filter run in one generated loop.
    """
    return df.select(*columns, F.explode(date_structs(rows)).alias("_w")).where(keep(F.col("_w")))
