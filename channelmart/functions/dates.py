"""Run-date rules (D1-D6). Every job takes ``as_of`` explicitly; no query body
calls ``current_date()``, so reruns are reproducible."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["yesterday", "resolve_range", "last_n_days", "table_suffix",
           "stay_limit", "range_bounds_col"]


def _d(x: str | _dt.date) -> _dt.date:
    return x if isinstance(x, _dt.date) else _dt.date.fromisoformat(str(x))


def yesterday(as_of: str | _dt.date) -> str:
    """The default run day is the day before ``as_of`` (UTC)."""
    return (_d(as_of) - _dt.timedelta(days=1)).isoformat()


def resolve_range(start: str | None, end: str | None, as_of: str | _dt.date,
                  default: str = "month_to_date") -> tuple[str, str]:
    """An explicit range is used only when both ends are given;
    otherwise month-to-date of yesterday, or just yesterday."""
    if start and end:
        return str(start), str(end)
    y = _d(yesterday(as_of))
    if default == "month_to_date":
        return y.replace(day=1).isoformat(), y.isoformat()
    return y.isoformat(), y.isoformat()


def last_n_days(as_of: str | _dt.date, n: int = 7) -> list[str]:
    """as_of-n .. as_of-1, ascending."""
    a = _d(as_of)
    return [(a - _dt.timedelta(days=i)).isoformat() for i in range(n, 0, -1)]


def table_suffix(as_of: str | _dt.date, lag_days: int = 2) -> str:
    """Daily-table suffix 'YYYYMMDD' of as_of minus ``lag_days``."""
    return (_d(as_of) - _dt.timedelta(days=lag_days)).strftime("%Y%m%d")


def stay_limit(depart: Column) -> Column:
    """Departure + 1 day as 'YYYY-MM-DD'; if the departure prefix does not
    parse, the prefix itself is the bound."""
    prefix = F.substring(F.coalesce(depart, F.lit("")), 1, 10)
    parsed = F.try_to_date(prefix, "yyyy-M-d")
    return F.coalesce(F.date_format(F.date_add(parsed, 1), "yyyy-MM-dd"), prefix)


def range_bounds_col(as_of: Column) -> tuple[Column, Column]:
    """D1+D2 as Columns: (first day of yesterday's month, yesterday)."""
    y = F.date_sub(as_of, 1)
    return F.trunc(y, "MM"), y
