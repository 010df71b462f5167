"""Reporting-window calendar as Column expressions.

A report for month ``m`` of year ``y`` has three nested windows:

* ``month``   — the month itself;
* ``quarter`` — up to three months ending at ``m``, clipped at January;
* ``ytd``     — January .. ``m`` (its start may be overridden for the label and
  day count only; the rows stay January .. ``m``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month abbreviations as they appear in accounting file names.
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def month_from_abbr(abbr: Column) -> Column:
    """``Jan`` .. ``Dec`` -> 1 .. 12 (null for anything else)."""
    pos = F.array_position(F.array(*[F.lit(a) for a in MONTH_ABBR]), abbr)
    return F.when(pos > 0, pos.cast("int"))


def window_months(month: int) -> dict[str, list[int]]:
    """Member months of each window tag for a report month (1-based)."""
    if not 1 <= month <= 12:
        raise ValueError(f"month must be 1..12, got {month}")
    return {
        "month": [month],
        "quarter": list(range(max(1, month - 2), month + 1)),
        "ytd": list(range(1, month + 1)),
    }


# The calendar is written as SQL expressions over columns ``tag``, ``year``
# and ``month``: each is parsed JVM-side in one call.
_FIRST = "make_date(year, month, 1)"
_NEXT = f"add_months({_FIRST}, 1)"


def window_start_sql(ytd_start: _dt.date | None = None) -> str:
    """First day of a window (quarter clipped at January)."""
    ytd = "make_date(year, 1, 1)" if ytd_start is None else f"DATE'{ytd_start.isoformat()}'"
    return (f"CASE tag WHEN 'month' THEN {_FIRST} "
            f"WHEN 'quarter' THEN add_months({_NEXT}, -least(3, month)) "
            f"WHEN 'ytd' THEN {ytd} END")


WINDOW_END_SQL = f"last_day({_FIRST})"
WINDOW_DAYS_SQL = f"datediff({_NEXT}, start_date)"
PERIOD_LABEL_SQL = "concat(date_format(start_date, 'dd/MM/yyyy'), ' - ', date_format(end_date, 'dd/MM/yyyy'))"
MONTH_NAME_SQL = f"date_format({_FIRST}, 'MMMM')"
