"""Calendar expressions: Monday weeks, ISO epiweeks (YYYYWW), spines and month windows.

Epiweeks are decoded as ISO weeks (Monday start). An epiweek is valid only if decoding and
re-encoding gives it back (e.g. 202553 is not: 2025 has 52 ISO weeks).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def monday(d) -> Column:
    """Monday of the week containing ``d`` (DATE)."""
    return F.trunc(as_col(d).cast("date"), "week")


def epiweek(d) -> Column:
    """ISO year*100 + ISO week of ``d`` as BIGINT (strftime %G%V)."""
    wk = monday(d)
    return (F.year(F.date_add(wk, 3)) * 100 + F.weekofyear(wk)).cast("bigint")


def epiweek_monday_unchecked(ew) -> Column:
    ew = as_col(ew).cast("bigint")
    year = F.floor(ew / 100).cast("int")
    week = (ew % 100).cast("int")
    safe_year = F.when(year.between(1, 9998), year)
    week1 = F.trunc(F.make_date(safe_year, F.lit(1), F.lit(4)), "week")
    return F.date_add(week1, (week - 1) * 7)


def epiweek_is_valid(ew) -> Column:
    ew = as_col(ew).cast("bigint")
    week = ew % 100
    d = epiweek_monday_unchecked(ew)
    return F.coalesce(week.between(1, 53) & (epiweek(d) == ew), F.lit(False))


def epiweek_monday(ew) -> Column:
    """Monday DATE of an ISO epiweek; NULL when the epiweek does not exist."""
    return F.when(epiweek_is_valid(ew), epiweek_monday_unchecked(ew))


def epiweek_add(ew, weeks) -> Column:
    """Epiweek ``weeks`` weeks after ``ew`` (across year ends); NULL for an invalid ``ew``."""
    return epiweek(F.date_add(epiweek_monday(ew), as_col(weeks).cast("int") * 7))


def days_inclusive(start, end) -> Column:
    return (F.datediff(as_col(end), as_col(start)) + 1).cast("bigint")


def day_spine(start, end) -> Column:
    """Array of every date start..end inclusive (explode on the executors)."""
    return F.sequence(as_col(start).cast("date"), as_col(end).cast("date"),
                      F.expr("INTERVAL 1 DAY"))


def week_spine(start, end) -> Column:
    """Array of every Monday from monday(start) to monday(end) inclusive."""
    return F.sequence(monday(start), monday(end), F.expr("INTERVAL 7 DAYS"))


def month_window_starts(start, end) -> Column:
    return F.sequence(F.trunc(as_col(start).cast("date"), "month"),
                      F.trunc(as_col(end).cast("date"), "month"), F.expr("INTERVAL 1 MONTH"))


def clip_month_window(month_start: Column, start, end) -> tuple[Column, Column]:
    """(window_start, window_end) of a calendar month clipped to [start, end]."""
    ws = F.greatest(month_start, as_col(start).cast("date"))
    we = F.least(F.last_day(month_start), as_col(end).cast("date"))
    return ws, we


def resolve_range_cols(start: Column, end: Column, align_monday: bool) -> tuple[Column, Column, Column]:
    """Run ranges stored in a table.

    Returns (start, end, status); NULL end means today; status is OK, INVALID_START,
    INVALID_END or END_BEFORE_START."""
    s = start.cast("date")
    e = F.coalesce(end.cast("date"), F.current_date())
    if align_monday:
        s, e = monday(s), monday(e)
    status = (F.when(s.isNull(), "INVALID_START").when(e.isNull(), "INVALID_END")
              .when(e < s, "END_BEFORE_START").otherwise("OK"))
    return s, e, status
