"""Calendar helpers.  "Today" is always an argument, so results can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# Label, month, first day, last day, weekday (None for any).
HOLIDAYS = (
    ("New Years Day", 1, 1, 1, None),
    ("Valentines Day", 2, 14, 14, None),
    ("Presidents Day", 2, 15, 21, "Monday"),
    ("St. Patricks Day", 3, 17, 17, None),
    ("April Fools Day", 4, 1, 1, None),
    ("Memorial Day", 5, 25, 31, "Monday"),
    ("Independence Day", 7, 4, 4, None),
    ("Labor Day", 9, 1, 7, "Monday"),
    ("Halloween", 10, 31, 31, None),
    ("Veterans Day", 11, 11, 11, None),
    ("Thanksgiving", 11, 22, 28, "Thursday"),
    ("Black Friday", 11, 23, 29, "Friday"),
    ("Christmas Eve", 12, 24, 24, None),
    ("Christmas", 12, 25, 25, None),
    ("New Years Eve", 12, 31, 31, None),
)

# First day of the count and the Julian day number it stands for.
JULIAN_BASE_DATE = "1900-01-01"
JULIAN_BASE_DAY = 2415021

# Fixed value: the part of a free-form date that can be trusted.
FUZZY_DATE = r"(\d{4}\s+[A-Za-z]{3}\s+\d{1,2})"


def day_of_week(when: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(when) - 1


def day_name(when: Column) -> Column:
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.try_element_at(names, F.dayofweek(when))


def month_start(when: Column) -> Column:
    return F.trunc(when, "month")


def add_units(when: Column, unit: str, n: int | Column) -> Column:
    """Date moved by ``n`` days, weeks, months, quarters or years."""
    n = n if isinstance(n, Column) else F.lit(n)
    day = F.to_date(when)
    if unit in ("day", "week"):
        return F.date_add(day, (n * (7 if unit == "week" else 1)).cast("int"))
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    return F.add_months(day, (n * months).cast("int"))


def year_diff(start: Column, end: Column) -> Column:
    """Number of year boundaries between two dates."""
    return F.year(end) - F.year(start)


def within_last(when: Column, unit: str, n: int, as_of: dt.date | str) -> Column:
    """True for dates in the ``n`` units up to and including ``as_of``."""
    today = F.to_date(F.lit(as_of))
    day = F.to_date(when)
    return (day >= add_units(today, unit, -n)) & (day <= today)


def julian_to_date(julian_day: Column) -> Column:
    """Calendar date of a Julian day, rounded half to even like the source data needs."""
    days = F.rint(julian_day.cast("double") - JULIAN_BASE_DAY).cast("int")
    return F.date_add(F.to_date(F.lit(JULIAN_BASE_DATE)), days)


def fuzzy_date(text: Column) -> Column:
    """Date in text such as ``1959 Jan 21 2342?``; null where there is none."""
    found = F.regexp_extract(F.replace(text, F.lit("?"), F.lit("")), FUZZY_DATE, 1)
    one_blank = F.regexp_replace(F.trim(found), r"\s+", " ")
    return F.try_to_date(F.nullif(one_blank, F.lit("")), "yyyy MMM d")


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date from numbers; null where any is null or the day does not exist."""
    complete = year.isNotNull() & month.isNotNull() & day.isNotNull()
    text = F.concat_ws("-", *[p.cast("int").cast("string") for p in (year, month, day)])
    return F.when(complete, F.try_to_date(text, "y-M-d"))


def holiday_label(when: Column) -> Column:
    """Holiday name where the day is one, else the weekday name."""
    weekday = day_name(when)
    out = None
    for label, month, first, last, name in HOLIDAYS:
        test = (F.month(when) == month) & F.dayofmonth(when).between(first, last)
        if name is not None:
            test = test & (weekday == name)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(weekday)
