"""Dates out of text, and what reports and cascades ask of dates.

No expression reads the clock: ``as_of`` is always a parameter.
"""

from __future__ import annotations

from datetime import date, datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kalendria.functions.text import strip


def start_date(when: Column) -> Column:
    """The first ``Mon d[,] yyyy`` with an abbreviated English month; anything else is NULL."""
    found = F.regexp_replace(F.regexp_extract(when, r"([A-Za-z]+ +\d{1,2},? +\d{4})", 1), ",", "")
    return F.when(strip(when).isin("N/A", "TBD", ""), F.lit(None)).otherwise(F.try_to_date(F.regexp_replace(found, " +", " "), "MMM d yyyy"))


def is_past(when: Column, as_of: Column) -> Column:
    """True only for a date that was understood and lies before ``as_of``."""
    return F.coalesce(start_date(when) < as_of, F.lit(False))


def iso_date(c: Column) -> Column:
    """Strict yyyy-MM-dd, else NULL."""
    s = strip(c)
    return F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(s, "yyyy-M-d"))


def next_deadline(as_of: Column, *deadlines: Column) -> Column:
    """The least deadline from ``as_of`` on."""
    return F.least(*(F.when(d >= as_of, d) for d in deadlines)) if len(deadlines) > 1 else F.when(deadlines[0] >= as_of, deadlines[0])


def days_to_deadline(as_of: Column, *deadlines: Column) -> Column:
    return F.datediff(next_deadline(as_of, *deadlines), as_of)


def edition_year(start: Column, paper: Column, as_of: Column) -> Column:
    return F.coalesce(F.year(start), F.year(paper), F.year(as_of))


def date_anomaly(*milestones: Column) -> Column:
    """True if two milestones that are known stand in the wrong order; they are given in their due order."""
    out = F.lit(False)
    for i, later in enumerate(milestones):
        for earlier in milestones[:i]:
            out = out | F.coalesce(earlier > later, F.lit(False))
    return out


def dates_compatible(a: Column, b: Column, days: int = 30) -> Column:
    """Within ``days`` of each other, or one unknown."""
    return F.coalesce(F.abs(F.datediff(a, b)) <= days, F.lit(True))


def deadline_change(old: Column, new: Column) -> Column:
    return (
        F.when(old.isNull() & new.isNotNull(), "new_deadline")
        .when(old.isNotNull() & new.isNull(), "cancelled")
        .when(new > old, "extension")
        .when(new < old, "brought_forward")
    )


def split_range(when: Column) -> Column:
    """(start text, end text): a seed's range is cut at its first dash; without one both are the whole."""
    parts = F.split(when, r"(?U)\s*[-–—]\s*", 2)
    blank = F.lower(strip(F.coalesce(when, F.lit("n/a")))).isin("n/a", "tba", "tbd")
    whole = F.struct(when.alias("start_text"), when.alias("end_text"))
    none = F.struct(F.lit(None).cast("string").alias("start_text"), F.lit(None).cast("string").alias("end_text"))
    return F.when(blank, none).when(F.size(parts) == 2, F.struct(F.get(parts, F.lit(0)).alias("start_text"), F.get(parts, F.lit(1)).alias("end_text"))).otherwise(whole)


def listing_range(when: Column) -> tuple[Column, Column]:
    """(first, last) part of a listing's range; no last part without a dash."""
    parts = F.split(when, r"(?U)\s*[-–]\s*")
    return F.get(parts, F.lit(0)), F.when(F.size(parts) > 1, F.element_at(parts, -1))


def _parse(s: str | None, default: datetime, unknown: set[str], fuzzy: bool) -> date | None:
    from dateutil import parser

    if s is None or s.strip().lower() in unknown:
        return None
    try:
        return parser.parse(s.strip(), default=default, fuzzy=fuzzy).date()
    except (ValueError, TypeError, OverflowError):
        return None


def seed_date(c: Column) -> Column:
    """Free-form dates of seed records; missing fields are those of 2000-01-01."""

    @F.pandas_udf(T.DateType())
    def parse(s: pd.Series) -> pd.Series:
        return s.map(lambda x: _parse(x, datetime(2000, 1, 1), {"", "n/a", "tba", "tbd"}, False))

    return parse(c)


def fuzzy_date(c: Column, as_of: date) -> Column:
    """Dates inside other words; missing fields are those of ``as_of``."""
    day = datetime(as_of.year, as_of.month, as_of.day)

    @F.pandas_udf(T.DateType())
    def parse(s: pd.Series) -> pd.Series:
        return s.map(lambda x: _parse(x, day, {"", "tbd", "n/a", "-"}, True))

    return parse(c)
