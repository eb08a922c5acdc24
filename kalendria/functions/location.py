"""Location tags and Indian states out of free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalendria.functions import wordlists as W
from kalendria.functions.text import contains_any


def location_tags(where: Column) -> Column:
    """Tags in order of their names. Any online word excludes all others; UK and Switzerland imply Europe; none is Other."""
    uk, ch = contains_any(where, W.UK), contains_any(where, W.SWITZERLAND)
    found = F.array_compact(
        F.array(
            F.when(uk | ch | contains_any(where, W.EUROPE), F.lit("Europe")),
            F.when(where.rlike(r"(?i)\bindia\b"), F.lit("India")),
            F.when(contains_any(where, W.SINGAPORE), F.lit("Singapore")),
            F.when(ch, F.lit("Switzerland")),
            F.when(uk, F.lit("UK")),
            F.when(contains_any(where, W.USA), F.lit("USA")),
        )
    )
    other = F.array(F.lit("Other"))
    return F.when(F.coalesce(where, F.lit("")) == "", other).when(contains_any(where, W.ONLINE), F.array(F.lit("Online"))).when(F.size(found) == 0, other).otherwise(found)


def cities_by_length() -> list[tuple[str, str]]:
    """(city, state), longest first, ties in listed order."""
    return sorted(((c, s) for s, cs in W.STATE_CITIES.items() for c in cs), key=lambda x: -len(x[0]))


def india_state(where: Column) -> Column:
    """State of the longest city name that the text contains."""
    low = F.lower(where)
    out = None
    for city, state in cities_by_length():
        out = F.when(low.contains(city), state) if out is None else out.when(low.contains(city), state)
    return out.otherwise(W.NO_STATE)
