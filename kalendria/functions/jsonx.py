"""JSON out of model answers, repaired where that is safe, and typed defensively."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalendria.functions.text import non_blank, strip, strip_thinking
from kalendria.functions.wordlists import CATEGORIES


def _named(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), lambda v: then(v)), F.lit(0))


def _parsing(text: Column) -> Column:
    fence = non_blank(F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)\s*```", 1))
    braces = non_blank(F.regexp_extract(text, r"(?s)\{.*\}", 0))
    brackets = non_blank(F.regexp_extract(text, r"(?s)\[.*\]", 0))
    good = lambda x: F.when(F.try_parse_json(x).isNotNull(), x)
    return F.coalesce(*(good(x) for x in (text, fence, braces, brackets)))


def json_text(c: Column) -> Column:
    """The part of an answer that parses: the whole, a fenced block, or the widest {...} or [...]; NULL if none does."""
    return _named(strip_thinking(c), _parsing)


def _mended(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"(?<=[{,])\s*'([A-Za-z0-9_]+)'\s*:", '"$1":'), r",(\s*[}\]])", "$1")


def _loosened(text: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(text, r"(?s)/\*.*?\*/", ""), r"(?m)(^|[\s,{\[])//[^\n]*$", "$1")
    plain = F.regexp_replace(_mended(plain), r"([{,]\s*)([A-Za-z_][A-Za-z0-9_]*)\s*:", '$1"$2":')
    return F.regexp_replace(plain, r"([:\[,]\s*)'([^'\"\\\\\n]*)'(?=\s*[,}\]])", '$1"$2"')


def repaired_json_text(c: Column) -> Column:
    """As :func:`json_text`; failing that, with single-quoted keys and trailing commas mended; failing that, without comments, with bare keys and single-quoted values quoted."""
    second = lambda m: F.coalesce(_parsing(m), _named(_loosened(m), _parsing))
    return _named(strip_thinking(c), lambda text: F.coalesce(_parsing(text), _named(_mended(text), second)))


def field(parsed: Column, name: str, kind: str = "string") -> Column:
    """A field of a VARIANT, NULL if missing or of another type."""
    return F.try_variant_get(parsed, f"$.{name}", kind)


def coerce_confidence(c: Column) -> Column:
    """Text to a number in [0, 1]; what is none is 0."""
    number = F.coalesce(F.nanvl(c.try_cast("double"), F.lit(0.0)), F.lit(0.0))  # first: least() passes over NULL
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), number))


def coerce_bool(c: Column, default: bool = False) -> Column:
    return F.coalesce(F.lower(strip(c)).isin("true", "1", "yes", "y"), F.lit(default))


def coerce_int(c: Column) -> Column:
    return strip(c).try_cast("int")


def coerce_str(c: Column) -> Column:
    return non_blank(strip(c))


def coerce_str_list(c: Column) -> Column:
    """Trimmed, without blanks; NULL becomes an empty list."""
    empty = F.expr("cast(array() as array<string>)")
    return F.coalesce(F.filter(F.transform(c, strip), lambda x: x != ""), empty)


def coerce_categories(c: Column) -> Column:
    """Exact members of the closed set, once each, in given order."""
    return F.coalesce(F.array_distinct(F.filter(c, lambda x: x.isin(CATEGORIES))), F.expr("cast(array() as array<string>)"))


def parse_categories(c: Column) -> Column:
    """Members of the closed set out of text parted by comma, slash or semicolon, in any case."""
    names = F.create_map(*(F.lit(x) for cat in CATEGORIES for x in (cat.lower(), cat)))
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), "[,/;]"), lambda x: F.try_element_at(names, F.lower(strip(x))))
    return F.array_distinct(F.array_compact(parts))


def coerce_choice(c: Column, choices: list[str], other: str = "other") -> Column:
    return F.when(strip(c).isin(choices), strip(c)).otherwise(other)


def stable_json(**fields: Column) -> Column:
    """A compact object with its keys in order."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})
