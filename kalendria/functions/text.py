"""Text expressions over columns; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalendria.functions.wordlists import CATEGORY_WORDS, CONFERENCE_SIGNALS, VIRTUAL_WORDS

WHITE = r"(?U)\s"


def strip(c: Column) -> Column:
    """White space of any script off both ends."""
    return F.regexp_replace(c, rf"{WHITE}+$|^{WHITE}+", "")


def non_blank(c: Column) -> Column:
    """NULL for an empty string: a chain of fallbacks skips it as it skips NULL."""
    return F.nullif(c, F.lit(""))


def first_filled(*cs: Column) -> Column:
    """The first value that is neither NULL nor empty; else the last."""
    return F.coalesce(*(non_blank(c) for c in cs[:-1]), cs[-1])


def contains_any(c: Column, words: list[str]) -> Column:
    low = F.lower(c)
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w)
    return out


def normalise_acronym(c: Column) -> Column:
    """A key under which spellings of one acronym meet: no article, ordinal, trailing year or punctuation. NULL gives ''."""
    s = F.lower(strip(F.coalesce(c, F.lit(""))))
    for pattern in (r"^the ", rf"(?U)^(\d+)(st|nd|rd|th)\s+", r"(?U)\s*(?:19|20)\d{2}\s*$", r"(?U)\s*\d{2}\s*$", r"[-._/'\"]"):
        s = F.regexp_replace(s, pattern, "")
    return strip(F.regexp_replace(s, rf"{WHITE}+", " "))


URL = r"^([^:/?#]+)://(?:[^/?#@]*@)?([^/?#:]*)(?::(\d+))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def canonical_url(c: Column) -> Column:
    """Lower-case scheme and host, no default port, user or fragment, no trailing slash but that of the root; the query stays."""
    part = lambda i: F.regexp_extract(c, URL, i)
    scheme, host, port, query = F.lower(part(1)), F.lower(part(2)), part(3), part(5)
    path = F.when(part(4) == "", "/").when((F.length(part(4)) > 1) & part(4).endswith("/"), F.expr("NULL")).otherwise(part(4))
    path = F.coalesce(path, F.regexp_replace(part(4), "/$", ""))
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port == "")
    return F.concat(scheme, F.lit("://"), host, F.when(default, "").otherwise(F.concat(F.lit(":"), port)), path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def job_id(url: Column) -> Column:
    return F.substring(F.sha2(canonical_url(url), 256), 1, 32)


def text_hash(c: Column) -> Column:
    return F.sha1(c)


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))


def event_id_of(url: Column, missing: int | None = None) -> Column:
    """The id in a URL's query: strict (?eventid= or &eventid=) gives NULL without one; with ``missing``, anywhere."""
    pattern = r"[?&]eventid=(\d+)" if missing is None else r"eventid=(\d+)"
    found = F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1).try_cast("long")
    return found if missing is None else F.coalesce(found, F.lit(missing).cast("long"))


def first_year(acronym: Column, name: Column) -> Column:
    found = lambda c: non_blank(F.regexp_extract(F.coalesce(c, F.lit("")), r"\b(20\d{2})\b", 1))
    return F.coalesce(found(acronym), found(name)).cast("int")


def slug(acronym: Column, edition_year: Column, start: Column, paper: Column) -> Column:
    year = F.coalesce(F.nullif(edition_year, F.lit(0)), F.year(start), F.year(paper))
    text = F.coalesce(year.cast("string"), F.lit(""))
    short = F.upper(acronym)
    base = F.when(text == "", short).otherwise(strip(F.regexp_replace(short, F.concat(F.lit(r"\s*"), text, F.lit(r"\s*$")), F.lit(""))))
    return F.regexp_replace(F.regexp_replace(F.concat(base, F.lit("-"), text), "[^A-Z0-9]+", "-"), "^-+|-+$", "")


def acronym_hint(c: Column) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"(?U)\b([A-Z][A-Z0-9]{1,11}(?:[ -]?20\d{2})?)\b", 1)


def name_hint(c: Column) -> Column:
    """The first line of 5 to 200 characters; else the first 120 characters."""
    text = F.coalesce(c, F.lit(""))
    lines = F.filter(F.transform(F.split(text, r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85  ]"), strip), lambda x: F.length(x).between(5, 200))
    return F.coalesce(F.get(lines, F.lit(0)), strip(F.substring(text, 1, 120)))


def embedding_text(acronym: Column, name: Column, description: Column, where: Column, when: Column, categories: Column) -> Column:
    return F.concat_ws(" | ", *(non_blank(strip(c)) for c in (acronym, name, description, where, when)), categories)


def strip_thinking(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?s)<think>.*?</think>", ""))


# The ranges of scripts that count as not Latin.
NON_LATIN = "[Ѐ-ӿ؀-ۿऀ-ॿ一-鿿぀-ヿ가-힯฀-๿א-ת]"


def is_english(c: Column) -> Column:
    """Under 5 % of the characters are of other scripts; NULL and '' are."""
    other = F.length(c) - F.length(F.regexp_replace(c, NON_LATIN, ""))
    return F.coalesce(other / F.greatest(F.length(c), F.lit(1)) < 0.05, F.lit(True))


def count_tokens(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(F.coalesce(c, F.lit(""))) / 4)).cast("int")


def deadline_parts(c: Column) -> tuple[Column, Column]:
    """(paper, abstract) of a cell like ``paper (abstract)``; NULL where there is none."""
    text = F.coalesce(c, F.lit(""))
    return non_blank(strip(F.regexp_extract(text, r"^([^(]+?)(?:\s*\(.*\))?$", 1))), non_blank(F.regexp_extract(text, r"\(([^)]+)\)", 1))


def detect_virtual(c: Column) -> Column:
    return contains_any(c, VIRTUAL_WORDS)


def classify_category(c: Column) -> Column:
    """The categories of which a keyword occurs, in their fixed order."""
    return F.array_compact(F.array(*(F.when(contains_any(c, words), F.lit(cat)) for cat, words in CATEGORY_WORDS.items())))


def conference_signals(c: Column) -> Column:
    low = F.lower(c)
    return sum((low.contains(s).cast("int") for s in CONFERENCE_SIGNALS), F.lit(0))


def is_conference_text(c: Column) -> Column:
    return conference_signals(c) >= 2
