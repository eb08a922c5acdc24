"""What surrounds fetching and sessions: waits, ids, parser choice. The network itself is outside."""

from __future__ import annotations

import hashlib
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parsers that give nothing yet.
STUBS = "acm cmt easychair edas hotcrp ieee openreview springer usenix".split()


def backoff_seconds(attempt: Column, retry_after: Column | None = None, most: float = 600.0, seed: int | None = None) -> Column:
    """Two to the attempt and a jitter under a second, or what the server asks; never over ``most``."""
    jitter = F.rand() if seed is None else F.rand(seed)
    wait = F.pow(F.lit(2.0), attempt) + jitter
    return F.least(wait if retry_after is None else F.coalesce(retry_after.cast("double"), wait), F.lit(most))


def human_delay(seed: int | None = None) -> Column:
    """Normal around 8 s within 5 to 15, one in ten with a pause of 15 to 45 s more."""
    n = F.randn(seed) if seed is not None else F.randn()
    u = F.rand(seed) if seed is not None else F.rand()
    v = F.rand(seed + 1) if seed is not None else F.rand()
    return F.least(F.lit(15.0), F.greatest(F.lit(5.0), n * 2.5 + 8.0)) + F.when(u < 0.1, v * 30 + 15).otherwise(0.0)


def session_id(started: Column, machine: Column, token: Column | None = None) -> Column:
    """UTC minute, machine and eight characters of a random id."""
    return F.concat_ws("-", F.date_format(started, "yyyy-MM-dd'T'HH:mm'Z'"), machine, F.substring(F.uuid() if token is None else token, 1, 8))


def file_tag(path: str) -> str:
    """A short tag of a file's content."""
    return hashlib.sha1(Path(path).read_bytes()).hexdigest()[:12]


def parser_of(module: Column) -> Column:
    """The parser's own name out of its module; NULL for none and for those that give nothing."""
    name = F.element_at(F.split(module, r"\."), -1)
    return F.when(~name.isin(STUBS), name)


def pairs_to_map(tokens: Column) -> Column:
    """Alternating labels and values as a map; a label without value is left out, the last of equal labels stays."""
    n = F.floor(F.size(tokens) / 2).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    entries = F.transform(at, lambda i: F.struct(F.trim(F.get(tokens, 2 * i)).alias("key"), F.trim(F.get(tokens, 2 * i + 1)).alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, n), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(last)
