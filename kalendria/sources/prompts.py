"""The registry file: prompts, categories with their keywords, seed links, parsers and external links, as small tables."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from kalendria.functions.wordlists import CATEGORIES

# The headings that change what a link belongs to, and the keys.
SECTIONS = {"EXTERNAL DATA SOURCES": "external", "KNOWN PARSERS": None, "LLM SYSTEM PROMPTS": None, "CONFERENCE SERIES INDEX": "", "JOURNAL & BOOK SERIES INDEX": "", "ADD YOUR PROMPTS": ""}
KEY = re.compile(r"^([A-Z][A-Z0-9_]*):\s*(.*?)\s*$")


class RegistryError(ValueError):
    """The file breaks its grammar; the message names the line."""


@dataclass
class Registry:
    prompts: dict[str, str] = field(default_factory=dict)
    keywords: list[tuple[str, str]] = field(default_factory=list)
    categories: list[str] = field(default_factory=list)
    seeds: list[tuple[str, str, str | None, str | None]] = field(default_factory=list)
    parsers: list[tuple[str, str, int]] = field(default_factory=list)
    external: list[str] = field(default_factory=list)

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        make = lambda rows, schema: spark.createDataFrame(rows, schema)
        return {
            "prompts": make(list(self.prompts.items()), "name string, body string"),
            "keywords": make(self.keywords, "category string, keyword string"),
            "seed_urls": make(self.seeds, "url string, kind string, category string, letter string"),
            "parsers": make(self.parsers, "domain string, module string, ordinal int"),
            "external_urls": make([(u,) for u in self.external], "url string"),
        }

    def parser_for(self, host: str) -> str | None:
        """Module of the longest domain that the host is or lies under; the first of equals."""
        host = host.lower().strip()
        fits = [(len(d), -i, m) for d, m, i in self.parsers if host == d.lower() or host.endswith("." + d.lower())]
        return max(fits)[2] if fits else None


def parse_registry(text: str) -> Registry:
    """Lines are keys with values; a prompt's body is the indented block behind its key; fenced blocks are left out."""
    if "\t" in text:
        raise RegistryError("tabs forbidden: use two spaces")
    out, owner, body, fenced = Registry(), None, None, False
    for number, line in enumerate([*text.splitlines(), "END:"], 1):
        if line.strip().startswith("```"):
            fenced = not fenced
            continue
        if fenced and line != "END:":
            continue
        heading = next((h for h in SECTIONS if h in line), None)
        if body is not None:
            if heading is None and (line.startswith("  ") or not line):
                body[1].append(line[2:])
                continue
            name, lines = body
            if name in out.prompts:
                raise RegistryError(f"duplicate prompt: {name}")
            out.prompts[name] = "\n".join(lines).rstrip("\n")
            body = None
        if heading is not None:
            if SECTIONS[heading] != "":
                owner = ("external", None) if SECTIONS[heading] else None
            elif owner == ("external", None) and "INDEX" in heading:
                owner = None
            continue
        if line.lstrip().startswith("#") or not (m := KEY.match(line)):
            continue
        key, value = m.groups()
        if key.startswith("PROMPT_") and value == "|":
            body = (key, [])
        elif key == "CATEGORY" and value:
            if value not in CATEGORIES:
                raise RegistryError(f"unknown category: {value} (line {number})")
            owner = ("category", value)
            out.categories += [value] if value not in out.categories else []
        elif key == "KEYWORD" and value:
            if not owner or owner[0] != "category":
                raise RegistryError(f"orphan KEYWORD at line {number}")
            out.keywords.append((owner[1], value))
        elif key in ("INDEX_SERIES", "INDEX_JOURNAL") and re.fullmatch("[A-Z]", value):
            owner = ("series_index" if key == "INDEX_SERIES" else "journal_index", value)
        elif key == "URL" and re.fullmatch(r"\S+", value):
            if not owner:
                raise RegistryError(f"orphan URL at line {number}: {value}")
            if owner[0] == "external":
                out.external.append(value)
            else:
                is_cat = owner[0] == "category"
                out.seeds.append((value, owner[0], owner[1] if is_cat else None, None if is_cat else owner[1]))
        elif key == "PARSER" and (p := re.fullmatch(r"(\S+)\s+->\s+(\S+)", value)):
            out.parsers.append((*p.groups(), len(out.parsers)))
    return out


_SEEN: dict[Path, tuple[int, Registry]] = {}


def load_registry(path: str | Path) -> Registry:
    """Parsed once for each state of the file."""
    p = Path(path).resolve()
    try:
        state = p.stat().st_mtime_ns
    except OSError as e:
        raise RegistryError(f"cannot read {p}") from e
    if _SEEN.get(p, (None,))[0] != state:
        _SEEN[p] = (state, parse_registry(p.read_text(encoding="utf-8")))
    return _SEEN[p][1]
