"""Pages of events, seeds, leases, collapse, candidates, cross-modal search."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from kalendria.operators import dedup, graph, queue, reports
from kalendria.operators import events as ev


def test_event_page(spark):
    cols = "name string, acronym string, is_workshop boolean, categories array<string>, edition_year int, rank string, source string, official_url string, origin_url string, description string, abstract_deadline date, paper_deadline date, notification date, camera_ready date, start_date date, end_date date, where_raw string, submission_system string, sponsor_names array<string>, raw_tags array<string>, notes string"
    full = ("Big", "BG", True, ["AI", "ML"], 2026, "A", "s", "", "http://o", "text", None, date(2026, 1, 2), None, None, date(2026, 5, 1), None, None, None, ["x", "y"], [], "note")
    bare = ("B", "B", False, [], None, None, "s", None, None, None, *[None] * 6, None, None, None, None, None)
    a, b = (r[0] for r in spark.createDataFrame([full, bare], cols).select(reports.event_page()).collect())
    assert a.startswith("# Big (BG)\n\n**Type:** Workshop  \n**Category:** AI, ML  \n**Year:** 2026  \n**Rank:** A  \n**Source:** s  \n**URL:** http://o  \n\n## Description\n\ntext\n")
    assert "| Paper deadline    | 2026-01-02 |\n| Notification      | TBD |" in a and a.endswith("\n## Sponsors\n\n`x`, `y`\n\n## Notes\n\nnote\n") and "## Tags" not in a
    assert "_No description available._" in b and "**Year:** TBD" in b and b.endswith("| Submission system | N/A |\n")


def test_seeds_and_leases(spark):
    s = spark.createDataFrame([("http://a", "category", "AI", None), ("http://b", "series_index", None, "A")], "url string, kind string, category string, letter string")
    x = spark.createDataFrame([("http://c",)], "url string")
    got = {r["url"]: r["metadata"] for r in queue.seeds(s, x).collect()}
    assert got == {"http://a": {"source_block": "category", "category": "AI"}, "http://b": {"source_block": "series_index", "letter": "A"}, "http://c": {"source_block": "external"}}
    first = queue.jobs(queue.seeds(s, x).withColumn("ts", F.lit("2025-01-01").cast("timestamp")))
    twice = queue.jobs(queue.seeds(s, x).withColumn("ts", F.explode(F.array(F.lit("2025-01-01").cast("timestamp"), F.lit("2025-01-02").cast("timestamp")))))
    assert first.count() == twice.count() == 3
    leases = spark.createDataFrame([("j", datetime(2025, 1, 1, 0, 10))], "job_id string, expires timestamp")
    at = F.lit("2025-01-01 00:05:00").cast("timestamp")
    assert queue.extend_lease(leases, "j", at, 600).first()["expires"] == datetime(2025, 1, 1, 0, 15)
    with pytest.raises(Exception, match="lease expired"):
        queue.extend_lease(leases, "j", F.lit("2025-01-02").cast("timestamp"), 600).collect()


def test_collapse_and_candidates(spark):
    e = spark.createDataFrame([(1, None), (2, None)], "event_id long, superseded_by long")
    m = spark.createDataFrame([(2, 1)], "loser long, winner long")
    assert sorted(map(tuple, dedup.collapse(m, e, F.current_timestamp()).collect())) == [(1, None), (2, 1)]
    with pytest.raises(Exception, match="are the same"):
        dedup.collapse(m.select("loser", F.col("loser").alias("winner")), e, F.current_timestamp()).collect()
    n = spark.createDataFrame([(1, 5, 0.95), (1, 6, 0.99), (1, 7, 0.93)], "id long, neighbour_id long, cosine double")
    assert [(r["neighbour_id"], r["reason"]) for r in dedup.ranked_candidates(n, 2).orderBy("n").collect()] == [(6, "ann_top1"), (5, "ann_topk")]
    p = spark.createDataFrame([("ICML 25", "icml", 2025, 2025, date(2025, 1, 1), date(2025, 1, 20), "DE", None)], "a_acronym string, b_acronym string, a_year int, b_year int, a_start date, b_start date, a_country string, b_country string")
    r = dedup.acronym_rules(p).first()
    assert r["same_acronym"] and r["same_year"] and r["dates_fit"] and r["same_country"]
    assert dedup.without(e.select("event_id"), m).count() == 1


def test_cross_modal_and_hops(spark):
    e = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [1.0, 0.1])], "event_id long, vec array<double>")
    ids = spark.createDataFrame([(2,), (3,)], "event_id long")
    assert [r["event_id"] for r in graph.cross_modal(e, ids, [1.0, 0.0]).collect()] == [3, 2]
    ev_ = spark.createDataFrame([(1, "Goa", "A")], "event_id long, state string, acronym string")
    chairs = spark.createDataFrame([(1, 9)], "event_id long, person_id long")
    people = spark.createDataFrame([(9, "Ann", 4)], "person_id long, full_name string, org_id long")
    orgs = spark.createDataFrame([(4, "Uni")], "org_id long, org_name string")
    assert tuple(graph.chairs_by_institution(ev_, chairs, people, orgs).first()) == ("Goa", "A", "Ann", "Uni")
    hosts = spark.createDataFrame([("a.x.org",), ("x.org",), ("yx.org",), (None,)], "host string")
    reg = spark.createDataFrame([("x.org", "m", 0), ("A.x.org", "n", 1), ("x.org", "late", 2)], "domain string, module string, ordinal int")
    assert {r["host"]: r["module"] for r in ev.parser_for_host(hosts, reg).collect()} == {"a.x.org": "n", "x.org": "m", "yx.org": None, None: None}
