"""Dedup, merge, upsert, queue, cascade, reports and graph operators on small tables."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from kalendria.operators import cascade, dedup, graph, knn, queue, reports, upsert
from kalendria.operators import events as ev


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


EVENT = "event_id long, acronym string, name string, series_id long, edition_year int, is_virtual boolean, rank string, description string, notification date, paper_deadline date, notes string, source string, sponsor_names array<string>, superseded_by long"


def event(spark, *recs):
    names = [c.split()[0] for c in EVENT.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in recs], EVENT)


def test_upsert_policies(spark):
    old = event(spark, {"event_id": 1, "acronym": "A", "series_id": 9, "rank": "A*", "notes": "kept", "source": "s1", "sponsor_names": ["x"]}, {"event_id": 2, "acronym": "B", "notes": "", "source": "s1"})
    new = event(spark, {"event_id": 1, "acronym": "A2", "series_id": 8, "notes": "new", "source": "s2", "sponsor_names": []}, {"event_id": 3, "acronym": "C", "series_id": 7, "source": "s3"}, {"event_id": 2, "acronym": "B", "rank": "B", "notes": "late"})
    got = {r["event_id"]: r for r in upsert.upsert_events(old, new, F.current_timestamp()).collect()}
    assert (got[1]["acronym"], got[1]["series_id"], got[1]["rank"], got[1]["notes"], got[1]["source"], got[1]["sponsor_names"]) == ("A2", 9, "A*", "kept", "s1", [])
    assert (got[2]["rank"], got[2]["notes"]) == ("B", "late") and (got[3]["series_id"], got[3]["notes"]) == (7, "")
    assert len(got) == 3


def test_entities_and_links(spark):
    t = spark.createDataFrame([(1, "Ann", "a@x"), (4, "Bob", None)], "person_id long, full_name string, email string")
    b = spark.createDataFrame([(1, "Ann B", None), (0, "New", "n@x"), (-1, "Newer", None)], "person_id long, full_name string, email string")
    got = {r["full_name"]: (r["person_id"], r["email"]) for r in upsert.upsert_entities(t, b, "person_id", ["full_name"]).collect()}
    assert got["Ann B"] == (1, "a@x") and got["Bob"] == (4, None) and {got["New"][0], got["Newer"][0]} == {5, 6}
    links = spark.createDataFrame([(1, 1, "chair")], "event_id long, person_id long, role string")
    assert upsert.insert_absent(links, links.union(spark.createDataFrame([(1, 2, "chair")] * 2, links.schema)), ["event_id", "person_id", "role"]).count() == 2


def test_merge_keeps_all_it_can(spark):
    e = event(spark, {"event_id": 1, "is_virtual": False, "notes": "w"}, {"event_id": 2, "is_virtual": True, "rank": "A", "notes": "l", "sponsor_names": ["s"]}, {"event_id": 3, "rank": "C"})
    pairs = spark.createDataFrame([(1, 2)], "winner long, loser long")
    got = {r["event_id"]: r for r in dedup.merge_pairs(e, pairs, "why", F.current_timestamp()).collect()}
    assert (got[1]["is_virtual"], got[1]["rank"], got[1]["sponsor_names"], got[1]["superseded_by"]) == (False, "A", ["s"], None)
    assert got[1]["notes"] == "w\n--- merged from 2 ---\nl"
    assert got[2]["superseded_by"] == 1 and got[2]["notes"] == "l\n[superseded by 1: why]" and got[3]["rank"] == "C"
    with pytest.raises(Exception, match="superseded already"):
        dedup.merge_pairs(dedup.merge_pairs(e, pairs, "why", F.current_timestamp()), pairs, "again", F.current_timestamp()).collect()
    with pytest.raises(Exception, match="are the same"):
        dedup.merge_pairs(e, spark.createDataFrame([(1, 1)], pairs.schema), "x", F.current_timestamp()).collect()


def test_rerouted_links_drop_collisions(spark):
    links = spark.createDataFrame([(1, 5, "chair"), (2, 5, "chair"), (2, 6, "pc"), (2, None, "pc"), (3, 7, "pc")], "event_id long, person_id long, role string")
    moves = spark.createDataFrame([(2, 1)], "loser long, winner long")
    assert rows(dedup.reroute(links, moves, ["person_id", "role"])) == sorted([(1, 5, "chair"), (1, 6, "pc"), (1, None, "pc"), (3, 7, "pc")], key=repr)


def test_sweep_is_greedy_in_pair_order(spark):
    standing = spark.createDataFrame([(i, 0.9 if i == 2 else 0.5, datetime(2025, 1, 1)) for i in range(1, 8)], "event_id long, confidence double, scraped_at timestamp")
    pairs = spark.createDataFrame([(1, 2, True, False, 0.99), (1, 3, True, False, 0.98), (2, 3, True, False, 0.95), (4, 5, False, True, None), (6, 7, True, True, 0.5)], "a long, b long, is_ann boolean, is_acronym boolean, cosine double")
    v = {(r["a"], r["b"]): (r["verdict"], r["winner"], r["reason"]) for r in dedup.sweep(pairs, standing).collect()}
    assert v == {(1, 2): ("merge", 2, "sweep"), (1, 3): ("skip", 1, None), (2, 3): ("pending", 2, "sweep"), (4, 5): ("pending", 4, "acronym_match"), (6, 7): ("pending", 6, "sweep")}
    assert tuple(dedup.sweep_report(dedup.sweep(pairs, standing)).first()) == (5, 1, 3)
    chain = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "loser long, winner long")
    assert rows(dedup.resolved(chain)) == [(1, 3), (2, 3), (5, 6)]


def test_acronym_blocks(spark):
    e = spark.createDataFrame([(1, "ICML 2025", 2025), (2, "ICML-2025", 2025), (3, "The ICML", 2025), (4, "ICML", 2024), (5, "", 2025), (6, "", 2025)], "event_id long, acronym string, edition_year int")
    assert rows(dedup.acronym_pairs(e)) == [(1, 2), (1, 3), (2, 3)]


def test_neighbours_are_exact_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK", 7)
    m = np.random.default_rng(1).integers(-3, 4, (40, 4)).astype(float)
    m[5] = 0
    m[9] = m[8]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "event_id long, vec array<float>")
    with np.errstate(invalid="ignore", divide="ignore"):
        u = m / np.linalg.norm(m, axis=1, keepdims=True)
    c = u @ u.T
    want = set()
    for i in range(40):
        near = sorted((-round(c[i, j], 9), j) for j in range(40) if j != i and c[i, j] >= 0.3)[:3]
        want |= {(i, j, r + 1) for r, (_, j) in enumerate(near)}
    got = knn.self_neighbours(df, 3, 0.3).withColumn("cosine", F.round("cosine", 9))
    again = {(r["id"], r["neighbour_id"]) for r in got.collect()}
    by = {}
    for i, j, _ in want:
        by.setdefault(i, []).append(round(c[i, j], 6))
    mine = {}
    for i, j in again:
        mine.setdefault(i, []).append(round(c[i, j], 6))
    assert {k: sorted(v) for k, v in by.items()} == {k: sorted(v) for k, v in mine.items()}
    best = {r["query_id"]: round(r["cosine"], 6) for r in knn.best_neighbour(df.filter("event_id in (1, 8)"), df).collect()}
    assert best == {i: round(max(c[i, j] for j in range(40) if j not in (i, 5)), 6) for i in (1, 8)}
    with pytest.raises(ValueError):
        knn.neighbours(df, [1.0], 3, dim=4)


def test_thresholds_on_built_vectors(spark):
    cosines = {1: 0.99995, 2: 0.95, 3: 0.85, 4: 0.30}
    df = spark.createDataFrame([(i, [1.0, (1 - t * t) ** 0.5 / t]) for i, t in cosines.items()], "event_id long, vec array<double>")
    got = knn.neighbours(df, [1.0, 0.0], 4).withColumn("v", knn.verdict(F.col("cosine")))
    assert [(r["event_id"], r["v"]) for r in got.collect()] == [(1, "duplicate"), (2, "pending"), (3, "new"), (4, "new")]


REQ = "url string, tier int, priority double, ts timestamp"


def test_queue_gate_order_and_leases(spark):
    t = lambda d, s=0: datetime(2025, 1, d, 0, 0, s)
    req = spark.createDataFrame([("http://A.org/x/", 1, 0.0, t(1)), ("http://a.org/x", 1, 0.0, t(2)), ("http://a.org/y", 1, 10.0, t(3)), ("http://a.org/z", 1, 0.0, t(1, 5))], REQ)
    j = queue.jobs(req)
    assert j.count() == 3 and queue.jobs(req, gate=False).count() == 4
    later = spark.createDataFrame([("http://a.org/x", 1, 0.0, datetime(2025, 3, 1))], REQ)
    assert queue.jobs(req.union(later)).count() == 4
    assert [r["canonical"] for r in queue.pop_order(j).orderBy("pop").collect()] == ["http://a.org/y", "http://a.org/x", "http://a.org/z"]
    now = F.lit("2025-02-01 00:00:00").cast("timestamp")
    got = queue.pop(j.withColumn("attempts", F.lit(0)), 1, 2, now)
    assert [r["attempts"] for r in got.collect()] == [1, 1] and queue.remaining(j, got).count() == 1
    assert queue.requeue(got, now, expired_only=True).count() == 0 and queue.requeue(got, now).count() == 2
    assert {r["destination"] for r in queue.fail(got, "x").collect()} == {"dead"}
    assert {r["destination"] for r in queue.fail(got, "x", F.lit(4)).collect()} == {"tier4"}
    with pytest.raises(Exception, match="escalation only"):
        queue.fail(got, "x", F.lit(2)).collect()
    with pytest.raises(Exception, match="no such tier"):
        queue.jobs(req.withColumn("tier", F.lit(99))).collect()


def test_rate_gate(spark):
    ts = [0, 3, 5, 8, 10]
    r = spark.createDataFrame([(i, "http://h.org/a", datetime.fromtimestamp(s)) for i, s in enumerate(ts)], "seq int, url string, ts timestamp")
    assert [x["allowed"] for x in queue.rate_gate(r, 5).orderBy("seq").collect()] == [True, False, True, False, True]


def test_cascade_routes(spark):
    raw = spark.createDataFrame(
        [(1, 0, '{"is_cfp": true, "confidence": 0.9, "categories": ["AI", "x"]}'), (2, 0, "{'is_cfp': true, 'confidence': 0.5,}"), (3, 0, '{"is_cfp": false, "confidence": 1}'), (4, 0, "bad"), (4, 1, "worse"), (5, 0, "bad"), (5, 1, '{"is_cfp": "yes", "confidence": "0.86"}')],
        "record_id int, attempt int, raw string",
    )
    a = cascade.answers(raw, ["record_id"])
    f = cascade.tier1_fields(F.col("parsed"))
    got = a.select("record_id", cascade.tier1_route(f["is_cfp"], f["confidence"], F.col("failed")).alias("route"), cascade.tier1_reason(f["is_cfp"], f["confidence"], F.col("failed")).alias("why"))
    assert rows(got) == [(1, "tier2", None), (2, "escalate_2", "low_confidence"), (3, "audit_only", None), (4, "escalate_2", "json_parse_fail"), (5, "tier2", None)]


def test_rounds_take_the_least_confidence(spark):
    j = lambda c: f'{{"confidence": {c}}}'
    recs = [(1, r, 0, j(c)) for r, c in ((1, 0.95), (2, 0.92), (3, 0.99), (4, 0.97))] + [(1, 4, 0, "bad"), (1, 5, 0, '{"severity": "ok"}'), (2, 1, 0, j(0.95)), (2, 5, 0, '{"severity": "block"}'), (3, 1, 0, j(0.55)), (3, 5, 0, "{}")]
    raw = spark.createDataFrame([(a, b, i, c, d) for i, (a, b, c, d) in enumerate(recs)], "record_id int, round int, part int, attempt int, raw string")
    got = cascade.tier2_rounds(cascade.answers(raw, ["record_id", "round", "part"]))
    assert rows(got.select("record_id", "confidence", "route", "reason")) == [(1, 0.92, "persist", None), (2, 0.95, "escalate_4", "quality_block"), (3, 0.55, "escalate_3", "low_confidence")]
    people = spark.createDataFrame([(1, '{"people": [{"full_name": " Ann "}, {"full_name": "Bob"}]}'), (2, "{}")], "record_id int, j string").select("record_id", F.try_parse_json("j").alias("parsed"))
    assert rows(cascade.fan_out(people, "people", ["full_name"])) == [(1, "Ann"), (1, "Bob")]
    e = people.select(*cascade.to_event(F.try_parse_json(F.lit('{"acronym": "X", "start_date": "2025-02-03", "categories": ["AI", "zz"], "raw_tags": [" a ", ""]}')))).first()
    assert (e["acronym"], e["name"], str(e["start_date"]), e["categories"], e["raw_tags"], e["sponsor_names"]) == ("X", "UNKNOWN", "2025-02-03", ["AI"], ["a"], [])


def test_reports(spark, tmp_path):
    recs = [(1, "A 2026", "n" * 80, ["AI", "ML"], "May 3, 2026 - May 4, 2026", "Mumbai, India", "N/A", "http://x"), (2, "B", "b", ["AI"], "Jan 1, 2026", "London, UK", "", ""), (3, "C", "c", ["ML"], "TBD", "", "x", "")]
    r = spark.createDataFrame(recs, "ordinal int, acronym string, name string, categories array<string>, when string, where string, deadline string, url string").withColumn("category", F.array_join("categories", ", "))
    names = reports.write_reports(r, str(tmp_path), "2026-04-25")
    assert names == ["ai.md", "by_date.md", "europe.md", "india.md", "ml.md", "singapore.md", "switzerland.md", "uk.md", "usa.md"]
    ai = (tmp_path / "ai.md").read_text()
    assert ai.startswith("# AI — Artificial Intelligence\n\n> Last updated: **2026-04-25**  |  Upcoming: **1**  |  Past: **1**  |  Total: **2**\n\n## Upcoming (1)\n\n| Acronym | Conference |")
    assert f"| A 2026 | {'n' * 70} | May 3, 2026 - May 4, 2026 | Mumbai, India | N/A | [↗](http://x) |" in ai
    assert "_No past conferences found._" in (tmp_path / "usa.md").read_text()
    assert "### Maharashtra" in (tmp_path / "india.md").read_text() and "_None._" in (tmp_path / "india.md").read_text()
    by = (tmp_path / "by_date.md").read_text()
    assert by.index("| A 2026 |") < by.index("| C |") < by.index("| B |")


def test_listing_merge_and_models(spark):
    rs = [(1, "A", "AI", ["k1"], "w", "u1"), (2, "A2", "ML", ["k0"], "w", "u1"), (3, "A3", "L", ["k1"], "w", "u1"), (4, "B", "X", [], "w", ""), (5, "B", "Y", [], "w", None)]
    r = spark.createDataFrame(rs, "o int, acronym string, category string, keywords array<string>, when string, url string").withColumns({"name": F.lit(""), "where": F.lit(""), "deadline": F.lit("")})
    got = {x["key"]: (x["acronym"], x["keywords"], x["category"]) for x in ev.merge_listings(r, "o").collect()}
    assert got == {"u1": ("A", ["k0", "k1"], "AI, ML"), "B|w": ("B", [], "X, Y")}
    have = spark.createDataFrame([(0, "m:4b-q8"), (1, "m:4b-q4"), (2, "e:latest")], "ordinal int, model string")
    need = spark.createDataFrame([("fast",), ("e:latest",), ("zz",)], "name string")
    alias = spark.createDataFrame([("fast", "m:4b")], "name string, target string")
    assert rows(ev.resolve_model(need, alias, have)) == [("e:latest", "e:latest"), ("fast", "m:4b-q8"), ("zz", "zz")]
    pulled = spark.createDataFrame([("e:latest",)], "pulled string")
    want = spark.createDataFrame([("e",), ("q",)], "name string")
    assert rows(ev.available_models(want, pulled)) == [("e",)] and rows(ev.missing_models(want, pulled)) == [("q",)]


def test_graph(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "child string, parent string")
    assert graph.closure(e).count() == 10 and graph.closure(e, 1).count() == 7
    near = spark.createDataFrame([("x", "y"), ("y", "z")], "a string, b string")
    names = spark.createDataFrame([("x",), ("z",), ("w",)], "name string")
    assert rows(graph.clusters(near, names)) == [("w", "w"), ("x", "x"), ("z", "x")]
    with pytest.raises(ValueError):
        ev.where(names, "1 = 1", {"vec": 1})
