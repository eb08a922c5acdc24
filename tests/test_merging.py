"""Composed merges, pre-checks, the first tier's flow, edges and the shell verbs."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from kalendria import cli
from kalendria.operators import graph, knn, merging, queue, worker
from kalendria.plans import scratch

EVENT = "event_id long, rank string, is_virtual boolean, sponsor_names array<string>, notes string, superseded_by long"
def at():
    return F.lit("1998-01-01").cast("timestamp")


def tables(spark, events, people=()):
    return {
        "events": spark.createDataFrame(events, EVENT),
        "event_people": spark.createDataFrame(list(people), "event_id long, person_id long, role string"),
        "tier_runs": spark.createDataFrame([(2, 0.5), (3, 0.6), (None, 0.1)], "event_id long, confidence double"),
        "event_embeddings": spark.createDataFrame([(1,), (2,), (3,)], "event_id long"),
    }


def test_merges_in_order_over_all_tables(spark):
    events = [(1, None, False, None, "one", None), (2, None, True, [], None, None), (3, "A", None, ["x"], "three", None), (4, "B", None, None, "", None)]
    t = tables(spark, events, [(1, 7, "chair"), (2, 7, "chair"), (3, 8, "pc"), (2, None, "pc"), (3, None, "pc")])
    pairs = spark.createDataFrame([(2, 3, 1), (1, 2, 2), (1, 4, 3)], "winner long, loser long, seq int")
    out = merging.merged(t, pairs, "why", at())
    e = {r["event_id"]: r for r in out["events"].collect()}
    assert (e[1]["rank"], e[1]["is_virtual"], e[1]["sponsor_names"], e[1]["superseded_by"]) == ("A", False, [], None)
    assert e[1]["notes"] == "one\n--- merged from 2 ---\n\n--- merged from 3 ---\nthree"
    assert (e[2]["rank"], e[2]["superseded_by"], e[2]["notes"]) == ("A", 1, "\n--- merged from 3 ---\nthree\n[superseded by 1: why]")
    assert (e[3]["superseded_by"], e[4]["superseded_by"], e[3]["notes"]) == (2, 1, "three\n[superseded by 2: why]")
    assert sorted(map(tuple, out["event_people"].collect()), key=repr) == [(1, 7, "chair"), (1, 8, "pc"), (1, None, "pc")]
    assert sorted(map(tuple, out["tier_runs"].collect()), key=repr) == [(1, 0.5), (1, 0.6), (None, 0.1)]
    assert [tuple(r) for r in out["event_embeddings"].collect()] == [(1,)]
    flat = merging.merged(t, pairs, "why", at(), fold=False)["events"].filter("event_id = 1").first()
    assert (flat["rank"], flat["notes"]) == (None, "one")


@pytest.mark.parametrize("pair", [(1, 1, 1), (1, 9, 1), (9, 1, 1), (1, 3, 1), (3, 1, 1)])
def test_merges_that_are_refused(spark, pair):
    t = tables(spark, [(1, None, None, None, None, None), (2, None, None, None, None, None), (3, None, None, None, None, 2)])
    with pytest.raises(Exception, match="same|no such event|superseded"):
        merging.merged(t, spark.createDataFrame([pair], "winner long, loser long, seq int"), "why", at())["events"].collect()


def test_neighbours_of_null_equal_and_absent_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(100, [0.6, 0.8]), (101, None), (102, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "event_id long, vec array<double>")
    got = knn.nearest(df.filter("event_id >= 39"), df, 3, block=8).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["neighbour_id"]))
    assert {q: sorted(v) for q, v in by.items()} == {39: [(1, 0), (2, 1), (3, 2)], 100: [(1, 0), (2, 1), (3, 2)]}
    assert knn.self_neighbours(df, 2, 0.9).count() == 80
    with pytest.raises(ValueError, match="unknown table"):
        knn.labelled(df, "events; drop table events", df)


def test_first_tier_flow(spark):
    listing = '<table><tr><th>Event</th><th>When</th></tr><tr><td><a href="/e?eventid=5">AB</a></td><td>Big</td></tr></table>'
    rows = [("http://a.site.org/cfp/call?x", listing, None), ("http://site.org/?eventid=6", '<div class="cfp">Text</div>', None), ("http://other.org/", "x", None), ("http://site.org/", None, "timeout"), ("http://site.org/r", None, "robots")]
    pages = spark.createDataFrame(rows, "url string, html string, error string")
    registry = spark.createDataFrame([("site.org", "parsers.wikicfp", 0)], "domain string, module string, ordinal int")
    found = worker.dispatched(pages, registry)
    assert sorted(map(tuple, worker.failures(found).collect())) == [("http://other.org/", "tier3", "unknown_site"), ("http://site.org/", "dead", "fetch_timeout"), ("http://site.org/r", "dead", "robots_blocked")]
    assert sorted((r["event_id"], r["snippet"]) for r in worker.candidates(found, date(2026, 1, 1)).collect()) == [(5, "Big"), (6, "Text")]


def test_equal_pages_stay_apart(spark):
    from kalendria.operators.events import parser_for_host

    pages = spark.createDataFrame([("h.x.org", "p"), ("h.x.org", "p"), (None, "q"), ("", "r")], "host string, html string")
    registry = spark.createDataFrame([("X.org", "m", 1), ("h.x.org", "longer", 2)], "domain string, module string, ordinal int")
    assert sorted((r["html"], r["module"]) for r in parser_for_host(pages, registry).collect()) == [("p", "longer"), ("p", "longer"), ("q", None), ("r", None)]


def test_edges_and_payloads(spark):
    t = {"events": spark.createDataFrame([(1, 5, None, True, 9)], "event_id long, series_id long, venue_id long, is_workshop boolean, parent_id long"), "event_people": spark.createDataFrame([(1, 3, "pc chair"), (1, 4, "pc")], "event_id long, person_id long, role string")}
    assert sorted((r["src"], r["type"], r["dst"], r["props"]) for r in graph.stored_edges(t).collect()) == [("1", "CO_LOCATED_WITH", "9", "{}"), ("1", "IS_EDITION_OF", "5", "{}"), ("3", "CHAIRS", "1", '{"role":"pc chair"}')]
    raw = json.dumps({"job_id": "j", "url": "u", "tier": 1, "attempts": 2, "metadata": {"a": "b"}, "enqueued_at": "2026-01-02T03:04:05", "failure_reason": "x"})
    j = spark.range(1).select(queue.decoded(F.lit(raw)).alias("j")).first()["j"]
    assert (j["job_id"], j["attempts"], j["metadata"], str(j["ts"])) == ("j", 2, {"a": "b"}, "2026-01-02 03:04:05")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://h:7077"

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.folder(Session())


def test_shell_verbs(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    (tmp_path / "reg.md").write_text("CATEGORY: AI\nURL: http://s/ai\nURL: http://s/ai/\n# EXTERNAL DATA SOURCES\nURL: http://e/1\n")
    args = ["enqueue-seeds", str(tmp_path / "reg.md"), str(tmp_path / "queue"), "--as-of", "2026-01-01"]
    assert cli.main(args) == 0 and "enqueued 2 new" in capsys.readouterr().out
    assert cli.main(args) == 0 and "enqueued 0 new" in capsys.readouterr().out
    (tmp_path / "models.json").write_text('{"small": ["a", "b"]}')
    assert cli.main(["list-models", str(tmp_path / "models.json"), "small"]) == 0 and capsys.readouterr().out.strip() == "a b"
    assert cli.main(["doctor", "--database", "none_such", "--all", "--models", str(tmp_path / "models.json"), "--machine", "small", "--pulled", "a:1", "b"]) == 1
    out = capsys.readouterr().out
    assert "tables     FAIL" in out and "models     OK" in out
    ev = spark.createDataFrame([(1, "AB 2025", 2025, None, "n"), (2, "AB-2025", 2025, None, None), (3, "CD", 2025, None, None)], "event_id long, acronym string, edition_year int, superseded_by long, notes string").withColumn("scraped_at", at())
    ev.write.parquet(str(tmp_path / "ev"))
    spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0])], "event_id long, vec array<double>").write.parquet(str(tmp_path / "emb"))
    assert cli.main(["dedup-sweep", str(tmp_path / "ev"), str(tmp_path / "emb"), "--out", str(tmp_path / "out"), "--as-of", "2026-01-01"]) == 0
    assert {r["event_id"]: r["superseded_by"] for r in spark.read.parquet(str(tmp_path / "out/events")).collect()} == {1: None, 2: 1, 3: None}
    assert spark.read.parquet(str(tmp_path / "out/event_embeddings")).count() == 2


def test_report_lines_are_those_of_the_reports(spark, tmp_path):
    from pathlib import Path

    from kalendria.operators import reports

    rows = [(i, f"A{i}", f"Name {i}", [["AI"], ["ML", "AI"], []][i % 3], "AI, ML", ["Mar 3, 2026", "Jun 7, 2024 - x", "N/A", None][i % 4], ["Pune, India", "London, UK", "Delhi, India", "Online", "Austin, TX, USA", None][i % 6], "TBD", "" if i % 5 else f"http://e/{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "ordinal long, acronym string, name string, categories array<string>, category string, when string, where string, deadline string, url string")
    reports.write_reports(df, str(tmp_path / "r"), "2026-01-01")
    got = {}
    for r in reports.report_lines(df, "2026-01-01").orderBy("file", "part", "state", "rank").collect():
        got.setdefault(r["file"], []).append(r["line"])
    want = {p.name: p.read_text(encoding="utf-8") for p in Path(tmp_path / "r").iterdir()}
    assert set(got) == set(want)
    for name, text in want.items():
        assert "\n".join(got[name]).rstrip("\n") == text.rstrip("\n"), name
    reports.save_reports(df, str(tmp_path / "s"), "2026-01-01")
    parts = sorted((tmp_path / "s" / "file=ai.md").glob("part-*"))
    assert "".join(p.read_text(encoding="utf-8") for p in parts).rstrip("\n") == want["ai.md"].rstrip("\n")


def test_loose_answers_are_read(spark):
    from kalendria.functions import jsonx

    rows = ["{a: 'x', // why\n 'b': 12, /* no */ c: \"it's http://u\"}", "{'a': \"O'Brien\",}", "{a: 'x' 'y'}", "none"]
    got = spark.createDataFrame([(r,) for r in rows], "raw string").select(jsonx.repaired_json_text(F.col("raw")).alias("j")).collect()
    assert [json.loads(r["j"]) if r["j"] else None for r in got] == [{"a": "x", "b": 12, "c": "it's http://u"}, {"a": "O'Brien"}, None, None]


def test_a_host_that_never_pauses(spark):
    rows = [(i, f"http://h.org/{i}", i) for i in range(0, 50_000, 7)]
    df = spark.createDataFrame(rows, "seq long, url string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = sorted(r["seq"] for r in queue.rate_gate(df, 10.0).filter("allowed").collect())
    want, last = [], None
    for s in range(0, 50_000, 7):
        if last is None or s >= last + 10:
            want.append(s)
            last = s
    assert got == want
