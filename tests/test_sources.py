"""Pages, files, the registry and streams."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from kalendria.sources import files, pages, prompts
from kalendria.streaming import queue_stream, windows

LISTING = """<html><table><tr><td>nav</td></tr></table><table><tr><th>Event</th><th>When</th><th>Where</th><th>Deadline</th></tr>
<tr><td rowspan=2><a href="/cfp/servlet/event.showcfp?eventid=11">AB 2026</a></td><td colspan=3>A big event</td></tr>
<tr><td>Mar 3, 2026 - Mar 5, 2026<td>Paris, France<td>Dec 1, 2025 (Nov 1, 2025)</tr>
<tr><td></td></tr><tr><td>no link</td></tr>
<tr><td><a href="http://x.org/?eventid=12">Конференция</a></td><td>по системам</td></tr><tr><td>Mar 3, 2026</td><td>M</td><td>Dec 1, 2025</td></tr>
<tr><td><a href="http://x.org/?eventid=13">CD</a></td><td>Last one</td></tr></table>"""


def test_listing_pages(spark):
    got = {r["event_id"]: r for r in pages.listings(spark.createDataFrame([("u", LISTING), ("v", "<p>none</p>"), ("w", None)], "url string, html string"), date(2026, 1, 1)).collect()}
    assert set(got) == {11, 13}
    a = got[11]
    assert (a["acronym"], a["name"], a["where_raw"], a["edition_year"]) == ("AB 2026", "A big event", "Paris, France", 2026)
    assert (a["start_date"], a["end_date"], a["paper_deadline"], a["abstract_deadline"]) == (date(2026, 3, 3), date(2026, 3, 5), date(2025, 12, 1), date(2025, 11, 1))
    assert a["origin_url"].startswith("http://www.wikicfp.com/cfp") and got[13]["when_raw"] == ""


def test_detail_pages_and_tools(spark):
    html = """<div class="cfp">Call for papers text</div><table><tr><td>Link: <a href="https://ev.org">https://ev.org</a></td></tr>
    <tr><td><b>When</b> <i>Mar 3, 2026</i> <b>Where</b> <i>Rome</i> <b>Submission Deadline</b> <i>Dec 1, 2025</i> <b>Notification Due</b> <i>TBD</i> <b>Categories</b> <i>ai, ml</i></td></tr></table>
    <h1 id="t">Title</h1><table><tr><td>Venue</td><td>Hall <b>1</b></td></tr></table><dl><dt>Fee</dt><dd>free</dd></dl><p class="x y">an online event</p>"""
    df = spark.createDataFrame([("http://s/?eventid=5", html)], "url string, html string")
    d = pages.details(df, date(2026, 1, 1)).first()
    assert (d["event_id"], d["official_url"], d["where_raw"], d["paper_deadline"], d["notification"], d["raw_tags"], d["description"]) == (5, "https://ev.org", "Rome", date(2025, 12, 1), None, ["ai", "ml"], "Call for papers text")
    h = F.col("html")
    got = df.select(pages.selected_text(h, "h1#t, p.x"), pages.labelled_field(h, "venue"), pages.labelled_field(h, "fee"), pages.links(h, "EV"), pages.links(h, "("), pages.page_kind(F.col("url")), pages.visible_text(h)).first()
    assert tuple(got)[:6] == ("Title an online event", "Hall 1", "free", ["https://ev.org"], [], "detail") and "online" in got[6]


def test_crawl_stops_at_the_first_empty_page(spark):
    rs = [("k", 1, "a"), ("k", 1, "a"), ("k", 2, None), ("k", 3, "b"), ("l", 1, "a"), ("l", 9, "z")]
    got = pages.crawled(spark.createDataFrame(rs, "keyword string, page int, url string"), 5)
    assert sorted(tuple(r) for r in got.collect()) == [("k", 1, "a"), ("l", 1, "a")]


def test_seed_json(spark, tmp_path):
    p = tmp_path / "latest.json"
    p.write_text('[{"acronym": " AB ", "name": "", "category": "AI, ml", "keywords": ["k"], "when": "Mar 3, 2026 - Mar 5, 2026", "where": "N/A", "deadline": "TBD", "url": "http://x?eventid=7"}, {"acronym": "No", "url": "http://x"}]')
    got = files.seed_events(files.read_seed_json(spark, str(p)), "s").collect()
    assert len(got) == 1 and (got[0]["event_id"], got[0]["acronym"], got[0]["name"], got[0]["categories"], got[0]["end_date"], got[0]["paper_deadline"]) == (7, "AB", "AB", ["AI", "ML"], date(2026, 3, 5), None)
    p.write_text('{"a": 1}')
    with pytest.raises(ValueError):
        files.read_seed_json(spark, str(p))


def test_yaml_deadlines(spark):
    y = "- title: AB\n  year: 2026\n  deadline: {paper: 2025-12-01, abstract: 2025-11-01}\n  sub: ML\n- name: CD\n  deadline: '2025-10-01 23:59:59'\n  place: Rome\n- 5\n"
    got = {r["acronym"]: r for r in files.yaml_deadlines(spark.createDataFrame([(y,)], "value string"), date(2026, 1, 1)).collect()}
    assert (got["AB"]["paper_deadline"], got["AB"]["abstract_deadline"], got["AB"]["raw_tags"], got["AB"]["edition_year"]) == (date(2025, 12, 1), date(2025, 11, 1), ["ML"], 2026)
    assert (got["CD"]["paper_deadline"], got["CD"]["where_raw"], got["CD"]["edition_year"]) == (date(2025, 10, 1), "Rome", None) and "deadline" not in got["CD"].asDict()


REG = """# CATEGORIES
CATEGORY: AI
KEYWORD: agentic AI
URL: http://s/ai
```
KEYWORD: fenced
```
INDEX_SERIES: A
URL: http://s/a
# KNOWN PARSERS
PARSER: x.org -> p.x
PARSER: a.x.org -> p.ax
# EXTERNAL DATA SOURCES
URL: http://e/1
# LLM SYSTEM PROMPTS
PROMPT_A: |
  line one

    indented
PROMPT_B: |
  b
"""


def test_registry(spark, tmp_path):
    r = prompts.parse_registry(REG)
    assert r.prompts == {"PROMPT_A": "line one\n\n  indented", "PROMPT_B": "b"} and r.keywords == [("AI", "agentic AI")]
    assert r.seeds == [("http://s/ai", "category", "AI", None), ("http://s/a", "series_index", None, "A")] and r.external == ["http://e/1"]
    assert [r.parser_for(h) for h in ("b.a.x.org", "X.org", "ax.org")] == ["p.ax", "p.x", None]
    assert {k: v.count() for k, v in r.tables(spark).items()} == {"prompts": 2, "keywords": 1, "seed_urls": 2, "parsers": 2, "external_urls": 1}
    for bad, why in (("\tx", "tabs forbidden"), ("CATEGORY: Zz\n", "unknown category"), ("KEYWORD: x\n", "orphan KEYWORD"), ("URL: http://x\n", "orphan URL"), ("PROMPT_A: |\n  x\nPROMPT_A: |\n  y\n", "duplicate prompt")):
        with pytest.raises(prompts.RegistryError, match=why):
            prompts.parse_registry(bad)
    p = tmp_path / "r.md"
    p.write_text(REG)
    assert prompts.load_registry(p) is prompts.load_registry(p)


def test_tables_sinks_and_state(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pgt LOCATION '{tmp_path}/wh'")
    assert files.create_tables(spark, "pgt") == files.create_tables(spark, "pgt")
    assert files.query(spark, "SELECT count(*) AS n FROM pgt.events WHERE event_id > :x", x=1).first()["n"] == 0
    spark.sql("DROP DATABASE pgt CASCADE")
    r = spark.createDataFrame([(1, ["a", "b"])], "event_id long, keywords array<string>")
    files.write_csv(r, f"{tmp_path}/c")
    assert spark.read.csv(f"{tmp_path}/c", header=True).first()["keywords"] == "a; b"
    files.save_state({"t": r}, f"{tmp_path}/s")
    assert files.load_state(spark, ["t"], f"{tmp_path}/s")["t"].count() == 1
    files.swap_in(r.union(r), f"{tmp_path}/s/t")
    assert spark.read.parquet(f"{tmp_path}/s/t").count() == 2


def test_embedding_batches(spark):
    rows = spark.createDataFrame([(i, f"t{i % 3}") for i in range(10)], "event_id long, text string")
    got = files.embed(rows, lambda ts: [[float(len(t)), float(t[1])] for t in ts], 2).collect()
    assert len(got) == 10 and all(r["vec"][1] == r["event_id"] % 3 for r in got)


def test_streamed_queue_and_windows(spark, tmp_path):
    req = spark.createDataFrame([("http://A.org/x/", 0.0, datetime(2025, 1, 1)), ("http://a.org/x", 0.0, datetime(2025, 1, 2)), ("http://a.org/bad", 5.0, datetime(2025, 1, 1))], "url string, priority double, ts timestamp")
    req.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(req.schema).parquet(f"{tmp_path}/in")
    handle = lambda b: b.withColumn("failure_reason", F.when(F.col("canonical").contains("bad"), "fetch"))
    q = queue_stream.worker(queue_stream.admitted(stream), handle, f"{tmp_path}/done", f"{tmp_path}/failed", f"{tmp_path}/cp")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/done").count() == 1 and spark.read.parquet(f"{tmp_path}/failed").count() == 1
    e = spark.createDataFrame([(datetime(2025, 1, 1, 0, 10), 1, 1.0), (datetime(2025, 1, 1, 0, 50), 1, 2.0), (datetime(2025, 1, 1, 3), 1, 4.0)], "ts timestamp, user_id int, value double")
    e.write.parquet(f"{tmp_path}/ev")
    s = windows.tumbling(windows.watermarked(spark.readStream.schema(e.schema).parquet(f"{tmp_path}/ev"), "10 minutes"), "1 hour")
    w = s.writeStream.format("memory").queryName("wins").outputMode("complete").trigger(availableNow=True).start()
    w.awaitTermination(120)
    assert sorted((r["n"], r["total"]) for r in spark.table("wins").collect()) == [(1, 4.0), (2, 3.0)]
    assert windows.sessions(e, "1 hour", ["user_id"]).count() == 2 and windows.sliding(e, "1 hour", "30 minutes").count() == 5
