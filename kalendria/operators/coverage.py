"""More of the driver's queries: sources, dates, coercions, queues, entities and merges over rows made from the reference tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kalendria.functions import dates, fetching, jsonx, location, text
from kalendria.operators import cascade, dedup, graph, knn, merging, queue, reports, sessions, upsert
from kalendria.operators import events as ev
from kalendria.operators.catalogue import AS_OF, EV, GREY, ISO, MERGE, NEAR, PLACES, RUNS, as_of, asked, event_view, query, runs, table, text_of, vecs
from kalendria.plans import scratch
from kalendria.sources import files, pages, prompts

DAY = date(1998, 1, 1)
#: A day as ``Mon d, yyyy`` in either engine.
LONG_DAY = "strftime({0}, '%b %-d, %Y')"
c = F.col


def long_day(x):
    return F.date_format(x, "MMM d, yyyy")


def said(*parts):
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def orders(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("cust"), F.to_date("o_orderdate").alias("day"), "o_orderstatus", "o_orderpriority")


# sources --------------------------------------------------------------------


@query(
    "seed_events",
    f"""WITH o AS (SELECT o_orderkey AS k, o_orderdate::DATE AS day FROM orders) SELECT k AS event_id, 'A' || k || CASE WHEN k % 2 = 1 THEN ' 2025' ELSE '' END AS acronym,
    CASE WHEN k % 7 = 0 THEN 'Name' ELSE 'A' || k || CASE WHEN k % 2 = 1 THEN ' 2025' ELSE '' END END AS name, 'AI,ML' AS categories, CASE WHEN k % 4 IN (0, 2) THEN {ISO.format("day")} END AS start_date,
    CASE k % 4 WHEN 0 THEN {ISO.format("day + 2")} WHEN 2 THEN {ISO.format("day")} END AS end_date, CASE WHEN k % 3 <> 0 THEN {ISO.format("day - 60")} END AS paper_deadline,
    CASE WHEN k % 2 = 1 THEN 2025 END AS edition_year FROM o WHERE k % 5 <> 0""",
)
def seed_events(spark, d):
    k, day = c("k"), c("day")
    when = F.when(k % 4 == 0, said(long_day(day), " - ", long_day(F.date_add(day, 2)))).when(k % 4 == 1, "N/A").when(k % 4 == 2, long_day(day)).otherwise("TBA")
    acronym = said("  A", k.cast("string"), F.when(k % 2 == 1, " 2025").otherwise(""), " ")
    records = orders(spark, d).select(
        acronym.alias("acronym"), F.when(k % 7 == 0, "Name").otherwise("").alias("name"), F.lit("ai, ML; none").alias("category"), F.lit(None).cast("array<string>").alias("keywords"), when.alias("when"), F.lit("w").alias("where"),
        F.when(k % 3 == 0, "TBD").otherwise(F.date_format(F.date_sub(day, 60), "yyyy-MM-dd")).alias("deadline"), F.when(k % 5 == 0, "http://x/none").otherwise(said("http://x/?eventid=", k.cast("string"))).alias("url"),
    )
    return files.seed_events(records).select("event_id", "acronym", "name", F.array_join("categories", ",").alias("categories"), *map(text_of, ("start_date", "end_date", "paper_deadline")), "edition_year")


@query(
    "listing_pages",
    f"""WITH o AS (SELECT o_orderkey AS k, o_orderdate::DATE AS day FROM orders), p AS (SELECT *, k % 7 <> 0 AS whole FROM o)
    SELECT k AS event_id, 'A' || k AS acronym, 'Name of ' || k AS name, CASE WHEN whole THEN {LONG_DAY.format("day")} || ' - ' || {LONG_DAY.format("day + 3")} ELSE '' END AS when_raw, CASE WHEN whole THEN 'Paris, France' ELSE '' END AS where_raw,
    CASE WHEN whole THEN {ISO.format("day")} END AS start_date, CASE WHEN whole THEN {ISO.format("day + 3")} END AS end_date, CASE WHEN whole THEN {ISO.format("day - 60")} END AS paper_deadline,
    CASE WHEN whole AND k % 3 <> 0 THEN {ISO.format("day - 90")} END AS abstract_deadline, CASE WHEN whole THEN year(day) ELSE 1998 END::INT AS edition_year, 'http://www.wikicfp.com/e?eventid=' || k AS origin_url FROM p WHERE k % 11 <> 0""",
)
def listing_pages(spark, d):
    k, day = c("k"), c("day")
    id_of = k.cast("string")
    name = F.when(k % 11 == 0, "Конференция по системам").otherwise(said("Name of ", id_of))
    head = said('<tr><td rowspan=2><a href="/e?eventid=', id_of, '">A', id_of, "</a></td><td colspan=3>", name, "</td></tr>")
    due = said(long_day(F.date_sub(day, 60)), F.when(k % 3 != 0, said(" (", long_day(F.date_sub(day, 90)), ")")).otherwise(""))
    facts = said("<tr><td>", long_day(day), " - ", long_day(F.date_add(day, 3)), "<td>Paris, France<td>", due, "</tr>")
    rows = orders(spark, d).select("cust", k, said(head, F.when(k % 7 == 0, "").otherwise(facts)).alias("html"))
    html = said("<table><tr><td>nav</td></tr></table><table><tr><th>Event</th><th>When</th><th>Where</th><th>Deadline</th></tr>", F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "html"))), lambda x: x["html"]), "\n"), "</table>")
    found = pages.listings(rows.groupBy("cust").agg(html.alias("html")).withColumn("url", F.lit("u")), DAY)
    return found.select("event_id", "acronym", "name", "when_raw", "where_raw", *map(text_of, ("start_date", "end_date", "paper_deadline", "abstract_deadline")), "edition_year", "origin_url")


@query(
    "detail_pages",
    f"""WITH o AS (SELECT o_orderkey AS k, o_orderdate::DATE AS day FROM orders WHERE o_orderkey % 5 = 0) SELECT k AS event_id, CASE WHEN k % 2 = 0 THEN 'https://ev' || k || '.org' END AS official_url, {LONG_DAY.format("day")} AS when_raw,
    CASE WHEN k % 3 = 0 THEN '' ELSE 'Rome' END AS where_raw, {ISO.format("day - 60")} AS paper_deadline, NULL::VARCHAR AS notification, 'ai,ml' AS tags, 'Call for papers of ' || k AS description FROM o""",
)
def detail_pages(spark, d):
    k, day = c("k"), c("day")
    id_of = k.cast("string")
    link = F.when(k % 2 == 0, said('<tr><td>Link: <a href="https://ev', id_of, '.org">https://ev', id_of, ".org</a></td></tr>")).otherwise('<tr><td><a href="https://other.org">other</a></td></tr>')
    where = F.when(k % 3 == 0, "").otherwise("<b>Where</b> <i>Rome</i>")
    html = said('<div class="x cfp">Call for <i>papers</i> of ', id_of, "</div><table>", link, "<tr><td><b>When</b> <i>", long_day(day), "</i>", where, "<b>Submission Deadline</b> <i>", long_day(F.date_sub(day, 60)), "</i> <b>Notification Due</b> <i>TBD</i> <b>Categories</b> <i>ai, , ml</i></td></tr></table>")
    found = pages.details(orders(spark, d).filter("k % 5 = 0").select(said("http://s/?eventid=", id_of).alias("url"), html.alias("html")), DAY)
    return found.select("event_id", "official_url", "when_raw", "where_raw", text_of("paper_deadline"), text_of("notification"), F.array_join("raw_tags", ",").alias("tags"), "description")


@query(
    "yaml_deadlines",
    f"""SELECT 'C' || c_custkey AS acronym, CASE WHEN c_custkey % 2 = 0 THEN 'Full ' || c_custkey ELSE 'C' || c_custkey END AS name, 2025 AS edition_year, {ISO.format("DATE '2025-01-01' + (c_custkey % 300)::INT")} AS paper_deadline,
    CASE WHEN c_custkey % 3 = 0 THEN {ISO.format("DATE '2024-12-01' + (c_custkey % 300)::INT")} END AS abstract_deadline, 'P' || c_nationkey AS where_raw, c_mktsegment AS tags FROM customer""",
)
def yaml_deadlines(spark, d):
    k = c("c_custkey")
    id_of, due, early = k.cast("string"), F.date_format(F.date_add(F.lit("2025-01-01").cast("date"), (k % 300).cast("int")), "yyyy-MM-dd"), F.date_format(F.date_add(F.lit("2024-12-01").cast("date"), (k % 300).cast("int")), "yyyy-MM-dd")
    deadline = F.when(k % 3 == 0, said("{paper: ", due, ", abstract: ", early, "}")).otherwise(said("'", due, " 23:59:59'"))
    entry = said("- title: C", id_of, "\n", F.when(k % 2 == 0, said("  full_name: Full ", id_of, "\n")).otherwise(""), "  year: 2025\n  place: P", c("c_nationkey").cast("string"), "\n  sub: ", c("c_mktsegment"), "\n  deadline: ", deadline, "\n")
    docs = table(spark, d, "customer").groupBy(F.pmod(k, F.lit(64)).alias("f")).agg(F.array_join(F.collect_list(entry), "").alias("value"))
    found = files.yaml_deadlines(docs, DAY)
    return found.select("acronym", "name", F.col("edition_year").cast("int").alias("edition_year"), text_of("paper_deadline"), text_of("abstract_deadline"), "where_raw", F.array_join("raw_tags", ",").alias("tags"))


@query(
    "page_dispatch",
    """SELECT page_id, CASE WHEN contains(u, 'eventid=') THEN 'detail' WHEN contains(u, '/cfp/call') OR contains(lower(u), 'search') THEN 'listing' ELSE 'detail' END AS kind, CASE page_id % 3 WHEN 0 THEN 'wikicfp' END AS parser
    FROM (SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '&eventid=3' WHEN 1 THEN '/cfp/call?x' WHEN 2 THEN '&SEARCH=1' ELSE '' END AS u FROM pages)""",
)
def page_dispatch(spark, d):
    k = c("page_id")
    url = said(c("url"), F.when(k % 4 == 0, "&eventid=3").when(k % 4 == 1, "/cfp/call?x").when(k % 4 == 2, "&SEARCH=1").otherwise(""))
    module = F.when(k % 3 == 0, "parsers.wikicfp").when(k % 3 == 1, "parsers.ieee")
    return table(spark, d, "pages").select("page_id", pages.page_kind(url).alias("kind"), fetching.parser_of(module).alias("parser"))


@query(
    "crawled_pages",
    """WITH r AS (SELECT user_id % 20 AS keyword, (event_id % 12)::INT AS page, CASE WHEN event_id % 97 <> 0 THEN event_type || event_id % 40 END AS url FROM events WHERE event_id % 12 <= 8),
    e AS (SELECT keyword, min(page) FILTER (url IS NULL) AS stop FROM r GROUP BY 1) SELECT DISTINCT keyword, url FROM r JOIN e USING (keyword) WHERE url IS NOT NULL AND (stop IS NULL OR page < stop)""",
)
def crawled_pages(spark, d):
    k = c("event_id")
    rows = table(spark, d, "events").select((c("user_id") % 20).alias("keyword"), (k % 12).cast("int").alias("page"), F.when(k % 97 != 0, said(c("event_type"), (k % 40).cast("string"))).alias("url"))
    return pages.crawled(rows, 8).select("keyword", "url")


REGISTRY = """CATEGORY: AI
KEYWORD: agentic AI
KEYWORD: planning
URL: http://s/ai
CATEGORY: ML
KEYWORD: deep nets
INDEX_SERIES: A
URL: http://s/a
# KNOWN PARSERS
PARSER: example.com -> parsers.example
PARSER: x.org -> parsers.x
# EXTERNAL DATA SOURCES
URL: http://e/1
URL: http://e/2
"""


@query(
    "registry_tables",
    """SELECT * FROM (VALUES ('keyword', 'AI', 'agentic AI'), ('keyword', 'AI', 'planning'), ('keyword', 'ML', 'deep nets'), ('seed', 'category', 'http://s/ai'), ('seed', 'series_index', 'http://s/a'),
    ('parser', 'parsers.example', 'example.com'), ('parser', 'parsers.x', 'x.org'), ('request', 'category', 'http://s/ai'), ('request', 'series_index', 'http://s/a'), ('request', 'external', 'http://e/1'), ('request', 'external', 'http://e/2')) AS v(what, a, b)""",
)
def registry_tables(spark, d):
    t = prompts.parse_registry(REGISTRY).tables(spark)
    part = lambda what, df, a, b: df.select(F.lit(what).alias("what"), c(a).alias("a"), c(b).alias("b"))
    asked_for = queue.seeds(t["seed_urls"], t["external_urls"]).withColumn("block", c("metadata")["source_block"])
    out = part("keyword", t["keywords"], "category", "keyword").unionByName(part("seed", t["seed_urls"], "kind", "url"))
    return out.unionByName(part("parser", t["parsers"], "module", "domain")).unionByName(part("request", asked_for, "block", "url"))


def round_trip(df, write, read):
    path = scratch.folder(df.sparkSession)
    write(df, path)
    fs, p = scratch.hadoop_path(df.sparkSession, path)
    fs.deleteOnExit(p)
    return read(path)


@query("csv_sink", "SELECT o_orderkey::VARCHAR AS k, array_to_string(string_split(o_orderpriority, '-'), '; ') AS parts, o_orderstatus AS status FROM orders")
def csv_sink(spark, d):
    rows = table(spark, d, "orders").select(c("o_orderkey").alias("k"), F.split("o_orderpriority", "-").alias("parts"), c("o_orderstatus").alias("status"))
    return round_trip(rows, files.write_csv, lambda p: spark.read.option("header", True).csv(p))


@query("json_sink", "SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance FROM customer")
def json_sink(spark, d):
    rows = table(spark, d, "customer").select(c("c_custkey").alias("k"), c("c_name").alias("name"), c("c_acctbal").alias("balance"))
    return round_trip(rows, lambda df, p: files.write_json(df, p, "19980101"), lambda p: spark.read.schema(rows.schema).json(f"{p}/latest"))


@query("parquet_snapshot", f"WITH {EV} SELECT event_id, {ISO.format('start_date')} AS start_date FROM ev WHERE superseded_by IS NULL")
def parquet_snapshot(spark, d):
    return round_trip(event_view(spark, d), files.export_events, lambda p: spark.read.parquet(p).select("event_id", text_of("start_date")))


@query("state_round_trip", "SELECT s_suppkey AS k, s_acctbal AS v FROM supplier")
def state_round_trip(spark, d):
    rows = table(spark, d, "supplier").select(c("s_suppkey").alias("k"), c("s_acctbal").alias("v"))
    return round_trip(rows, lambda df, p: files.save_state({"suppliers": df}, p), lambda p: files.load_state(spark, ["suppliers"], p)["suppliers"])


@query("embedded_texts", "SELECT doc_id AS event_id, length(text)::DOUBLE AS a, (length(text) - length(replace(text, 'e', '')))::DOUBLE AS b, sha1(text) AS text_hash FROM documents WHERE text IS NOT NULL")
def embedded_texts(spark, d):
    docs = table(spark, d, "documents").filter("text IS NOT NULL").withColumnRenamed("doc_id", "event_id")
    found = files.embed(docs, lambda ts: [[float(len(t)), float(t.count("e"))] for t in ts], 2)
    return found.select("event_id", c("vec")[0].cast("double").alias("a"), c("vec")[1].cast("double").alias("b"), "text_hash")


# dates and coercions --------------------------------------------------------


@query(
    "date_functions",
    f"""WITH {EV}, x AS (SELECT event_id, start_date, paper_deadline, CASE event_id % 4 WHEN 0 THEN {ISO.format("start_date")} WHEN 1 THEN strftime(start_date, '%Y-%-m-%-d') WHEN 2 THEN 'on ' || {ISO.format("start_date")} ELSE '98-01-01' END AS raw FROM ev)
    SELECT event_id, CASE WHEN event_id % 4 < 2 THEN {ISO.format("start_date")} END AS iso, {ISO.format(f"least(CASE WHEN paper_deadline >= DATE '{AS_OF}' THEN paper_deadline END, CASE WHEN start_date >= DATE '{AS_OF}' THEN start_date END)")} AS next,
    coalesce(year(start_date), year(paper_deadline), 1998)::INT AS edition_year, coalesce(abs(start_date - paper_deadline) <= 60, true) AS near FROM x""",
)
def date_functions(spark, d):
    k, start, paper = c("event_id"), c("start_date"), c("paper_deadline")
    iso = F.date_format(start, "yyyy-MM-dd")
    raw = F.when(k % 4 == 0, said("  ", iso, " ")).when(k % 4 == 1, F.date_format(start, "yyyy-M-d")).when(k % 4 == 2, said("on ", iso)).otherwise("98-01-01")
    return event_view(spark, d).select(
        "event_id", F.date_format(dates.iso_date(raw), "yyyy-MM-dd").alias("iso"), F.date_format(dates.next_deadline(as_of(), paper, start), "yyyy-MM-dd").alias("next"), dates.edition_year(start, paper, as_of()).alias("edition_year"), dates.dates_compatible(start, paper, 60).alias("near"),
    )


@query(
    "fuzzy_dates",
    f"""WITH o AS (SELECT o_orderkey AS k, o_orderdate::DATE AS day FROM orders WHERE o_orderkey % 4 = 0) SELECT k, CASE k % 3 WHEN 2 THEN NULL ELSE {ISO.format("day")} END AS fuzzy,
    CASE k % 3 WHEN 0 THEN {ISO.format("day")} WHEN 1 THEN {ISO.format("date_trunc('month', day)")} END AS seed FROM o""",
)
def fuzzy_dates(spark, d):
    k, day = c("k"), c("day")
    one = F.when(k % 3 == 0, said("due on ", F.date_format(day, "d MMMM yyyy"))).when(k % 3 == 1, F.date_format(day, "yyyy-MM-dd HH:mm")).otherwise("TBD")
    two = F.when(k % 3 == 0, long_day(day)).when(k % 3 == 1, F.date_format(day, "MMMM yyyy")).otherwise("n/a")
    iso = lambda x: F.date_format(x, "yyyy-MM-dd")
    return orders(spark, d).filter("k % 4 = 0").select("k", iso(dates.fuzzy_date(one, DAY)).alias("fuzzy"), iso(dates.seed_date(two)).alias("seed"))


@query(
    "coercions",
    """SELECT event_id, event_id % 3 = 0 AS flag, CASE WHEN event_id % 4 <> 1 THEN (event_id % 4)::INT END AS number, CASE WHEN event_id % 2 = 0 THEN event_type END AS word, event_type || ',x' AS listed, CASE WHEN event_id % 5 = 0 THEN 'ML,AI' ELSE '' END AS closed,
    'AI,Data' AS parsed, CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE 'other' END AS choice, '{"a":' || event_id || ',"b":"' || event_type || '","z":null}' AS json, sha1(event_type) AS tag FROM events""",
)
def coercions(spark, d):
    k, e = c("event_id"), c("event_type")
    flag = F.when(k % 3 == 0, F.element_at(F.array(F.lit(" Yes"), F.lit("true"), F.lit("1 "), F.lit("y")), (k % 4 + 1).cast("int"))).otherwise("no")
    closed = F.when(k % 5 == 0, F.array(F.lit("ML"), F.lit("ai"), F.lit("AI"), F.lit("ML"))).when(k % 5 == 1, F.lit(None).cast("array<string>")).otherwise(F.array(F.lit("zz")))
    number = F.when(k % 4 == 1, "many").otherwise(said(" ", (k % 4).cast("string")))
    word = F.when(k % 2 == 0, said(" ", e, " ")).otherwise("  ")
    listed = jsonx.coerce_str_list(F.array(said(" ", e), F.lit(""), F.lit("x "), F.lit(None).cast("string")))
    return table(spark, d, "events").select(
        "event_id", jsonx.coerce_bool(flag).alias("flag"), jsonx.coerce_int(number).alias("number"), jsonx.coerce_str(word).alias("word"), F.array_join(listed, ",").alias("listed"), F.array_join(jsonx.coerce_categories(closed), ",").alias("closed"),
        F.array_join(jsonx.parse_categories(F.lit("ai / DATA; what, AI")), ",").alias("parsed"), jsonx.coerce_choice(said(" ", e), ["view", "click"]).alias("choice"), jsonx.stable_json(b=e, a=k, z=F.lit(None).cast("string")).alias("json"), F.sha1(e).alias("tag"),
    )


@query(
    "html_tools",
    r"""SELECT doc_id, 'Title ' || doc_id AS title, 'Hall ' || doc_id % 9 AS venue, CASE WHEN doc_id % 2 = 0 THEN 'free' ELSE '' END AS fee, doc_id % 3 = 0 AS conference, 'paper' || doc_id % 5 AS paper, CASE WHEN doc_id % 4 = 0 THEN 'abs' || doc_id % 5 END AS abstract FROM documents WHERE doc_id % 4 < 3""",
)
def html_tools(spark, d):
    k = c("doc_id")
    id_of = k.cast("string")
    fee = F.when(k % 2 == 0, "<dl><dt>The Fee:</dt><dd>free</dd></dl>").otherwise("")
    html = said('<h1 id="t">Title ', id_of, "</h1><script>call for papers</script><table><tr><td>Venue</td><td>Hall <b>", (k % 9).cast("string"), "</b></td></tr></table>", fee)
    words = F.when(k % 3 == 0, "A Symposium with a CFP").otherwise("A Symposium")
    cell = said(" paper", (k % 5).cast("string"), F.when(k % 4 == 0, said(" (abs", (k % 5).cast("string"), ")")).otherwise(""))
    paper, abstract = text.deadline_parts(cell)
    rows = table(spark, d, "documents").filter("doc_id % 4 < 3").select("doc_id", html.alias("html"), words.alias("words"), paper.alias("paper"), abstract.alias("abstract"))
    return rows.select("doc_id", pages.selected_text(c("html"), "h1#t").alias("title"), pages.labelled_field(c("html"), "venue").alias("venue"), pages.labelled_field(c("html"), "fee").alias("fee"), text.is_conference_text(c("words")).alias("conference"), "paper", "abstract")


# queue ----------------------------------------------------------------------


def tier_jobs(spark, d):
    return table(spark, d, "events").select(
        c("event_id").alias("job_id"), said("http://h/", c("event_id").cast("string")).alias("url"), (c("user_id") % 4 + 1).cast("int").alias("tier"), F.unix_millis(c("ts").cast("timestamp")).cast("double").alias("score"), c("ts").cast("timestamp").alias("ts"),
        F.lit(0).alias("attempts"), F.create_map(F.lit("t"), c("event_type")).alias("metadata"),
    )


AT = "2024-02-01 00:00:00"
JOBS = "j AS (SELECT event_id AS job_id, (user_id % 4 + 1)::INT AS tier, epoch_ms(ts) AS score, ts FROM events), p AS (SELECT * FROM j WHERE tier = 2 ORDER BY score, job_id LIMIT 40)"


@query(
    "queue_lifecycle",
    f"""WITH {JOBS} SELECT job_id, state, attempts, CASE state WHEN 'failed' THEN CASE WHEN job_id % 3 = 0 THEN 'dead' ELSE 'tier3' END END AS destination, round(CASE state WHEN 'leased' THEN epoch(TIMESTAMP '{AT}') + CASE WHEN first THEN 60 ELSE 600 END WHEN 'back' THEN epoch(TIMESTAMP '{AT}') END, 0) AS at FROM (
      SELECT job_id, 'waiting' AS state, 0 AS attempts, false AS first FROM j WHERE job_id NOT IN (SELECT job_id FROM p) UNION ALL
      SELECT job_id, 'failed', 1, false FROM p UNION ALL SELECT job_id, 'leased', 1, job_id = (SELECT min(job_id) FROM p) FROM p UNION ALL SELECT job_id, 'back', 0, false FROM p)""",
)
def queue_lifecycle(spark, d):
    jobs, at = tier_jobs(spark, d), F.lit(AT).cast("timestamp")
    taken = scratch.table(queue.pop(jobs, 2, 40, at))
    failed = queue.fail(taken, "broken", F.when(c("job_id") % 3 != 0, 3))
    longer = queue.extend_lease(taken, taken.agg(F.min("job_id")).first()[0], at, 60)
    part = lambda df, state, to, when: df.select("job_id", F.lit(state).alias("state"), c("attempts").cast("int").alias("attempts"), to.alias("destination"), when.alias("at"))
    none, never = F.lit(None).cast("string"), F.lit(None).cast("double")
    out = part(queue.remaining(jobs, taken), "waiting", none, never).unionByName(part(failed, "failed", c("destination"), never))
    back = queue.requeue(taken, at)
    return out.unionByName(part(longer, "leased", none, F.unix_timestamp("expires").cast("double"))).unionByName(part(back, "back", none, c("score") / 1000))


@query("dead_letters", f"WITH {JOBS} SELECT job_id, 'broken' AS reason FROM p WHERE job_id % 3 = 0")
def dead_letters(spark, d):
    failed = queue.fail(queue.pop(tier_jobs(spark, d), 2, 40, F.lit(AT).cast("timestamp")), "broken", F.when(c("job_id") % 3 != 0, 3))
    return queue.dead_letters(failed).select("job_id", c("failure_reason").alias("reason"))


@query("job_codec", "SELECT event_id AS job_id, 'http://h/' || event_id AS url, (user_id % 4 + 1)::INT AS tier, event_type AS t, epoch_us(ts) AS us FROM events")
def job_codec(spark, d):
    jobs = tier_jobs(spark, d).select(queue.encoded(tier_jobs(spark, d)).alias("raw"))
    j = jobs.select(queue.decoded(c("raw")).alias("j")).select("j.*")
    return j.select(c("job_id").cast("long").alias("job_id"), "url", "tier", c("metadata")["t"].alias("t"), F.unix_micros("ts").alias("us"))


@query(
    "tier_payloads",
    """SELECT CASE doc_id % 3 WHEN 0 THEN 'queue:tier2' WHEN 1 THEN 'escalate:tier3' ELSE 'dead' END AS list, '{"enqueued_at":"1998-01-01T00:00:00Z","event_id":' || doc_id || CASE WHEN doc_id % 3 <> 0 THEN ',"reason":"low"' ELSE '' END || ',"source_url":"http://s/' || doc_id || '","text":"t' || lang || '"}' AS payload FROM documents""",
)
def tier_payloads(spark, d):
    k = c("doc_id")
    rows = table(spark, d, "documents").select(k.alias("event_id"), said("t", c("lang")).alias("text"), said("http://s/", k.cast("string")).alias("source_url"), F.lit("low").alias("reason"))
    at, id_ = as_of().cast("timestamp"), c("event_id")
    return queue.payloads(rows.filter(id_ % 3 == 0), at).unionByName(queue.payloads(rows.filter(id_ % 3 != 0), at, F.when(id_ % 3 == 1, 3).otherwise(4)))


@query("new_seeds", "SELECT count(*) AS n FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0))")
def new_seeds(spark, d):
    link = lambda k: said("HTTP://Seeds.org:80/", k.cast("string"), "/")
    wanted = table(spark, d, "orders").select(link(c("o_custkey")).alias("url"), F.lit(0.0).alias("priority"))
    known = table(spark, d, "customer").filter("c_custkey % 2 = 0").select(text.canonical_url(link(c("c_custkey"))).alias("canonical"))
    return queue.new_seeds(wanted, known).agg(F.count(F.lit(1)).alias("n"))


# cascade --------------------------------------------------------------------


@query(
    "tier2_rounds",
    """WITH r AS (SELECT doc_id, quality, toxic, doc_id % 6 AS m FROM labels) SELECT doc_id AS record_id, round(CASE WHEN m = 4 THEN 0.9 ELSE least(0.9, CASE WHEN m = 1 THEN 0.5 ELSE 0.95 END, CASE WHEN m <> 2 THEN 0.88 ELSE 0.9 END) END, 4)::DOUBLE AS confidence,
    CASE WHEN m = 4 THEN 'collapse' WHEN m = 5 THEN 'escalate_3' WHEN toxic = 1 THEN 'escalate_4' WHEN m = 1 THEN 'escalate_3' ELSE 'persist' END AS route,
    CASE WHEN m = 4 THEN NULL WHEN m = 5 THEN 'json_parse_fail' WHEN toxic = 1 THEN 'quality_block' WHEN m = 1 THEN 'low_confidence' END AS reason, CASE WHEN m = 4 THEN 7 END AS duplicate_of FROM r""",
)
def tier2_rounds(spark, d):
    m = c("doc_id") % 6
    answer = lambda x: said('Sure: {"confidence": ', x, ",}")
    number = lambda x: F.lit(str(x))
    at = lambda n, attempt, raw: F.struct(F.lit(n).alias("round"), F.lit(attempt).alias("attempt"), (F.lit(raw) if isinstance(raw, str) else raw).alias("raw"))
    rounds = F.array(
        at(1, 0, "no json"),
        at(1, 1, answer(number(0.9))),
        at(2, 0, answer(F.when(m == 1, "0.5").otherwise("0.95"))),
        at(3, 0, F.when(m == 5, "broken").otherwise(answer(number(0.97)))),
        at(4, 0, F.when(m == 2, "broken").otherwise(answer(number(0.88)))),
        at(5, 0, F.when(c("toxic") == 1, '{"severity": "block"}').otherwise("{'severity': \"ok\"}")),
    )
    labels = table(spark, d, "labels")
    raw = labels.select(c("doc_id").alias("record_id"), F.explode(rounds).alias("x")).select("record_id", "x.*")
    parsed = cascade.answers(raw, ["record_id", "round"])
    dup = labels.filter(m == 4).select(c("doc_id").alias("record_id"), F.lit(7).alias("duplicate_of"))
    return cascade.tier2_rounds(parsed, dup).select("record_id", F.round("confidence", 4).alias("confidence"), "route", "reason", "duplicate_of")


@query(
    "typed_events",
    f"""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'UNKNOWN' ELSE 'A' || o_orderkey END AS acronym, 'N' || o_orderstatus AS name, CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate)::INT END AS edition_year, o_orderstatus = 'F' AS is_virtual,
    'AI' AS categories, {ISO.format("o_orderdate")} AS start_date, NULL::VARCHAR AS end_date FROM orders""",
)
def typed_events(spark, d):
    k, day = c("k"), c("day")
    acronym = F.when(k % 3 == 0, "  ").otherwise(said("A", k.cast("string")))
    json = F.to_json(F.struct(acronym.alias("acronym"), said("N", c("o_orderstatus")).alias("name"), F.when(k % 2 == 0, F.date_format(day, "yyyy")).otherwise("soon").alias("edition_year"), F.when(c("o_orderstatus") == "F", "yes").otherwise("no").alias("is_virtual"), F.array(F.lit("AI"), F.lit("Cooking")).alias("categories"), F.date_format(day, "yyyy-MM-dd").alias("start_date"), F.lit("spring").alias("end_date")))
    e = orders(spark, d).select("k", F.try_parse_json(json).alias("p")).select("k", *cascade.to_event(c("p")))
    return e.select("k", "acronym", "name", "edition_year", "is_virtual", F.array_join("categories", ",").alias("categories"), text_of("start_date"), text_of("end_date"))


@query(
    "model_resolution",
    """SELECT * FROM (VALUES ('big', 'qwen-32b', true), ('exact', 'exact', true), ('gone', 'gone', false), ('small', 'small-q4', true), ('tagged', 'tagged', true)) AS v(name, model, there)""",
)
def model_resolution(spark, d):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    needed = make([(n,) for n in ("big", "exact", "gone", "small", "tagged")], "name string")
    found = ev.resolve_model(needed, make([("big", "qwen")], "name string, target string"), make([("qwen-32b", 0), ("qwen-70b", 1), ("exact-7b", 2), ("exact", 3), ("small-q4", 4)], "model string, ordinal int"))
    pulled = make([(p,) for p in ("big", "exact", "small:q4", "tagged:latest")], "pulled string")
    missing = ev.missing_models(needed, pulled).select("name", F.lit(False).alias("there"))
    there = ev.available_models(needed, pulled).select("name")
    return found.join(missing, "name", "left").join(there.withColumn("own", F.lit(True)), "name", "left").select("name", "model", F.coalesce("there", F.lit(True)).alias("there"))


# entities and merges --------------------------------------------------------


@query(
    "entity_upserts",
    """WITH t AS (SELECT s_suppkey + 1 AS id, s_name AS name, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS v FROM supplier), b AS (SELECT id, upper(name) AS name, id * 1.0 AS v FROM t WHERE id % 2 = 0)
    SELECT t.id, coalesce(b.name, t.name) AS name, coalesce(b.v, t.v) AS v FROM t LEFT JOIN b USING (id) UNION ALL SELECT -1, 'new ' || r_name, NULL FROM region""",
)
def entity_upserts(spark, d):
    s = c("s_suppkey")
    t = table(spark, d, "supplier").select((s + 1).alias("id"), c("s_name").alias("name"), F.when(s % 3 != 0, c("s_acctbal")).alias("v"))
    known = t.filter("id % 2 = 0").select("id", F.upper("name").alias("name"), c("id").cast("double").alias("v"))
    new = table(spark, d, "region").select(F.lit(0).cast("long").alias("id"), said("new ", c("r_name")).alias("name"), F.lit(None).cast("double").alias("v"))
    top = t.agg(F.max("id")).first()[0]
    return upsert.upsert_entities(t, known.unionByName(new), "id").select(F.when(c("id") > top, -1).otherwise(c("id")).alias("id"), "name", "v")


@query("placeholder_events", f"WITH {EV} SELECT event_id, acronym FROM ev WHERE event_id < 0 OR event_id >= 0 UNION ALL SELECT (SELECT max(event_id) FROM ev) + row_number() OVER (), 'TBD' FROM region")
def placeholder_events(spark, d):
    rows = table(spark, d, "region").select(F.lit(None).cast("long").alias("event_id"), F.lit("TBD").alias("acronym"))
    return sessions.minimal_events(event_view(spark, d).select("event_id", "acronym"), rows)


@query("cache_counts", "SELECT count(DISTINCT sha1(text)) AS size, count(text) - count(DISTINCT sha1(text)) AS hits, count(DISTINCT sha1(text)) AS misses FROM documents")
def cache_counts(spark, d):
    return sessions.cache_stats(table(spark, d, "documents").select(F.sha1("text").alias("text_hash")))


@query("session_log", "SELECT 'm-' || r_name AS machine, '1998-01-01T00:00Z-m-' || r_name || '-abcdefgh' AS session_id, (r_regionkey * 10)::BIGINT AS n_events FROM region WHERE r_regionkey = 2")
def session_log(spark, d):
    none = spark.createDataFrame([], files.TABLES["scrape_sessions"])
    name = table(spark, d, "region").filter("r_regionkey = 2").first()["r_name"]
    begun = sessions.begin(none, f"m-{name}", as_of().cast("timestamp"), F.lit("abcdefghij"))
    sid = begun.first()["session_id"]
    return sessions.end(begun, sid, as_of().cast("timestamp"), 20).select("machine", "session_id", "n_events")


MERGE_EV = f"""{EV}, e AS (SELECT event_id, official_url, paper_deadline, notes FROM ev),
h AS (SELECT w.event_id, coalesce(w.official_url, a.official_url, b.official_url, z.official_url) AS official_url, coalesce(w.paper_deadline, a.paper_deadline, b.paper_deadline, z.paper_deadline) AS paper_deadline,
  CASE WHEN concat(a.notes, b.notes, z.notes) = '' THEN w.notes ELSE coalesce(w.notes, '') || CASE WHEN concat(a.notes, b.notes) <> '' THEN chr(10) || '--- merged from ' || a.event_id || ' ---' || chr(10) || coalesce(a.notes, '') ELSE '' END
  || CASE WHEN coalesce(b.notes, '') <> '' THEN chr(10) || '--- merged from ' || b.event_id || ' ---' || chr(10) || b.notes ELSE '' END || CASE WHEN coalesce(z.notes, '') <> '' THEN chr(10) || '--- merged from ' || z.event_id || ' ---' || chr(10) || z.notes ELSE '' END END AS notes, NULL::BIGINT AS superseded_by
  FROM e w JOIN e a ON a.event_id = w.event_id + 1 JOIN e b ON b.event_id = w.event_id + 2 JOIN e z ON z.event_id = w.event_id + 3 WHERE w.event_id % 12 = 2),
m AS (SELECT a.event_id, coalesce(a.official_url, b.official_url) AS official_url, coalesce(a.paper_deadline, b.paper_deadline) AS paper_deadline, coalesce(a.notes, '') || CASE WHEN coalesce(b.notes, '') <> '' THEN chr(10) || '--- merged from ' || b.event_id || ' ---' || chr(10) || b.notes ELSE '' END
  || chr(10) || '[superseded by ' || (a.event_id - 1) || ': demo]' AS notes, a.event_id - 1 AS superseded_by FROM e a JOIN e b ON b.event_id = a.event_id + 1 WHERE a.event_id % 12 = 3),
l AS (SELECT event_id, official_url, paper_deadline, coalesce(notes, '') || chr(10) || '[superseded by ' || CASE event_id % 12 WHEN 4 THEN event_id - 1 ELSE event_id - 3 END || ': demo]' AS notes, CASE event_id % 12 WHEN 4 THEN event_id - 1 ELSE event_id - 3 END AS superseded_by FROM e WHERE event_id % 12 IN (4, 5))"""


def merge_tables(spark, d):
    li = table(spark, d, "lineitem").filter("l_orderkey % 12 BETWEEN 2 AND 5")
    e = event_view(spark, d).select("event_id", "official_url", "paper_deadline", "notes", F.lit(None).cast("long").alias("superseded_by"))
    k = c("l_orderkey").alias("event_id")
    return {
        "events": e,
        "event_people": li.select(k, c("l_suppkey").alias("person_id"), c("l_returnflag").alias("role")).distinct(),
        "event_organisations": li.select(k, c("l_partkey").alias("org_id"), c("l_linestatus").alias("role")).distinct(),
        "tier_runs": li.select(k, c("l_discount").alias("confidence")),
        "event_embeddings": li.select(k).distinct(),
    }


def demo_merges(spark, d):
    """In twelves: 4 is merged into 3, then 3 into 2, then 5 into 2."""
    k, r = c("o_orderkey"), c("o_orderkey") % 12
    o = table(spark, d, "orders").filter(r.isin(3, 4, 5))
    return o.select(F.when(r == 5, k - 3).otherwise(k - 1).alias("winner"), k.alias("loser"), F.when(r == 4, 1).when(r == 3, 2).otherwise(3).alias("seq"))


@query("merge_chains", f"WITH {MERGE_EV} SELECT event_id, official_url, {ISO.format('paper_deadline')} AS paper_deadline, notes, superseded_by FROM (SELECT * FROM h UNION ALL SELECT * FROM m UNION ALL SELECT * FROM l UNION ALL SELECT *, NULL FROM e WHERE event_id % 12 NOT IN (2, 3, 4, 5))")
def merge_chains(spark, d):
    t = merging.merged(merge_tables(spark, d), demo_merges(spark, d), "demo", as_of().cast("timestamp"))
    return t["events"].select("event_id", "official_url", text_of("paper_deadline"), "notes", "superseded_by")


@query(
    "merge_links",
    """WITH li AS (SELECT l_orderkey - l_orderkey % 12 + 2 AS w, * FROM lineitem WHERE l_orderkey % 12 BETWEEN 2 AND 5) SELECT 'people' AS what, count(*) AS n, sum(w)::BIGINT AS at FROM (SELECT DISTINCT w, l_suppkey, l_returnflag FROM li) UNION ALL
    SELECT 'organisations', count(*), sum(w)::BIGINT FROM (SELECT DISTINCT w, l_partkey, l_linestatus FROM li) UNION ALL SELECT 'runs', count(*), sum(w)::BIGINT FROM li UNION ALL
    SELECT 'embeddings', count(*), sum(w)::BIGINT FROM (SELECT DISTINCT w FROM li WHERE l_orderkey % 12 = 2) UNION ALL SELECT 'collapsed', count(*), sum(CASE o_orderkey % 12 WHEN 5 THEN o_orderkey - 3 ELSE o_orderkey - 1 END)::BIGINT FROM orders WHERE o_orderkey % 12 BETWEEN 3 AND 5""",
)
def merge_links(spark, d):
    t = merging.merged(merge_tables(spark, d), demo_merges(spark, d), "demo", as_of().cast("timestamp"), fold=False)
    count = lambda what, df, at="event_id": df.agg(F.lit(what).alias("what"), F.count(F.lit(1)).alias("n"), F.sum(at).cast("long").alias("at"))
    out = count("people", t["event_people"]).unionByName(count("organisations", t["event_organisations"])).unionByName(count("runs", t["tier_runs"]))
    return out.unionByName(count("embeddings", t["event_embeddings"])).unionByName(count("collapsed", t["events"].filter("superseded_by IS NOT NULL"), "superseded_by"))


@query("winners_by_confidence", f"WITH {EV}, {RUNS}, x AS (SELECT event_id, acronym, edition_year, coalesce(best, 0.0) AS best FROM ev LEFT JOIN runs USING (event_id)) SELECT acronym, edition_year, count(*) AS n, max(best) AS best FROM x GROUP BY 1, 2")
def winners_by_confidence(spark, d):
    return ev.best_confidence(event_view(spark, d), runs(spark, d)).groupBy("acronym", "edition_year").agg(F.count(F.lit(1)).alias("n"), F.max("best").alias("best"))


# neighbours and graph -------------------------------------------------------

BEST = f"""{NEAR}, b AS (SELECT id, arg_max(n, c) AS n, max(c) AS c FROM near WHERE id % 100 = 0 AND n % 3 <> 0 GROUP BY id)"""


def nearest_live(spark, d):
    rows = vecs(spark, d)
    return knn.best_neighbour(asked(rows), rows.filter("event_id % 3 <> 0"))


@query("precheck_pending", f"WITH {BEST} SELECT 'incoming' AS kind, n AS event_id, id AS incoming_id, round(c, 4) AS cosine, 'ann_topk_pending' AS reason FROM b WHERE c >= 0.3 AND c < {MERGE}")
def precheck_pending(spark, d):
    return merging.incoming_rows(nearest_live(spark, d), MERGE, 0.3, as_of()).drop("ts").withColumn("cosine", F.round("cosine", 4))


@query("review_payloads", "SELECT l_orderkey AS event_id, '{\"event_id\":' || l_orderkey || ',\"vec\":[' || l_linenumber || ',' || l_suppkey || ']}' AS payload FROM lineitem WHERE l_linenumber = 1")
def review_payloads(spark, d):
    li = table(spark, d, "lineitem").filter("l_linenumber = 1")
    return li.select(c("l_orderkey").alias("event_id"), merging.review_payload(c("l_orderkey"), F.array(c("l_linenumber").cast("long"), "l_suppkey")).alias("payload"))


@query("labelled_neighbours", f"WITH {BEST} SELECT id AS query_id, n AS event_id, coalesce('EV' || nullif(n % 50, 7), '') AS name FROM b")
def labelled_neighbours(spark, d):
    k = c("event_id")
    names = vecs(spark, d).select("event_id", F.when(k % 50 != 7, said("EV", (k % 50).cast("string"))).alias("acronym"))
    return knn.labelled(nearest_live(spark, d).withColumnRenamed("neighbour_id", "event_id"), "events", names).select("query_id", "event_id", "name")


@query("ranked_candidates", f"WITH {NEAR} SELECT id, n AS neighbour_id, CASE WHEN r = 1 THEN 'ann_top1' ELSE 'ann_topk' END AS reason FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, n) AS r FROM near WHERE c >= {GREY}) WHERE r <= 3")
def ranked_candidates(spark, d):
    return dedup.ranked_candidates(knn.self_neighbours(vecs(spark, d), 5, GREY), 3).select("id", "neighbour_id", "reason")


AXIS = [1.0] + [0.0] * 63


@query("cross_modal", f"SELECT vec_id AS event_id, round(list_cosine_similarity(embedding::DOUBLE[], {AXIS}::DOUBLE[]), 4) AS cosine FROM embeddings WHERE label = 3 ORDER BY list_cosine_similarity(embedding::DOUBLE[], {AXIS}::DOUBLE[]) DESC, vec_id LIMIT 10")
def cross_modal(spark, d):
    rows = vecs(spark, d)
    return graph.cross_modal(rows, rows.filter("label = 3").select("event_id"), AXIS).select("event_id", F.round("cosine", 4).alias("cosine"))


@query("tag_clusters", "SELECT n_name AS name, min(n_name) OVER (PARTITION BY CASE WHEN n_nationkey < 20 THEN n_nationkey % 4 ELSE n_nationkey END) AS cluster FROM nation")
def tag_clusters(spark, d):
    n = table(spark, d, "nation").filter("n_nationkey < 20")
    near = n.alias("x").join(n.alias("y"), F.col("y.n_nationkey") == F.col("x.n_nationkey") + 4).select(F.col("x.n_name").alias("a"), F.col("y.n_name").alias("b"))
    return graph.clusters(near, table(spark, d, "nation").select(c("n_name").alias("name")))


@query("chairs_by_institution", f"WITH {EV} SELECT o_orderstatus AS state, acronym, s_name AS chair, n_name AS institution FROM ev JOIN orders ON o_orderkey = event_id JOIN lineitem ON l_orderkey = event_id AND l_linenumber = 1 JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey")
def chairs_by_institution(spark, d):
    e = event_view(spark, d).join(table(spark, d, "orders").select(c("o_orderkey").alias("event_id"), c("o_orderstatus").alias("state")), "event_id").select("event_id", "acronym", "state")
    chairs = table(spark, d, "lineitem").filter("l_linenumber = 1").select(c("l_orderkey").alias("event_id"), c("l_suppkey").alias("person_id"))
    people = table(spark, d, "supplier").select(c("s_suppkey").alias("person_id"), c("s_name").alias("full_name"), c("s_nationkey").alias("org_id"))
    return graph.chairs_by_institution(e, chairs, people, table(spark, d, "nation").select(c("n_nationkey").alias("org_id"), c("n_name").alias("org_name")))


@query(
    "state_sections",
    f"""WITH p(i, w) AS (VALUES {", ".join(f"({i}, '{p}')" for i, p in enumerate(PLACES))}), e AS (SELECT o_orderkey AS k, o_orderdate::DATE AS day, w, CASE {" ".join(f"WHEN contains(lower(w), '{x}') THEN '{s}'" for x, s in location.cities_by_length())} ELSE '{location.W.NO_STATE}' END AS state
    FROM orders JOIN p ON i = o_orderkey % {len(PLACES)} WHERE regexp_matches(w, '(?i)\\bindia\\b')), t AS (SELECT *, day < DATE '{AS_OF}' AS past FROM e)
    SELECT state, CASE WHEN past THEN 'past' ELSE 'upcoming' END AS section, k, row_number() OVER (PARTITION BY state, past ORDER BY CASE WHEN past THEN -(day - DATE '1970-01-01') ELSE day - DATE '1970-01-01' END, k)::INT AS rank FROM t""",
)
def state_sections(spark, d):
    w = F.element_at(F.array(*map(F.lit, PLACES)), (c("k") % len(PLACES) + 1).cast("int"))
    rows = orders(spark, d).select("k", c("k").alias("ordinal"), w.alias("where"), long_day("day").alias("when"))
    india = rows.filter(F.array_contains(location.location_tags(c("where")), "India")).withColumn("state", location.india_state(c("where")))
    return reports.ranked(india, as_of(), ["state"]).select("state", "section", "k", "rank")


@query(
    "event_pages",
    f"""WITH {EV} SELECT event_id, md5('# ' || name || ' (' || acronym || ')' || chr(10) || chr(10) || '**Type:** ' || CASE WHEN event_id % 2 = 0 THEN 'Workshop' ELSE 'Conference' END || '  ' || chr(10) || '**Category:** ' || array_to_string(categories, ', ') || '  ' || chr(10)
    || '**Year:** ' || edition_year || '  ' || chr(10) || '**Rank:** N/A  ' || chr(10) || '**Source:** s  ' || chr(10) || '**URL:** ' || coalesce(nullif(official_url, ''), origin_url) || '  ' || chr(10) || chr(10) || '## Description' || chr(10) || chr(10) || '_No description available._' || chr(10) || chr(10)
    || '## Deadlines' || chr(10) || chr(10) || '| Milestone | Date |' || chr(10) || '|-----------|------|' || chr(10) || '| Abstract deadline | TBD |' || chr(10) || '| Paper deadline    | ' || coalesce({ISO.format("paper_deadline")}, 'TBD') || ' |' || chr(10) || '| Notification      | TBD |' || chr(10) || '| Camera ready      | TBD |' || chr(10) || chr(10)
    || '## Event' || chr(10) || chr(10) || '| Field | Value |' || chr(10) || '|-------|-------|' || chr(10) || '| Start    | ' || coalesce({ISO.format("start_date")}, 'TBD') || ' |' || chr(10) || '| End      | TBD |' || chr(10) || '| Location | TBD |' || chr(10) || '| Submission system | N/A |' || chr(10)
    || CASE WHEN coalesce(notes, '') <> '' THEN chr(10) || '## Notes' || chr(10) || chr(10) || notes || chr(10) ELSE '' END) AS page FROM ev""",
)
def event_pages(spark, d):
    missing = {n: F.lit(None).cast(t) for n, t in (("rank", T.StringType()), ("description", T.StringType()), ("where_raw", T.StringType()), ("submission_system", T.StringType()), ("abstract_deadline", T.DateType()), ("notification", T.DateType()), ("camera_ready", T.DateType()), ("end_date", T.DateType()), ("sponsor_names", T.ArrayType(T.StringType())), ("raw_tags", T.ArrayType(T.StringType())))}
    e = event_view(spark, d).withColumns({**missing, "source": F.lit("s"), "is_workshop": c("event_id") % 2 == 0})
    return e.select("event_id", F.md5(reports.event_page()).alias("page"))


def queries() -> dict:
    from kalendria.operators import catalogue

    return catalogue.queries()


def oracle_sql() -> dict[str, str]:
    from kalendria.operators import catalogue

    return catalogue.oracle_sql()
