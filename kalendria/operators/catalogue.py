"""The driver's queries over the reference tables, and their SQL for DuckDB.

Orders stand in for events: order key, customer, date, status and priority give
an event's id, acronym, dates, standing and category. ``EV`` is that view in SQL,
:func:`event_view` the same in Spark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kalendria.functions import dates, jsonx, location, text, vectors
from kalendria.functions import wordlists as W
from kalendria.operators import cascade, dedup, graph, knn, queue, reports, upsert
from kalendria.operators import events as ev
from kalendria.sources import pages
from kalendria.streaming import windows

AS_OF = "1998-01-01"
MERGE, GREY = 0.45, 0.40  # the test vectors are far apart; these bounds find pairs among them

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of():
    return F.lit(AS_OF).cast("date")


def text_of(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def event_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("event_id"),
        F.concat(F.lit("EV"), (F.col("o_custkey") % 200).cast("string"), F.when(F.col("o_orderkey") % 3 == 0, "-2025").otherwise(" 2025")).alias("acronym"),
        F.concat(F.lit("Event of "), "o_orderpriority").alias("name"),
        F.year(day).alias("edition_year"),
        F.split(F.regexp_replace("o_orderpriority", r"^\d-", ""), " ").alias("categories"),
        F.when(F.col("o_orderkey") % 11 != 0, day).alias("start_date"),
        F.when(F.col("o_orderstatus") != "P", F.date_sub(day, 60)).alias("paper_deadline"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("")).when(F.col("o_orderkey") % 5 == 1, F.lit(None)).otherwise(F.concat(F.lit("https://ev.org/"), F.col("o_orderkey").cast("string"))).alias("official_url"),
        F.concat(F.lit("http://origin.org/?eventid="), F.col("o_orderkey").cast("string")).alias("origin_url"),
        F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderkey") - 1).alias("superseded_by"),
        F.col("o_custkey").alias("series_id"),
        F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("note "), F.col("o_orderkey").cast("string"))).alias("notes"),
    )


EV = """ev AS (SELECT o_orderkey AS event_id, 'EV' || (o_custkey % 200) || CASE WHEN o_orderkey % 3 = 0 THEN '-2025' ELSE ' 2025' END AS acronym,
  'Event of ' || o_orderpriority AS name, year(o_orderdate)::INT AS edition_year, string_split(regexp_replace(o_orderpriority, '^[0-9]-', ''), ' ') AS categories,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate::DATE END AS start_date, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE - 60 END AS paper_deadline,
  CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN NULL ELSE 'https://ev.org/' || o_orderkey END AS official_url,
  'http://origin.org/?eventid=' || o_orderkey AS origin_url, CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey - 1 END AS superseded_by,
  o_custkey AS series_id, o_totalprice AS price, CASE WHEN o_orderkey % 4 = 0 THEN 'note ' || o_orderkey END AS notes FROM orders)"""

ISO = "strftime({0}, '%Y-%m-%d')"


# relational -----------------------------------------------------------------


@query(
    "live_events_ordered",
    f"""WITH {EV} SELECT event_id, acronym, {ISO.format("paper_deadline")} AS paper_deadline, {ISO.format("start_date")} AS start_date,
    row_number() OVER (PARTITION BY edition_year ORDER BY paper_deadline NULLS LAST, start_date NULLS LAST, acronym, event_id) AS rank
    FROM ev WHERE superseded_by IS NULL""",
)
def live_events_ordered(spark, d):
    w = Window.partitionBy("edition_year").orderBy(F.asc_nulls_last("paper_deadline"), F.asc_nulls_last("start_date"), "acronym", "event_id")
    rows = ev.live(event_view(spark, d)).withColumn("rank", F.row_number().over(w).cast("long"))
    return rows.select("event_id", "acronym", text_of("paper_deadline"), text_of("start_date"), "rank")


@query("event_point_lookup", f"WITH {EV} SELECT event_id, acronym, name FROM ev WHERE event_id = 4321")
def event_point_lookup(spark, d):
    return ev.by_id(event_view(spark, d), 4321).select("event_id", "acronym", "name")


@query(
    "report_projection",
    f"""WITH {EV} SELECT event_id, acronym, coalesce(name, '') AS name, array_to_string(categories, ',') AS categories,
    coalesce({ISO.format("paper_deadline")}, '') AS deadline, coalesce({ISO.format("start_date")}, '') AS start_date,
    coalesce(nullif(official_url, ''), nullif(origin_url, ''), '') AS url FROM ev WHERE superseded_by IS NULL""",
)
def report_projection(spark, d):
    rows = ev.live(event_view(spark, d)).withColumns({"raw_tags": F.lit(None).cast("array<string>"), "when_raw": F.lit(""), "where_raw": F.lit("")})
    p = ev.report_projection(rows)
    return p.select("event_id", "acronym", "name", F.array_join("categories", ",").alias("categories"), "deadline", "start_date", "url")


@query("category_fanout_counts", f"WITH {EV} SELECT c AS category, count(*) AS n FROM (SELECT unnest(categories) AS c FROM ev) GROUP BY c")
def category_fanout_counts(spark, d):
    return ev.category_counts(event_view(spark, d))


@query("category_filter", f"WITH {EV} SELECT count(*) AS n FROM ev WHERE list_contains(categories, 'URGENT')")
def category_filter(spark, d):
    return ev.in_category(event_view(spark, d), "URGENT").agg(F.count(F.lit(1)).alias("n"))


@query("caller_predicate", f"WITH {EV} SELECT event_id, edition_year FROM ev WHERE edition_year >= 1997 AND price > 300000.0 AND superseded_by IS NULL")
def caller_predicate(spark, d):
    rows = ev.where(event_view(spark, d), "edition_year >= :y AND price > :p AND superseded_by IS NULL", {"y": 1997, "p": 300000.0})
    return rows.select("event_id", "edition_year")


@query(
    "upcoming_past_counts",
    f"""WITH {EV} SELECT count(*) FILTER (start_date IS NULL OR start_date >= DATE '{AS_OF}') AS upcoming, count(*) FILTER (start_date < DATE '{AS_OF}') AS past, count(*) AS total FROM ev""",
)
def upcoming_past_counts(spark, d):
    when = F.date_format("start_date", "MMM d, yyyy")
    return ev.timeline_counts(event_view(spark, d).withColumn("when", F.coalesce(when, F.lit("N/A"))), F.col("when"), as_of())


@query(
    "upcoming_sorted",
    f"""WITH {EV} SELECT event_id, row_number() OVER (PARTITION BY edition_year ORDER BY coalesce(start_date, DATE '9999-12-31'), event_id) AS rank
    FROM ev WHERE start_date IS NULL OR start_date >= DATE '{AS_OF}'""",
)
def upcoming_sorted(spark, d):
    return ev.upcoming_ranked(event_view(spark, d), "start_date", as_of(), "event_id", ["edition_year"]).select("event_id", F.col("rank").cast("long").alias("rank"))


@query(
    "past_sorted",
    f"""WITH {EV} SELECT event_id, row_number() OVER (PARTITION BY edition_year ORDER BY start_date DESC, event_id) AS rank FROM ev WHERE start_date < DATE '{AS_OF}'""",
)
def past_sorted(spark, d):
    return ev.past_ranked(event_view(spark, d), "start_date", as_of(), "event_id", ["edition_year"]).select("event_id", F.col("rank").cast("long").alias("rank"))


@query(
    "counts_by_region",
    "SELECT r_name AS region, n_name AS nation, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL",
)
def counts_by_region(spark, d):
    per = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("b"))
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return per.join(n, per["c_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("region"), F.col("n_name").alias("nation"), "n", F.round("b", 2).alias("balance"))


@query("rollup_category_total", "SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'TOTAL' ELSE o_orderpriority END AS category, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderpriority)")
def rollup_category_total(spark, d):
    return ev.category_totals(table(spark, d, "orders").select(F.col("o_orderpriority").alias("category")))


@query(
    "cube_status_priority",
    """SELECT coalesce(o_orderstatus, '*') AS status, coalesce(o_orderpriority, '*') AS priority, grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS level, count(*) AS n,
    count(DISTINCT o_custkey) AS customers FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
)
def cube_status_priority(spark, d):
    c = table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.grouping_id().cast("long").alias("level"), F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("customers"))
    return c.select(F.coalesce("o_orderstatus", F.lit("*")).alias("status"), F.coalesce("o_orderpriority", F.lit("*")).alias("priority"), "level", "n", "customers")


RUNS = "runs AS (SELECT l_orderkey AS event_id, max(l_discount) AS best FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)"


def runs(spark, d):
    li = table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
    return li.select(F.col("l_orderkey").alias("event_id"), F.col("l_discount").alias("confidence"))


@query("best_confidence_left_join", f"WITH {EV}, {RUNS} SELECT event_id, coalesce(best, 0.0) AS best FROM ev LEFT JOIN runs USING (event_id)")
def best_confidence_left_join(spark, d):
    return ev.best_confidence(event_view(spark, d).select("event_id"), runs(spark, d)).select("event_id", "best")


@query(
    "pick_winner",
    f"""WITH {EV}, {RUNS}, st AS (SELECT event_id, coalesce(best, 0.0) AS confidence, o_orderdate AS scraped_at FROM ev LEFT JOIN runs USING (event_id) JOIN orders ON o_orderkey = event_id),
    p AS (SELECT event_id AS a, event_id + 1 AS b FROM st)
    SELECT a, b, CASE WHEN (x.confidence, x.scraped_at, -a) > (y.confidence, y.scraped_at, -b) THEN a ELSE b END AS winner FROM p JOIN st x ON x.event_id = a JOIN st y ON y.event_id = b""",
)
def pick_winner(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("scraped_at"))
    standing = ev.best_confidence(o, runs(spark, d)).withColumnRenamed("best", "confidence")
    pairs = o.select(F.col("event_id").alias("a"), (F.col("event_id") + 1).alias("b"))
    return dedup.pick_winners(pairs, standing).select("a", "b", "winner")


@query("prolific_top20", "SELECT l_suppkey AS supplier, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey) >= 3 ORDER BY n DESC, 1 LIMIT 20")
def prolific_top20(spark, d):
    links = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("event_id"), F.col("l_suppkey").alias("supplier"))
    return ev.prolific(links, "supplier")


@query(
    "cooccurrence_top",
    """WITH x AS (SELECT DISTINCT l_orderkey AS e, l_suppkey AS s FROM lineitem) SELECT p.s AS a, q.s AS b, count(*) AS n FROM x p JOIN x q ON p.e = q.e AND p.s < q.s GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 30""",
)
def cooccurrence_top(spark, d):
    links = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("event_id"), F.col("l_suppkey").alias("supplier"))
    return ev.cooccurrence(links, "supplier")


@query(
    "listing_merge",
    """WITH r AS (SELECT o_orderkey AS o, o_custkey AS u, o_orderstatus AS c FROM orders),
    f AS (SELECT u, o, c, row_number() OVER (PARTITION BY u, c ORDER BY o) AS first_of FROM r),
    k AS (SELECT u, string_agg(c, ', ' ORDER BY o) AS category FROM f WHERE first_of = 1 GROUP BY u)
    SELECT 'u' || u AS key, 'A' || min(o) AS acronym, array_to_string(list_sort(list(DISTINCT c)), ';') AS keywords, first(category) AS category FROM r JOIN k USING (u) GROUP BY u""",
)
def listing_merge(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("ord"), F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("url"), F.concat(F.lit("A"), F.col("o_orderkey").cast("string")).alias("acronym"),
        F.lit("n").alias("name"), F.lit("w").alias("when"), F.lit("p").alias("where"), F.lit("d").alias("deadline"), F.array("o_orderstatus").alias("keywords"), F.col("o_orderstatus").alias("category"),
    )
    return ev.merge_listings(rows, "ord").select("key", "acronym", F.array_join("keywords", ";").alias("keywords"), "category")


@query(
    "exact_dup_documents",
    "SELECT sha1(text) AS text_hash, min(doc_id) AS first_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT lang)), ',') AS langs FROM documents GROUP BY sha1(text) HAVING count(*) > 1",
)
def exact_dup_documents(spark, d):
    g = table(spark, d, "documents").groupBy(text.text_hash(F.col("text")).alias("text_hash"))
    return g.agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("langs")).filter("n > 1")


@query("graph_semi_join", f"WITH {EV} SELECT event_id FROM ev WHERE event_id IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)")
def graph_semi_join(spark, d):
    ids = table(spark, d, "lineitem").filter("l_quantity >= 49").select(F.col("l_orderkey").alias("event_id"))
    return event_view(spark, d).join(ids, "event_id", "left_semi").select("event_id")


@query("full_outer_sides", "SELECT count(*) FILTER (o.k IS NULL) AS left_missing, count(*) FILTER (c.k IS NULL) AS right_missing, count(*) AS n FROM (SELECT DISTINCT o_custkey AS k FROM orders) o FULL JOIN (SELECT c_custkey + 100 AS k FROM customer) c ON o.k = c.k")
def full_outer_sides(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("ok")).distinct()
    c = table(spark, d, "customer").select((F.col("c_custkey") + 100).alias("ck"))
    j = o.join(c, F.col("ok") == F.col("ck"), "full_outer")
    return j.agg(F.count_if(F.col("ok").isNull()).alias("left_missing"), F.count_if(F.col("ck").isNull()).alias("right_missing"), F.count(F.lit(1)).alias("n"))


@query(
    "set_operations",
    """SELECT 'union' AS op, count(*) AS n FROM (SELECT o_custkey FROM orders UNION SELECT c_custkey FROM customer) UNION ALL
    SELECT 'intersect', count(*) FROM (SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM customer) UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)""",
)
def set_operations(spark, d):
    o, c = table(spark, d, "orders").select("o_custkey"), table(spark, d, "customer").select("c_custkey")
    count = lambda df, op: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "n")
    return count(o.union(c).distinct(), "union").union(count(o.intersect(c), "intersect")).union(count(c.subtract(o), "except"))


@query(
    "window_frames",
    """SELECT o_orderkey AS k, lag(o_totalprice) OVER w AS prev, lead(o_orderkey) OVER w AS next_key, ntile(4) OVER w AS quarter,
    round(avg(o_totalprice) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS mean3 FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def window_frames(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("k"), F.lag("o_totalprice").over(w).alias("prev"), F.lead("o_orderkey").over(w).alias("next_key"), F.ntile(4).over(w).cast("long").alias("quarter"),
        F.round(F.avg("o_totalprice").over(w.rowsBetween(-2, 0)), 4).alias("mean3"),
    )


# mutations ------------------------------------------------------------------


@query(
    "reroute_links_anti",
    """WITH l AS (SELECT DISTINCT l_orderkey AS event_id, l_suppkey AS s, l_returnflag AS role FROM lineitem),
    m AS (SELECT event_id AS loser, event_id - 1 AS winner FROM (SELECT DISTINCT event_id FROM l) WHERE event_id % 7 = 0)
    SELECT event_id, s, role FROM l WHERE event_id NOT IN (SELECT loser FROM m) UNION ALL
    SELECT DISTINCT winner, s, role FROM l JOIN m ON l.event_id = m.loser WHERE NOT EXISTS (SELECT 1 FROM l x WHERE x.event_id = winner AND x.s IS NOT DISTINCT FROM l.s AND x.role = l.role)""",
)
def reroute_links_anti(spark, d):
    links = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("event_id"), F.col("l_suppkey").alias("s"), F.col("l_returnflag").alias("role")).distinct()
    moves = links.select("event_id").distinct().filter("event_id % 7 = 0").select(F.col("event_id").alias("loser"), (F.col("event_id") - 1).alias("winner"))
    return dedup.reroute(links, moves, ["s", "role"])


@query(
    "merge_coalesce",
    f"""WITH {EV}, e AS (SELECT event_id, acronym, paper_deadline, start_date, official_url, notes FROM ev), p AS (SELECT event_id AS l, event_id - 1 AS w FROM e WHERE event_id % 6 = 4 AND event_id - 1 IN (SELECT event_id FROM e))
    SELECT e.event_id, coalesce(e.official_url, x.official_url) AS official_url, {ISO.format("coalesce(e.paper_deadline, x.paper_deadline)")} AS paper_deadline,
    CASE WHEN g.w IS NOT NULL THEN coalesce(e.notes, '') || chr(10) || '[superseded by ' || g.w || ': demo]'
         WHEN coalesce(x.notes, '') = '' THEN e.notes ELSE coalesce(e.notes, '') || chr(10) || '--- merged from ' || x.event_id || ' ---' || chr(10) || x.notes END AS notes, g.w AS superseded_by
    FROM e LEFT JOIN p ON p.w = e.event_id LEFT JOIN e x ON x.event_id = p.l LEFT JOIN p g ON g.l = e.event_id""",
)
def merge_coalesce(spark, d):
    e = event_view(spark, d).select("event_id", "acronym", "paper_deadline", "start_date", "official_url", "notes", F.lit(None).cast("long").alias("superseded_by"))
    there = e.select((F.col("event_id") + 1).alias("event_id"))
    pairs = e.filter("event_id % 6 = 4").join(there, "event_id", "left_semi").select((F.col("event_id") - 1).alias("winner"), F.col("event_id").alias("loser"))
    m = dedup.merge_pairs(e, pairs, "demo", F.current_timestamp())
    return m.select("event_id", "official_url", text_of("paper_deadline"), "notes", "superseded_by")


@query(
    "upsert_policy",
    """WITH old AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS rank, 'a' AS source FROM customer),
    new AS (SELECT c_custkey + 500 AS k, upper(c_name) AS name, CASE WHEN c_custkey % 2 = 0 THEN 'NEW' END AS rank, 'b' AS source FROM customer)
    SELECT coalesce(o.k, n.k) AS event_id, CASE WHEN n.k IS NOT NULL THEN n.name ELSE o.name END AS name, coalesce(n.rank, o.rank) AS rank, coalesce(o.source, n.source) AS source FROM old o FULL JOIN new n ON o.k = n.k""",
)
def upsert_policy(spark, d):
    c = table(spark, d, "customer")
    old = c.select(F.col("c_custkey").alias("event_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("rank"), F.lit("a").alias("source"))
    new = c.select((F.col("c_custkey") + 500).alias("event_id"), F.upper("c_name").alias("name"), F.when(F.col("c_custkey") % 2 == 0, "NEW").alias("rank"), F.lit("b").alias("source"))
    return upsert.upsert_events(old, new, F.current_timestamp())


@query(
    "fold_batch_last_value",
    """SELECT o_custkey AS k, arg_max(o_orderstatus, o_orderkey) AS status, arg_max(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, o_orderkey) FILTER (o_orderstatus <> 'P') AS rank FROM orders GROUP BY 1""",
)
def fold_batch_last_value(spark, d):
    b = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("rank"))
    return upsert.folded(b, ["k"], "seq", ["rank"])


@query("insert_ignore", "SELECT k, r FROM (SELECT c_custkey AS k, c_nationkey AS r FROM customer UNION SELECT o_custkey + 700, (o_custkey % 25)::INT FROM orders WHERE o_custkey + 700 NOT IN (SELECT c_custkey FROM customer))")
def insert_ignore(spark, d):
    t = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("r"))
    b = table(spark, d, "orders").select((F.col("o_custkey") + 700).alias("k"), (F.col("o_custkey") % 25).cast("int").alias("r"))
    return upsert.insert_absent(t, b, ["k"])


# text, dates, places --------------------------------------------------------

NORM = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({0})), '^the ', ''), '^(\d+)(st|nd|rd|th)\s+', ''), '\s*(19|20)\d{{2}}\s*$', ''), '\s*\d{{2}}\s*$', ''), '[-._/''" + '"' + r"]', '', 'g'), '\s+', ' ', 'g'))"
PART_ACR = "CASE p_partkey % 4 WHEN 0 THEN 'The ' || p_brand || '-2025' WHEN 1 THEN '12th ' || p_brand || ' 2025' WHEN 2 THEN lower(p_brand) || ' 25' ELSE p_brand || '/''2025' END"


def part_acronyms(spark, d):
    k, b = F.col("p_partkey") % 4, F.col("p_brand")
    acr = F.when(k == 0, F.concat(F.lit("The "), b, F.lit("-2025"))).when(k == 1, F.concat(F.lit("12th "), b, F.lit(" 2025"))).when(k == 2, F.concat(F.lower(b), F.lit(" 25"))).otherwise(F.concat(b, F.lit("/'2025")))
    return table(spark, d, "part").select(F.col("p_partkey").alias("event_id"), acr.alias("acronym"), F.col("p_size").alias("edition_year"))


@query("acronym_norm", f"SELECT p_partkey AS event_id, {NORM.format(PART_ACR)} AS norm FROM part")
def acronym_norm(spark, d):
    return part_acronyms(spark, d).select("event_id", text.normalise_acronym(F.col("acronym")).alias("norm"))


BLOCKED = f"blk AS (SELECT p_partkey AS id, {NORM.format(PART_ACR)} AS k, p_size AS y FROM part), acr AS (SELECT x.id AS a, z.id AS b FROM blk x JOIN blk z ON x.k = z.k AND x.y = z.y AND x.id < z.id WHERE x.k <> '')"


@query("acronym_blocking_pairs", f"WITH {BLOCKED} SELECT a, b FROM acr")
def acronym_blocking_pairs(spark, d):
    return dedup.acronym_pairs(part_acronyms(spark, d))


CANON = r"""regexp_extract(url, '^([^:/?#]+)://', 1)"""
URLPARTS = r"""u AS (SELECT page_id, url, lower(regexp_extract(url, '^([^:/?#]+)://', 1)) AS s, lower(regexp_extract(url, '^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS h,
  regexp_extract(url, '^[^:/?#]+://(?:[^/?#@]*@)?[^/?#:]*:(\d+)', 1) AS po, regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1) AS pa, regexp_extract(url, '\?([^#]*)', 1) AS q FROM pages),
c AS (SELECT page_id, s || '://' || h || CASE WHEN po = '' OR (s = 'http' AND po = '80') OR (s = 'https' AND po = '443') THEN '' ELSE ':' || po END
  || CASE WHEN pa = '' THEN '/' WHEN length(pa) > 1 THEN regexp_replace(pa, '/$', '') ELSE pa END || CASE WHEN q = '' THEN '' ELSE '?' || q END AS canonical, h FROM u)"""


@query("canonical_url", f"WITH {URLPARTS} SELECT page_id, canonical, substr(sha256(canonical), 1, 32) AS job_id, h AS host FROM c")
def canonical_url(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", text.canonical_url(u).alias("canonical"), text.job_id(u).alias("job_id"), text.host(u).alias("host"))


@query("enqueue_dedup", f"WITH {URLPARTS} SELECT canonical, min(page_id) AS page_id FROM c GROUP BY canonical")
def enqueue_dedup(spark, d):
    p = table(spark, d, "pages").select("page_id", "url", F.lit(1).alias("tier"), F.lit(0.0).alias("priority"), F.timestamp_seconds("page_id").alias("ts"))
    return queue.jobs(p.unionByName(p.withColumn("ts", F.col("ts") + F.expr("interval 1 day")))).select("canonical", "page_id")


@query(
    "parser_longest_suffix",
    f"""WITH {URLPARTS}, reg(domain, module, o) AS (VALUES ('org', 'any', 0), ('example.org', 'example', 1), ('com', 'com', 2), ('net', 'net', 3)),
    m AS (SELECT page_id, module, row_number() OVER (PARTITION BY page_id ORDER BY length(domain) DESC, o) AS n FROM c JOIN reg ON h = domain OR ends_with(h, '.' || domain))
    SELECT c.page_id, c.h AS host, m.module FROM c LEFT JOIN m ON m.page_id = c.page_id AND m.n = 1""",
)
def parser_longest_suffix(spark, d):
    reg = spark.createDataFrame([("org", "any", 0), ("example.org", "example", 1), ("com", "com", 2), ("net", "net", 3)], "domain string, module string, ordinal int")
    return ev.parser_for_host(table(spark, d, "pages").select("page_id", text.host(F.col("url")).alias("host")), reg)


LOWWORDS = lambda c, words: "(" + " OR ".join(f"contains(lower({c}), '{w}')" for w in words) + ")"


@query(
    "document_flags",
    f"""SELECT doc_id, len(regexp_replace(text, '[^Ѐ-ӿ؀-ۿऀ-ॿ一-鿿぀-ヿ가-힯฀-๿א-ת]', '', 'g')) / greatest(length(text), 1) < 0.05 AS english, {LOWWORDS("text", W.VIRTUAL_WORDS)} AS virtual_event,
    {" + ".join(f"contains(lower(text), '{s}')::INT" for s in W.CONFERENCE_SIGNALS)} AS signals,
    concat_ws(',', {", ".join(f"CASE WHEN {LOWWORDS('text', ws)} THEN '{c}' END" for c, ws in W.CATEGORY_WORDS.items())}) AS categories FROM documents""",
)
def document_flags(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", text.is_english(t).alias("english"), text.detect_virtual(t).alias("virtual_event"), text.conference_signals(t).alias("signals"), F.array_join(text.classify_category(t), ",").alias("categories"))


@query(
    "document_hints",
    r"""SELECT doc_id, sha1(text) AS text_hash, greatest(1, length(text) // 4)::INT AS tokens, regexp_extract(text, '(?:^|[^\pL\pM\pN_])([A-Z][A-Z0-9]{1,11}(?:[ -]?20\d{2})?)(?:$|[^\pL\pM\pN_])', 1) AS acronym,
    coalesce(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) BETWEEN 5 AND 200)[1], trim(substr(text, 1, 120))) AS name FROM documents""",
)
def document_hints(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", text.text_hash(t).alias("text_hash"), text.count_tokens(t).alias("tokens"), text.acronym_hint(t).alias("acronym"), text.name_hint(t).alias("name"))


PLACES = ["Zurich, Switzerland", "London, UK", "Paris, France", "Austin, TX, USA", "Mumbai, India", "New Delhi, India", "Online", "Singapore", "San Bernardino", "", "Goa and Navi Mumbai, India", "Jerome, AZ, here", "Dresden, Germany", "Hong Kong, China"]
_TAG = lambda words: LOWWORDS("w", words)


@query(
    "location_tags",
    f"""WITH p(i, w) AS (VALUES {", ".join(f"({i}, '{p}')" for i, p in enumerate(PLACES))}), e AS (SELECT o_orderkey AS event_id, w FROM orders JOIN p ON i = o_orderkey % {len(PLACES)})
    SELECT event_id, CASE WHEN w = '' THEN 'Other' WHEN {_TAG(W.ONLINE)} THEN 'Online' ELSE coalesce(nullif(concat_ws(',', CASE WHEN {_TAG(W.UK + W.SWITZERLAND + W.EUROPE)} THEN 'Europe' END,
    CASE WHEN regexp_matches(w, '(?i)\\bindia\\b') THEN 'India' END, CASE WHEN {_TAG(W.SINGAPORE)} THEN 'Singapore' END, CASE WHEN {_TAG(W.SWITZERLAND)} THEN 'Switzerland' END, CASE WHEN {_TAG(W.UK)} THEN 'UK' END,
    CASE WHEN {_TAG(W.USA)} THEN 'USA' END), ''), 'Other') END AS tags,
    CASE {" ".join(f"WHEN contains(lower(w), '{c}') THEN '{s}'" for c, s in location.cities_by_length())} ELSE '{W.NO_STATE}' END AS state FROM e""",
)
def location_tags(spark, d):
    w = F.element_at(F.array(*map(F.lit, PLACES)), (F.col("o_orderkey") % len(PLACES) + 1).cast("int"))
    e = table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"), w.alias("w"))
    return e.select("event_id", F.array_join(location.location_tags(F.col("w")), ",").alias("tags"), location.india_state(F.col("w")).alias("state"))


@query(
    "when_text_dates",
    f"""SELECT o_orderkey AS event_id, CASE o_orderkey % 4 WHEN 0 THEN {ISO.format("o_orderdate")} WHEN 1 THEN {ISO.format("o_orderdate")} END AS start, o_orderkey % 4 < 2 AND o_orderdate < DATE '{AS_OF}' AS past FROM orders""",
)
def when_text_dates(spark, d):
    k, day = F.col("o_orderkey") % 4, F.col("o_orderdate")
    when = F.when(k == 0, F.concat(F.date_format(day, "MMM d, yyyy"), F.lit(" - later"))).when(k == 1, F.concat(F.lit("from "), F.date_format(day, "MMM  d yyyy"))).when(k == 2, F.lit("N/A")).otherwise(F.date_format(day, "'Juneau' d yyyy"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"), when.alias("when"))
    return o.select("event_id", F.date_format(dates.start_date(F.col("when")), "yyyy-MM-dd").alias("start"), dates.is_past(F.col("when"), as_of()).alias("past"))


@query(
    "date_anomaly_flags",
    f"""WITH {EV}, s AS (SELECT l_orderkey AS event_id, min(l_shipdate)::DATE AS lo, max(l_shipdate)::DATE AS hi FROM lineitem GROUP BY 1)
    SELECT event_id, coalesce(lo < paper_deadline, false) OR coalesce(start_date < lo, false) OR coalesce(start_date < paper_deadline, false) AS anomaly,
    CASE WHEN hi >= DATE '{AS_OF}' AND lo >= DATE '{AS_OF}' THEN lo - DATE '{AS_OF}' WHEN hi >= DATE '{AS_OF}' THEN hi - DATE '{AS_OF}' END AS days_left,
    CASE WHEN paper_deadline IS NULL THEN 'new_deadline' WHEN lo > paper_deadline THEN 'extension' WHEN lo < paper_deadline THEN 'brought_forward' END AS change,
    coalesce(abs(start_date - hi) <= 30, true) AS fits FROM ev JOIN s USING (event_id)""",
)
def date_anomaly_flags(spark, d):
    s = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("event_id")).agg(F.to_date(F.min("l_shipdate")).alias("lo"), F.to_date(F.max("l_shipdate")).alias("hi"))
    e = event_view(spark, d).join(s, "event_id")
    return e.select(
        "event_id", dates.date_anomaly(F.col("paper_deadline"), F.col("lo"), F.col("start_date")).alias("anomaly"), dates.days_to_deadline(as_of(), F.col("lo"), F.col("hi")).cast("long").alias("days_left"),
        dates.deadline_change(F.col("paper_deadline"), F.col("lo")).alias("change"), dates.dates_compatible(F.col("start_date"), F.col("hi")).alias("fits"),
    )


@query(
    "slug_and_year",
    f"""WITH {EV} SELECT event_id, trim(regexp_replace(trim(regexp_replace(upper(acronym), '\\s*' || edition_year || '\\s*$', '')) || '-' || edition_year, '[^A-Z0-9]+', '-', 'g'), '-') AS slug,
    try_cast(nullif(regexp_extract(acronym, '\\b(20\\d{{2}})\\b', 1), '') AS INT) AS year, try_cast(regexp_extract(origin_url, '[?&]eventid=(\\d+)', 1) AS BIGINT) AS id FROM ev""",
)
def slug_and_year(spark, d):
    e = event_view(spark, d)
    c = F.col
    return e.select("event_id", text.slug(c("acronym"), c("edition_year"), c("start_date"), c("paper_deadline")).alias("slug"), text.first_year(c("acronym"), c("name")).alias("year"), text.event_id_of(c("origin_url")).alias("id"))


@query("embedding_text", f"""WITH {EV} SELECT event_id, concat_ws(' | ', acronym, name, nullif(trim(coalesce(official_url, '')), ''), array_to_string(categories, ' | ')) AS t FROM ev""")
def embedding_text(spark, d):
    c = F.col
    return event_view(spark, d).select("event_id", text.embedding_text(c("acronym"), c("name"), c("official_url"), F.lit(None).cast("string"), F.lit("  "), c("categories")).alias("t"))


@query(
    "report_lines",
    f"""WITH {EV} SELECT event_id, '| ' || acronym || ' | ' || array_to_string(categories, ', ') || ' | ' || substr(name, 1, 70) || ' | ' || coalesce({ISO.format("start_date")}, 'N/A') || ' | N/A | ' || coalesce({ISO.format("paper_deadline")}, 'N/A') || ' | '
    || CASE WHEN coalesce(official_url, '') = '' THEN '—' ELSE '[↗](' || official_url || ')' END || ' |' AS line FROM ev""",
)
def report_lines(spark, d):
    e = event_view(spark, d).select(
        "event_id", "acronym", "name", F.array_join("categories", ", ").alias("category"), F.date_format("start_date", "yyyy-MM-dd").alias("when"), F.lit("").alias("where"), F.date_format("paper_deadline", "yyyy-MM-dd").alias("deadline"), F.col("official_url").alias("url")
    )
    return e.select("event_id", reports.line(True).alias("line"))


@query("link_extraction", r"""SELECT page_id, len(l) AS n, coalesce(l[1], '') AS first FROM (SELECT page_id, list_filter(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1), lambda x: regexp_matches(x, '(?i)http'))[1:50] AS l FROM pages)""")
def link_extraction(spark, d):
    p = table(spark, d, "pages").select("page_id", pages.links(F.col("html"), "http").alias("l"))
    return p.select("page_id", F.size("l").cast("long").alias("n"), F.coalesce(F.get("l", F.lit(0)), F.lit("")).alias("first"))


# JSON and cascade -----------------------------------------------------------


@query("props_json_agg", "SELECT event_type, (props->>'$.k')::INT AS k, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def props_json_agg(spark, d):
    e = table(spark, d, "events").select("event_type", "value", jsonx.field(F.try_parse_json("props"), "k", "int").alias("k"))
    return e.groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("json_repair", "SELECT event_id, (props->>'$.k')::INT AS k FROM events")
def json_repair(spark, d):
    p, k = F.col("props"), F.col("event_id") % 5
    mangled = (
        F.when(k == 0, F.concat(F.lit("```json\n"), p, F.lit("\n```")))
        .when(k == 1, F.concat(F.lit("<think>a {b}</think>Here: "), p, F.lit(" done")))
        .when(k == 2, F.regexp_replace(p, r'"k":', "'k':"))
        .when(k == 3, F.regexp_replace(p, r"\}$", ", }"))
        .otherwise(p)
    )
    return table(spark, d, "events").select("event_id", jsonx.field(F.try_parse_json(jsonx.repaired_json_text(mangled)), "k", "int").alias("k"))


@query(
    "tier1_routing",
    """SELECT doc_id, CASE WHEN toxic = 1 THEN 'audit_only' WHEN c < 0.85 THEN 'escalate_2' ELSE 'tier2' END AS route, CASE WHEN toxic = 0 AND c < 0.85 THEN 'low_confidence' END AS reason
    FROM (SELECT doc_id, toxic, least(1.0, n_chars / 2000.0) AS c FROM labels JOIN documents USING (doc_id))""",
)
def tier1_routing(spark, d):
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    conf = jsonx.coerce_confidence((F.col("n_chars") / 2000.0).cast("string"))
    return j.select("doc_id", cascade.tier1_route(F.col("toxic") == 0, conf).alias("route"), cascade.tier1_reason(F.col("toxic") == 0, conf).alias("reason"))


@query(
    "tier2_routing",
    """SELECT doc_id, CASE WHEN quality = 0 THEN 'escalate_4' WHEN c < 0.85 THEN 'escalate_3' ELSE 'persist' END AS route, round(c, 6) AS confidence,
    CASE WHEN greatest(1, n_chars // 4) > 1000 THEN 'long_context' ELSE 'default' END AS model FROM (SELECT doc_id, quality, n_chars, least(0.99, n_chars / 1500.0, 0.92) AS c FROM labels JOIN documents USING (doc_id))""",
)
def tier2_routing(spark, d):
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars", "text"), "doc_id")
    conf = cascade.least_confidence(F.lit(0.99), F.col("n_chars") / 1500.0, F.lit(0.92), F.lit(None).cast("double"))
    sev = F.when(F.col("quality") == 0, "block").otherwise("ok")
    tokens = text.count_tokens(F.col("text")) * 32
    return j.select("doc_id", cascade.tier2_route(sev, conf).alias("route"), F.round(conf, 6).alias("confidence"), cascade.tier2_model(tokens, F.lit(True), F.lit(True)).alias("model"))


@query("entity_fanout", "SELECT role AS name, count(*) AS n, count(DISTINCT conv_id) AS records FROM conversations GROUP BY role")
def entity_fanout(spark, d):
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("role").alias("full_name"))).alias("people"))).alias("json"))
    a = c.select(F.col("conv_id").alias("record_id"), F.try_parse_json("json").alias("parsed"))
    return cascade.fan_out(a, "people", ["full_name"]).groupBy(F.col("full_name").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("record_id").alias("records"))


@query(
    "quality_flag_rules",
    f"""WITH {EV} SELECT event_id, concat_ws(',', CASE WHEN coalesce(start_date < paper_deadline, false) THEN 'date_anomaly' END, CASE WHEN contains(lower(name), 'journal') THEN 'journal_not_conference' END,
    CASE WHEN NOT contains(origin_url, official_url) THEN 'invented_url' END) AS flags FROM ev""",
)
def quality_flag_rules(spark, d):
    return cascade.quality_flags(event_view(spark, d), "origin_url").select("event_id", F.array_join("flags", ",").alias("flags"))


# vectors and dedup ----------------------------------------------------------

COS = "list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[])"
NEAR = f"near AS (SELECT x.vec_id AS id, y.vec_id AS n, {COS} AS c FROM embeddings x JOIN embeddings y ON x.vec_id <> y.vec_id)"


def vecs(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("event_id"), F.col("embedding").alias("vec"), "label")


def asked(rows):
    return rows.filter("event_id % 100 = 0")


@query("knn_top5", f"WITH {NEAR} SELECT id AS query_id, n AS event_id, round(c, 4) AS cosine, rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, n) AS rank FROM near WHERE id % 100 = 0) WHERE rank <= 5")
def knn_top5(spark, d):
    rows = vecs(spark, d)
    return knn.nearest(asked(rows), rows, 5).select("query_id", F.col("neighbour_id").alias("event_id"), F.round("cosine", 4).alias("cosine"), F.col("rank").cast("long").alias("rank"))


@query(
    "knn_filtered",
    f"""WITH {NEAR} SELECT id AS query_id, n AS event_id, label, round(c, 4) AS cosine FROM (SELECT near.*, e.label, row_number() OVER (PARTITION BY id ORDER BY c DESC, n) AS rank
    FROM near JOIN embeddings e ON e.vec_id = n WHERE id % 100 = 0 AND e.label = 3) WHERE rank <= 10""",
)
def knn_filtered(spark, d):
    every = vecs(spark, d)
    rows = ev.where(every, "label = :l", {"l": 3})
    return knn.nearest(asked(every), rows, 10).select("query_id", F.col("neighbour_id").alias("event_id"), F.lit(3).alias("label"), F.round("cosine", 4).alias("cosine"))


@query(
    "knn_self_topk",
    f"WITH {NEAR} SELECT id, n AS neighbour_id, round(c, 4) AS cosine, rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, n) AS rank FROM near WHERE c >= {GREY}) WHERE rank <= 5",
)
def knn_self_topk(spark, d):
    return knn.self_neighbours(vecs(spark, d), 5, GREY).select("id", "neighbour_id", F.round("cosine", 4).alias("cosine"), F.col("rank").cast("long").alias("rank"))


@query(
    "best_neighbour_verdict",
    f"""WITH {NEAR} SELECT id AS query_id, arg_max(n, c) AS neighbour_id, CASE WHEN max(c) >= {MERGE} THEN 'duplicate' WHEN max(c) >= {GREY} THEN 'pending' ELSE 'new' END AS verdict
    FROM near WHERE id % 10 = 0 GROUP BY id""",
)
def best_neighbour_verdict(spark, d):
    rows = vecs(spark, d)
    best = knn.best_neighbour(rows.filter("event_id % 10 = 0"), rows)
    return best.select("query_id", "neighbour_id", knn.verdict(F.col("cosine"), MERGE, GREY).alias("verdict"))


def near_pairs(spark, d):
    return knn.self_neighbours(vecs(spark, d), 5, GREY).select(F.col("id").alias("a"), F.col("neighbour_id").alias("b"), "cosine")


PAIRS = f"""{NEAR}, {BLOCKED}, top AS (SELECT least(id, n) AS a, greatest(id, n) AS b, c FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, n) AS r FROM near WHERE c >= {GREY}) WHERE r <= 5),
pairs AS (SELECT a, b, bool_or(ann) AS is_ann, bool_or(NOT ann) AS is_acronym, max(c) AS c FROM (SELECT a, b, true AS ann, c FROM top UNION ALL SELECT a, b, false, NULL FROM acr) GROUP BY a, b)"""


@query("pair_union_flags", f"WITH {PAIRS} SELECT a, b, is_ann, is_acronym, round(c, 4) AS cosine FROM pairs")
def pair_union_flags(spark, d):
    return dedup.united(near_pairs(spark, d), part_acronyms(spark, d)).withColumn("cosine", F.round("cosine", 4))


SWEEP = f"""WITH RECURSIVE {PAIRS}, o AS (SELECT *, row_number() OVER (ORDER BY a, b) AS i, CASE WHEN (a % 17, -a) > (b % 17, -b) THEN a ELSE b END AS w FROM pairs),
step(i, lost, verdict) AS (SELECT 0::BIGINT, []::BIGINT[], '' UNION ALL
  SELECT o.i, CASE WHEN list_contains(lost, a) OR list_contains(lost, b) OR coalesce(c, 0) < {MERGE} THEN lost ELSE list_append(lost, CASE WHEN w = a THEN b ELSE a END) END,
  CASE WHEN list_contains(lost, a) OR list_contains(lost, b) THEN 'skip' WHEN c >= {MERGE} THEN 'merge' WHEN c >= {GREY} OR is_acronym THEN 'pending' ELSE 'none' END
  FROM step JOIN o ON o.i = step.i + 1),
v AS (SELECT a, b, verdict, w AS winner, CASE WHEN w = a THEN b ELSE a END AS loser, CASE WHEN verdict = 'merge' THEN 'sweep' WHEN verdict = 'pending' THEN CASE WHEN c IS NULL THEN 'acronym_match' ELSE 'sweep' END END AS reason,
  round(coalesce(c, 0), 4) AS cosine FROM step JOIN o ON o.i = step.i)"""


def verdicts(spark, d):
    ids = vecs(spark, d).select("event_id").union(part_acronyms(spark, d).select("event_id")).filter("event_id IS NOT NULL").distinct()
    standing = ids.select("event_id", F.lit(0.5).alias("confidence"), F.timestamp_seconds(F.col("event_id") % 17).alias("scraped_at"))
    return dedup.swept(near_pairs(spark, d), part_acronyms(spark, d), standing, MERGE, GREY)


@query("sweep_verdicts", f"{SWEEP} SELECT * FROM v")
def sweep_verdicts(spark, d):
    return verdicts(spark, d).drop("seq").withColumn("cosine", F.round("cosine", 4))


@query("sweep_counts", f"{SWEEP} SELECT count(*) AS examined, count(*) FILTER (verdict = 'merge') AS merged, count(*) FILTER (verdict = 'pending') AS queued FROM v")
def sweep_counts(spark, d):
    return dedup.sweep_report(verdicts(spark, d))


@query("sweep_pending", f"{SWEEP} SELECT 'existing_pair' AS kind, a AS event_id, b AS other_id, cosine, reason FROM v WHERE verdict = 'pending'")
def sweep_pending(spark, d):
    return dedup.pending_rows(verdicts(spark, d), as_of()).drop("ts").withColumn("cosine", F.round("cosine", 4))


@query("lsh_pairs")
def lsh_pairs(spark, d):
    return knn.lsh_pairs(vecs(spark, d), GREY)


@query("lsh_recall", f"WITH {NEAR} SELECT count(*) AS exact, true AS enough FROM near WHERE id < n AND c >= {GREY}")
def lsh_recall(spark, d):
    """Of the pairs that brute force finds, hashing finds nine in ten or more."""
    pairs = knn.hashed_pairs(vecs(spark, d), GREY)
    return pairs.agg(F.count(F.lit(1)).alias("exact"), (F.count_if("met") >= 0.9 * F.count(F.lit(1))).alias("enough"))


@query("vector_norms", "SELECT label, count(*) AS n, round(avg(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 4) AS mean_norm FROM embeddings GROUP BY label")
def vector_norms(spark, d):
    e = vecs(spark, d).select("label", vectors.norm(vectors.checked(F.col("vec"), 64)).alias("v"))
    return e.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("v"), 4).alias("mean_norm"))


@query("ivf_lists", "SELECT greatest(100, floor(sqrt(count(*))))::BIGINT AS lists FROM lineitem")
def ivf_lists(spark, d):
    return table(spark, d, "lineitem").agg(vectors.ivf_lists(F.count(F.lit(1))).alias("lists"))


# queue, streams, graph ------------------------------------------------------


@query(
    "queue_pop_order",
    "SELECT event_id, tier, row_number() OVER (PARTITION BY tier ORDER BY -(user_id % 3) * 1e13 + epoch_ms(ts), j) AS pop FROM (SELECT event_id, user_id, ts, event_type AS tier, sha256(event_id::VARCHAR) AS j FROM events)",
)
def queue_pop_order(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("event_type").alias("tier"), F.sha2(F.col("event_id").cast("string"), 256).alias("job_id"), queue.score(F.col("user_id") % 3, F.col("ts").cast("timestamp")).alias("score"))
    return queue.pop_order(e).select("event_id", "tier", F.col("pop").cast("long").alias("pop"))


@query("queue_depths", "SELECT event_type AS tier, count(*) AS depth FROM events GROUP BY 1")
def queue_depths(spark, d):
    return queue.depths(table(spark, d, "events").select(F.col("event_type").alias("tier")))


def _gate(hours):
    return f"""WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) // 1000 AS t FROM events), n AS (SELECT user_id, min(t) AS t FROM e GROUP BY 1),
    g(user_id, t) AS (SELECT user_id, t FROM n UNION ALL SELECT x.user_id, x.nxt FROM (SELECT g.user_id, (SELECT min(e.t) FROM e WHERE e.user_id = g.user_id AND e.t >= g.t + {hours * 3_600_000}) AS nxt FROM g) x WHERE x.nxt IS NOT NULL),
    f AS (SELECT user_id, t, min(event_id) AS event_id FROM e GROUP BY 1, 2), o AS (SELECT f.event_id FROM f JOIN g USING (user_id, t))"""


def gated(spark, d, seconds):
    e = table(spark, d, "events").select("event_id", F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("http://h"), F.col("user_id").cast("string"), F.lit(".org/x")).alias("url"))
    return queue.rate_gate(e, seconds)


@query("rate_gate", f"{_gate(1)} SELECT event_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS gap_ms, event_id IN (SELECT event_id FROM o) AS allowed FROM e")
def rate_gate(spark, d):
    return gated(spark, d, 3600.0).select("event_id", "gap_ms", "allowed")


@query("rate_gate_allowed", f"{_gate(24)} SELECT 'h' || user_id || '.org' AS host, count(*) FILTER (event_id IN (SELECT event_id FROM o)) AS allowed, count(*) AS asked FROM e GROUP BY user_id")
def rate_gate_allowed(spark, d):
    return gated(spark, d, 86400.0).groupBy("host").agg(F.count_if("allowed").alias("allowed"), F.count(F.lit(1)).alias("asked"))


@query("queue_cursors", "SELECT event_type AS source, arg_max(event_id, ts) AS page FROM events GROUP BY 1")
def queue_cursors(spark, d):
    return queue.cursors(table(spark, d, "events").select(F.col("event_type").alias("source"), F.col("event_id").alias("page"), "ts"))


@query("metric_counters", "SELECT event_type AS name, round(sum(value), 4) AS value FROM events GROUP BY 1")
def metric_counters(spark, d):
    return queue.metrics(table(spark, d, "events").select(F.col("event_type").alias("name"), "value")).withColumn("value", F.round("value", 4))


def stamped(df):
    t = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return df.select(t("start"), t("end"), *[c for c in df.columns if c not in ("start", "end", "total")], F.round("total", 4).alias("total"))


_T = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


@query(
    "tumbling_windows",
    f"""SELECT {_T.format("s")} AS start, {_T.format("s + INTERVAL 1 HOUR")} AS "end", event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT date_trunc('hour', ts) AS s, event_type, value FROM events) GROUP BY s, event_type""",
)
def tumbling_windows(spark, d):
    return stamped(windows.tumbling(table(spark, d, "events"), "1 hour", by=["event_type"]))


@query(
    "sliding_windows",
    f"""SELECT {_T.format("s")} AS start, {_T.format("s + INTERVAL 1 HOUR")} AS "end", count(*) AS n, round(sum(value), 4) AS total
    FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL (i * 30) MINUTE AS s, value FROM events, unnest([0, 1]) AS u(i)) GROUP BY s""",
)
def sliding_windows(spark, d):
    return stamped(windows.sliding(table(spark, d, "events"), "1 hour", "30 minutes"))


@query(
    "session_windows",
    f"""WITH m AS (SELECT user_id, ts, value, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM m)
    SELECT {_T.format("min(ts)")} AS start, {_T.format("max(ts) + INTERVAL 6 HOUR")} AS "end", user_id, count(*) AS n, round(sum(value), 4) AS total FROM g GROUP BY user_id, sid""",
)
def session_windows(spark, d):
    return stamped(windows.sessions(table(spark, d, "events"), "6 hours", ["user_id"]))


@query(
    "isa_closure",
    """WITH RECURSIVE e AS (SELECT n_name AS c, r_name AS p FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'WORLD' FROM region),
    n AS (SELECT c AS x FROM e UNION SELECT p FROM e), t(d, a, k) AS (SELECT x, x, 0 FROM n UNION SELECT t.d, e.p, t.k + 1 FROM t JOIN e ON t.a = e.c WHERE t.k < 6)
    SELECT d AS descendant, a AS ancestor, min(k) AS depth FROM t GROUP BY 1, 2""",
)
def isa_closure(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    e = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"))
    return graph.closure(e.unionByName(r.select(F.col("r_name").alias("child"), F.lit("WORLD").alias("parent"))))


@query(
    "upcoming_under_concept",
    f"""WITH {EV} SELECT event_id, {ISO.format("start_date")} AS start_date FROM ev JOIN customer ON series_id = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE start_date > DATE '{AS_OF}' AND r_name = 'EUROPE' AND n_name IN ('NATION_3', 'NATION_8', 'NATION_1')""",
)
def upcoming_under_concept(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    by = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("country"))
    e = event_view(spark, d).join(by, F.col("series_id") == F.col("c_custkey"))
    tags = e.select("event_id", F.col("country").alias("concept"))
    return graph.upcoming_under(e, tags, isa_closure(spark, d), "EUROPE", ["NATION_3", "NATION_8", "NATION_1"], as_of()).select("event_id", text_of("start_date"))


@query("series_preceded_by", f"WITH {EV} SELECT event_id, p AS preceded_by FROM (SELECT event_id, lag(event_id) OVER (PARTITION BY series_id ORDER BY edition_year, event_id) AS p FROM ev) WHERE p IS NOT NULL")
def series_preceded_by(spark, d):
    return graph.series_chain(event_view(spark, d)).select("event_id", "preceded_by")


@query(
    "edge_sync",
    "SELECT src, type, dst FROM (SELECT n_name AS src, 'IN_REGION' AS type, n_regionkey::VARCHAR AS dst FROM nation UNION ALL SELECT s_suppkey::VARCHAR, 'BASED_IN', s_nationkey::VARCHAR FROM supplier)",
)
def edge_sync(spark, d):
    return graph.edges(in_region=(table(spark, d, "nation"), "n_name", "n_regionkey"), based_in=(table(spark, d, "supplier"), "s_suppkey", "s_nationkey"))


@query("adhoc_sql", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def adhoc_sql(spark, d):
    from kalendria.sources.files import query as sql

    table(spark, d, "lineitem").createOrReplaceTempView("lineitem")
    return sql(spark, "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem WHERE l_shipdate <= :t GROUP BY 1, 2", t="1998-09-02")
