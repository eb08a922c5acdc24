"""Relational operators over the event table: predicates, projections, joins and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalendria.functions import dates, text
from kalendria.plans.ranking import numbered


def live(events: DataFrame) -> DataFrame:
    return events.filter(F.col("superseded_by").isNull())


def by_id(events: DataFrame, event_id: int) -> DataFrame:
    return events.filter(F.col("event_id") == event_id).limit(1)


def live_ordered(events: DataFrame) -> DataFrame:
    """Live rows by paper deadline, start and acronym, unknown dates last; the order itself is left to the reader's sort."""
    return live(events).orderBy(F.asc_nulls_last("paper_deadline"), F.asc_nulls_last("start_date"), "acronym", "event_id")


def report_projection(events: DataFrame) -> DataFrame:
    """The names and texts that reports use: ISO dates or '', the official link before the origin, no NULL lists."""
    iso = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))
    empty = F.expr("cast(array() as array<string>)")
    return events.select(
        "event_id",
        F.coalesce("acronym", F.lit("")).alias("acronym"),
        F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("categories", empty).alias("categories"),
        F.coalesce("raw_tags", empty).alias("keywords"),
        F.coalesce("when_raw", F.lit("")).alias("when"),
        F.coalesce("where_raw", F.lit("")).alias("where"),
        iso("paper_deadline").alias("deadline"),
        text.first_filled(F.col("official_url"), F.col("origin_url"), F.lit("")).alias("url"),
        iso("start_date").alias("start_date"),
    )


def in_category(events: DataFrame, category: str) -> DataFrame:
    return events.filter(F.array_contains("categories", category))


def in_region(events: DataFrame, tag: str, tags: Column) -> DataFrame:
    return events.filter(F.array_contains(tags, tag))


def where(events: DataFrame, predicate: str, params: dict | None = None) -> DataFrame:
    """A caller's predicate in SQL, with named parameters; ``vec`` is kept for the search vector."""
    if "vec" in (params or {}):
        raise ValueError("the parameter name 'vec' is reserved")
    return events.sparkSession.sql(f"SELECT * FROM {{rows}} WHERE {predicate}", args=params or {}, rows=events)


def category_fanout(events: DataFrame) -> DataFrame:
    return events.select("*", F.explode("categories").alias("category"))


def category_counts(events: DataFrame) -> DataFrame:
    return category_fanout(events).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def category_totals(events: DataFrame) -> DataFrame:
    """Counts by the whole category text and their TOTAL."""
    by = events.rollup("category").agg(F.count(F.lit(1)).alias("n"), F.grouping("category").alias("all"))
    return by.select(F.when(F.col("all") == 1, "TOTAL").otherwise(F.col("category")).alias("category"), "n")


def timeline_counts(events: DataFrame, when: Column, as_of: Column) -> DataFrame:
    past = dates.is_past(when, as_of)
    return events.agg(F.count_if(~past).alias("upcoming"), F.count_if(past).alias("past"), F.count(F.lit(1)).alias("total"))


def upcoming_ranked(events: DataFrame, start: str, as_of: Column, ordinal: str, by: list[str] | None = None) -> DataFrame:
    """Rows not yet past, earliest first, unknown last, ties in input order."""
    up = events.filter(F.col(start).isNull() | (F.col(start) >= as_of))
    far = F.coalesce(F.col(start), F.lit("9999-12-31").cast("date"))
    return numbered(up.withColumn("_far", far), by or [], [F.asc("_far"), F.asc(ordinal)]).drop("_far")


def past_ranked(events: DataFrame, start: str, as_of: Column, ordinal: str, by: list[str] | None = None) -> DataFrame:
    """Past rows, latest first, ties in input order."""
    return numbered(events.filter(F.col(start) < as_of), by or [], [F.desc(start), F.asc(ordinal)])


def best_confidence(events: DataFrame, runs: DataFrame) -> DataFrame:
    """The greatest confidence of each event's runs, 0 without any. Runs are summed before they are joined."""
    best = runs.groupBy("event_id").agg(F.max("confidence").alias("best"))
    return events.join(best, "event_id", "left").withColumn("best", F.coalesce("best", F.lit(0.0)))


def prolific(links: DataFrame, entity: str, least: int = 3, top: int = 20) -> DataFrame:
    """Entities of at least ``least`` distinct events, most first."""
    counted = links.groupBy(entity).agg(F.countDistinct("event_id").alias("n")).filter(F.col("n") >= least)
    return counted.orderBy(F.desc("n"), entity).limit(top)


#: Links that make a task of their own.
TASK_LINKS = 200_000


def cooccurrence(links: DataFrame, entity: str, top: int = 30) -> DataFrame:
    """Pairs of entities by the number of events that they share. Links are dealt by event into as many tasks as their number asks for."""
    tasks = max(int(links.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-links.count() // TASK_LINKS))
    one = links.select("event_id", entity).repartition(tasks, "event_id").distinct()
    a, b = one.withColumnRenamed(entity, "a"), one.withColumnRenamed(entity, "b")
    pairs = a.join(b, "event_id").filter(F.col("a") < F.col("b"))
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "a", "b").limit(top)


def merge_listings(rows: DataFrame, ordinal: str) -> DataFrame:
    """One row a key (link, or acronym and date): the first wins, keywords are united, new categories appended unless contained."""
    key = F.when(F.coalesce(F.col("url"), F.lit("")) != "", F.col("url")).otherwise(F.concat_ws("|", F.coalesce("acronym", F.lit("")), F.coalesce("when", F.lit(""))))
    grouped = rows.withColumn("key", key).groupBy("key").agg(
        F.min_by(F.struct("acronym", "name", "when", "where", "deadline", "url"), ordinal).alias("first"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("keywords")))).alias("keywords"),
        F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.col("category").alias("c")))).alias("cats"),
    )
    joined = F.aggregate(
        F.transform("cats", lambda x: x["c"]),
        F.lit(None).cast("string"),
        lambda a, c: F.when(a.isNull(), c).when(a.contains(c), a).otherwise(F.concat(a, F.lit(", "), c)),
    )
    return grouped.select("key", "first.*", "keywords", joined.alias("category"))


def resolve_model(needed: DataFrame, aliases: DataFrame, available: DataFrame) -> DataFrame:
    """(name, model): by alias, then exactly, then the first available that starts with name-; else the name itself."""
    named = needed.join(F.broadcast(aliases), "name", "left").select("name", F.coalesce("target", "name").alias("want"))
    fits = (F.col("model") == F.col("want")) | F.col("model").startswith(F.concat("want", F.lit("-")))
    met = named.join(F.broadcast(available), fits, "left")
    order = F.struct((F.col("model") != F.col("want")).alias("inexact"), "ordinal")
    return met.groupBy("name", "want").agg(F.min_by("model", order).alias("found")).select("name", F.coalesce("found", "want").alias("model"))


def available_models(needed: DataFrame, pulled: DataFrame) -> DataFrame:
    """Needed models that are there, under their own name or as its ``:latest``."""
    on = (F.col("pulled") == F.col("name")) | (F.col("pulled") == F.concat("name", F.lit(":latest")))
    return needed.join(F.broadcast(pulled), on, "left_semi")


def missing_models(needed: DataFrame, pulled: DataFrame) -> DataFrame:
    """Needed models of which no tag is there."""
    on = (F.col("pulled") == F.col("name")) | F.col("pulled").startswith(F.concat("name", F.lit(":")))
    return needed.join(F.broadcast(pulled), on, "left_anti")


def parser_for_host(pages: DataFrame, registry: DataFrame, host: str = "host") -> DataFrame:
    """The module of the longest registered domain that the host is or ends with; registries are small tables.

    Each distinct host is expanded to its own suffixes, so the join is on equality;
    the pages only meet the answer for their host, every row and column as it was.
    """
    labels = F.split("_host", r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    wide = pages.select(F.col(host).alias("_host")).distinct().select("_host", F.posexplode_outer(suffixes).alias("_depth", "domain"))
    reg = registry.groupBy(F.lower("domain").alias("domain")).agg(F.min_by("module", "ordinal").alias("module"))
    known = wide.join(reg, "domain").groupBy("_host").agg(F.min_by("module", "_depth").alias("module"))
    return pages.join(known, pages[host] == known["_host"], "left").drop("_host")
