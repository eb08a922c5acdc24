"""Graph queries as joins over edge tables (src, type, dst)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendria.functions import vectors
from kalendria.plans.components import components


def edges(**tables: tuple[DataFrame, str, str]) -> DataFrame:
    """Edge rows from tables: the keyword is the edge's type, its value (table, source column, target column)."""
    out = None
    for kind, (df, src, dst) in tables.items():
        one = df.select(F.col(src).cast("string").alias("src"), F.lit(kind.upper()).alias("type"), F.col(dst).cast("string").alias("dst")).filter(F.col("dst").isNotNull())
        out = one if out is None else out.unionByName(one)
    return out


#: Edges that the table set holds: type, table, source column, target column, columns that become properties, condition.
STORED = [
    ("is_edition_of", "events", "event_id", "series_id", [], None),
    ("held_at", "events", "event_id", "venue_id", [], None),
    ("co_located_with", "events", "event_id", "parent_id", [], "is_workshop"),
    ("chairs", "event_people", "person_id", "event_id", ["role"], "role LIKE '%chair%'"),
    ("delivers_keynote_at", "event_people", "person_id", "event_id", [], "role LIKE '%keynote%'"),
    ("affiliated_with", "person_affiliations", "person_id", "org_id", ["year"], None),
    ("sponsors", "event_organisations", "org_id", "event_id", [], "role = 'sponsor'"),
    ("organises", "event_organisations", "org_id", "event_id", [], "role = 'organiser'"),
    ("publishes", "series", "org_id", "series_id", [], None),
    ("in_city", "venues", "venue_id", "city", [], None),
    ("in_state", "venues", "city", "country", ["state"], "state IS NOT NULL"),
    ("in_country", "venues", "city", "country", [], "state IS NULL"),
]


def stored_edges(tables: dict[str, DataFrame]) -> DataFrame:
    """(src, type, dst, props): every kind of edge whose table and columns are there, once each."""
    out = None
    for kind, name, src, dst, props, condition in STORED:
        df = tables.get(name)
        if df is not None and {src, dst, *props} <= set(df.columns):
            rows = df.filter(condition) if condition else df
            named = F.to_json(F.struct(*props)) if props else F.lit("{}")
            one = rows.select(F.col(src).cast("string").alias("src"), F.lit(kind.upper()).alias("type"), F.col(dst).cast("string").alias("dst"), named.alias("props")).filter("src IS NOT NULL AND dst IS NOT NULL").distinct()
            out = one if out is None else out.unionByName(one)
    return out


def category_edges(events: DataFrame, runs: DataFrame) -> DataFrame:
    """CLASSIFIED_AS: an event and each of its categories, with the confidence and tier of its surest run."""
    best = runs.groupBy("event_id").agg(F.max(F.struct("confidence", "tier")).alias("r"))
    met = events.select("event_id", F.explode("categories").alias("category")).join(best, "event_id", "left")
    return met.select(F.col("event_id").cast("string").alias("src"), F.lit("CLASSIFIED_AS").alias("type"), F.col("category").alias("dst"), F.to_json(F.struct(F.col("r.confidence").alias("conf"), F.col("r.tier").alias("tier"))).alias("props"))


def closure(is_a: DataFrame, depth: int = 6) -> DataFrame:
    """(descendant, ancestor, depth): reflexive and transitive up to ``depth`` steps, by the shortest way.

    Ways are doubled: six steps take three joins.
    """
    nodes = is_a.select(F.col("child").alias("n")).unionByName(is_a.select(F.col("parent").alias("n"))).distinct()
    own = nodes.select(F.col("n").alias("descendant"), F.col("n").alias("ancestor"), F.lit(0).alias("depth"))
    shortest = lambda df: df.groupBy("descendant", "ancestor").agg(F.min("depth").alias("depth"))

    def joined(x: DataFrame, y: DataFrame) -> DataFrame:
        on = y.select(F.col("descendant").alias("ancestor"), F.col("ancestor").alias("_far"), F.col("depth").alias("_more"))
        return shortest(x.join(on, "ancestor").select("descendant", F.col("_far").alias("ancestor"), (F.col("depth") + F.col("_more")).alias("depth")))

    step = shortest(own.unionByName(is_a.select(F.col("child").alias("descendant"), F.col("parent").alias("ancestor"), F.lit(1).alias("depth"))))
    reach, left = None, depth
    while left:
        if left & 1:
            reach = step if reach is None else joined(reach, step)
        left >>= 1
        step = joined(step, step) if left else step
    return own if reach is None else reach


def stored_closure(is_a: DataFrame, path: str, depth: int = 6) -> DataFrame:
    """The closure as a table, for queries that ask it often."""
    closure(is_a, depth).write.mode("overwrite").parquet(path)
    return is_a.sparkSession.read.parquet(path)


def upcoming_under(events: DataFrame, tags: DataFrame, reach: DataFrame, concept: str, countries: list[str], as_of: Column) -> DataFrame:
    """Coming events in some countries whose tags lie under a concept, by date."""
    under = reach.filter(F.col("ancestor") == concept).select(F.col("descendant").alias("concept"))
    ids = tags.join(under, "concept", "left_semi").select("event_id").distinct()
    return events.filter((F.col("start_date") > as_of) & F.col("country").isin(countries)).join(ids, "event_id", "left_semi").orderBy("start_date", "event_id")


def chairs_by_institution(events: DataFrame, chairs: DataFrame, people: DataFrame, orgs: DataFrame) -> DataFrame:
    """(state, acronym, chair, institution) through the two bridges, by state."""
    return (
        events.join(chairs, "event_id").join(people, "person_id").join(orgs, "org_id")
        .select("state", "acronym", F.col("full_name").alias("chair"), F.col("org_name").alias("institution")).orderBy("state", "acronym", "chair", "institution")
    )


def series_chain(events: DataFrame, series: str = "series_id", year: str = "edition_year", id_col: str = "event_id") -> DataFrame:
    """(event_id, preceded_by): each edition's predecessor in its series."""
    w = Window.partitionBy(series).orderBy(year, id_col)
    return events.filter(F.col(series).isNotNull()).select(series, id_col, F.lag(id_col).over(w).alias("preceded_by")).filter(F.col("preceded_by").isNotNull())


def clusters(near: DataFrame, names: DataFrame) -> DataFrame:
    """(name, cluster): concepts linked by pairs (a, b) of near names; a lone name is its own cluster."""
    met = names.join(components(near).withColumnRenamed("id", "name"), "name", "left")
    return met.select("name", F.coalesce("root", "name").alias("cluster"))


def cross_modal(events: DataFrame, ids: DataFrame, query: list[float], k: int = 10) -> DataFrame:
    """The nearest ``k`` of the events that a graph query found."""
    q = F.array(*(F.lit(float(x)) for x in query))
    return events.join(ids, "event_id", "left_semi").withColumn("cosine", vectors.cosine(F.col("vec"), q)).orderBy(F.desc("cosine"), "event_id").limit(k)
