"""Files and tables: seed JSON, deadlines in YAML, CSV and JSON sinks, the table set and its snapshots."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kalendria.functions import dates, jsonx, text
from kalendria.operators import events as ev
from kalendria.plans.scratch import hadoop_path

SEED = "acronym string, name string, category string, keywords array<string>, `when` string, `where` string, deadline string, url string, _corrupt_record string"
TABLES = {
    "events": "event_id long, acronym string, name string, series_id long, edition_year int, categories array<string>, is_workshop boolean, is_virtual boolean, when_raw string, start_date date, end_date date, "
    "abstract_deadline date, paper_deadline date, notification date, camera_ready date, where_raw string, country string, region string, india_state string, venue_id long, origin_url string, official_url string, "
    "submission_system string, sponsor_names array<string>, raw_tags array<string>, description string, rank string, source string, quality_flags array<string>, quality_severity string, scrape_session_id string, "
    "notes string, scraped_at timestamp, last_checked timestamp, superseded_by long",
    "organisations": "org_id long, name string, short_name string, type string, country string, city string, homepage string",
    "series": "series_id long, acronym string, name string, org_id long, homepage string",
    "venues": "venue_id long, name string, city string, state string, country string, region string, address string, lat double, lon double, maps_url string",
    "people": "person_id long, full_name string, email string, homepage string, org_id long",
    "scrape_sessions": "session_id string, machine string, started_at timestamp, ended_at timestamp, n_events long, notes string",
    "event_people": "event_id long, person_id long, role string",
    "person_affiliations": "person_id long, org_id long, year int",
    "event_organisations": "event_id long, org_id long, role string",
    "event_embeddings": "event_id long, vec array<float>, text_hash string",
    "concept_embeddings": "concept_name string, vec array<float>",
    "sites": "domain string, parser string, last_crawled timestamp",
    "tier_runs": "event_id long, tier int, model string, confidence double, output_json string, escalate boolean, escalate_reason string, elapsed_ms long, scrape_session_id string, created_at timestamp",
    "scrape_queue": "url string, tier int, priority double, metadata map<string,string>, added_at timestamp",
}


def read_seed_json(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON array; a document that is none is an error."""
    first = spark.read.text(path, wholetext=True).select(F.substring(F.ltrim("value"), 1, 1).alias("c")).filter(~F.regexp_like("c", F.lit(r"\[")))
    if not first.isEmpty():
        raise ValueError("a JSON array is expected")
    return spark.read.schema(SEED).json(path, multiLine=True).drop("_corrupt_record")


def seed_events(records: DataFrame, session: str | None = None) -> DataFrame:
    """Seed records as event rows; those without an id in their link are left out."""
    r = records.withColumn("event_id", text.event_id_of(F.col("url"))).filter(F.col("event_id").isNotNull()).withColumn("_r", dates.split_range(F.col("when")))
    acronym = text.strip(F.coalesce("acronym", F.lit("")))
    name = text.strip(text.first_filled(F.col("name"), acronym))
    return r.select(
        "event_id", acronym.alias("acronym"), name.alias("name"), jsonx.parse_categories(F.col("category")).alias("categories"), F.col("when").alias("when_raw"),
        dates.seed_date(F.col("_r.start_text")).alias("start_date"), dates.seed_date(F.col("_r.end_text")).alias("end_date"), dates.seed_date(F.col("deadline")).alias("paper_deadline"), F.col("where").alias("where_raw"),
        F.coalesce("keywords", F.expr("cast(array() as array<string>)")).alias("raw_tags"), F.col("url").alias("origin_url"), F.lit("wikicfp").alias("source"),
        text.first_year(acronym, name).alias("edition_year"), F.lit(session).cast("string").alias("scrape_session_id"),
    )


YAML_EVENT = "acronym string, name string, edition_year int, official_url string, paper string, abstract string, where_raw string, start string, end string, raw_tags array<string>"


#: Entries of deadline lists that leave a worker together.
ENTRIES = 4096


def yaml_items(content: str) -> Iterator:
    """The items of a document that is a list, each made when it is asked for: the whole tree of a long list takes a hundred times its text."""
    import yaml

    class Plain(yaml.SafeLoader):
        pass

    Plain.yaml_implicit_resolvers = {k: [(t, r) for t, r in v if t != "tag:yaml.org,2002:timestamp"] for k, v in yaml.SafeLoader.yaml_implicit_resolvers.items()}
    loader = Plain(content)
    try:
        loader.get_event()
        if loader.check_event(yaml.StreamEndEvent):
            return
        loader.get_event()
        if not loader.check_event(yaml.SequenceStartEvent):
            yield from loader.construct_document(loader.compose_node(None, None)) or []
        else:
            top = loader.get_event()
            if top.tag not in (None, "!", "tag:yaml.org,2002:seq"):
                raise yaml.constructor.ConstructorError(None, None, f"a list is expected, not {top.tag}", top.start_mark)
            while not loader.check_event(yaml.SequenceEndEvent):
                yield loader.construct_document(loader.compose_node(None, None))
            loader.get_event()
        loader.get_event()
        if not loader.check_event(yaml.StreamEndEvent):
            raise yaml.composer.ComposerError("expected a single document", None, "but found another document", loader.get_event().start_mark)
    finally:
        loader.dispose()


def yaml_entries(content: str) -> Iterator[dict]:
    """Entries of a deadline list; a deadline is a value or has parts, and dates stay text."""
    str_of = lambda v: None if v is None else str(v)
    for e in yaml_items(content):
        if isinstance(e, dict):
            due = e.get("deadline")
            parts = due if isinstance(due, dict) else {"paper": due}
            title = str(e.get("title") or e.get("name") or "")
            year = e.get("year")
            yield {
                "acronym": title, "name": str(e.get("full_name") or title), "edition_year": int(year) if str(year).isdigit() else None, "official_url": str(e.get("link") or e.get("website") or ""),
                "paper": str_of(parts.get("paper")), "abstract": str_of(e.get("abstract_deadline") or parts.get("abstract")), "where_raw": str(e.get("place") or e.get("location") or ""),
                "start": str_of(e.get("start")), "end": str_of(e.get("end")), "raw_tags": [str(e["sub"])] if e.get("sub") else [],
            }


def yaml_deadlines(files: DataFrame, as_of: date) -> DataFrame:
    """Events of YAML deadline lists in column ``value``, a document a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = [c.split()[0] for c in YAML_EVENT.split(", ")]
        for b in batches:
            found = (e for v in b["value"] for e in yaml_entries(v))
            while some := list(islice(found, ENTRIES)):
                yield pd.DataFrame(some, columns=cols).astype({"edition_year": "Int32"})

    e = files.select("value").mapInPandas(run, YAML_EVENT)
    day = {"paper_deadline": "paper", "abstract_deadline": "abstract", "start_date": "start", "end_date": "end"}
    return e.select(F.lit(-1).cast("long").alias("event_id"), "acronym", "name", "edition_year", "official_url", *(dates.fuzzy_date(F.col(c), as_of).alias(n) for n, c in day.items()), "where_raw", "raw_tags", F.lit("ai_deadlines").alias("source"))


def write_csv(rows: DataFrame, path: str) -> None:
    """With a header, lists joined by '; '."""
    flat = [F.concat_ws("; ", c).alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes]
    rows.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def write_json(rows: DataFrame, path: str, stamp: str) -> None:
    """A stamped folder and the same rows as ``latest``."""
    for name in (stamp, "latest"):
        rows.write.mode("overwrite").json(f"{path}/{name}")


def create_tables(spark: SparkSession, database: str = "pg") -> list[str]:
    """The empty table set, as far as it is not there."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, cols in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet")
    return sorted(TABLES)


def query(spark: SparkSession, sql: str, **params) -> DataFrame:
    """Any SQL over the session's tables, values bound by name."""
    return spark.sql(sql, args=params or None)


def export_events(events: DataFrame, path: str) -> None:
    """Live events by start, unknown last, as one sorted Parquet snapshot."""
    ev.live(events).orderBy(F.asc_nulls_last("start_date"), "event_id").write.mode("overwrite").parquet(path)


def swap_in(df: DataFrame, path: str) -> None:
    """A rewritten table in place of the old: written beside it, the old one moved aside, the new one named, and only then the old one deleted."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}.new")
    fs, p = hadoop_path(spark, path)
    fresh, aside = hadoop_path(spark, f"{path}.new")[1], hadoop_path(spark, f"{path}.old")[1]
    if fs.exists(p):
        fs.delete(aside, True)
        fs.rename(p, aside)
    fs.rename(fresh, p)
    fs.delete(aside, True)


def recovered(spark: SparkSession, path: str) -> bool:
    """Puts back what a crash inside :func:`swap_in` left aside; True if there was something."""
    fs, p = hadoop_path(spark, path)
    _, aside = hadoop_path(spark, f"{path}.old")
    return not fs.exists(p) and bool(fs.exists(aside)) and bool(fs.rename(aside, p))


def save_state(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load_state(spark: SparkSession, names: list[str], path: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


def embed(rows: DataFrame, encoder: Callable[[list[str]], list[list[float]]], dim: int, text_col: str = "text", id_col: str = "event_id", batch: int = 64) -> DataFrame:
    """(id, vec, text_hash): each distinct text is encoded once, ``batch`` at a time, in order; a wrong length ends the query."""
    keyed = rows.select(F.col(id_col), F.col(text_col).alias("text"), F.sha1(text_col).alias("text_hash"))
    once = keyed.groupBy("text_hash").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.iloc[at : at + batch]
                vecs = encoder(part["text"].tolist())
                if any(len(v) != dim for v in vecs):
                    raise ValueError(f"the encoder must give {dim} numbers")
                yield pd.DataFrame({"text_hash": part["text_hash"], "vec": vecs})

    return keyed.join(once.mapInPandas(run, "text_hash string, vec array<float>"), "text_hash").select(id_col, "vec", "text_hash")


def first_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")
