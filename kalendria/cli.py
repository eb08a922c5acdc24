"""python -m kalendria.cli: tables, reports, sweeps and SQL from the shell."""

from __future__ import annotations

import argparse
import json
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kalendria.operators import dedup, events, graph, knn, merging, queue, reports, worker
from kalendria.plans import scratch
from kalendria.sources import files, prompts


def session() -> SparkSession:
    return SparkSession.builder.appName("kalendria").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="kalendria")
    verbs = p.add_subparsers(dest="verb", required=True)
    verbs.add_parser("init-db")
    r = verbs.add_parser("generate-reports")
    r.add_argument("events")
    r.add_argument("folder")
    r.add_argument("--as-of", required=True)
    d = verbs.add_parser("dedup-sweep")
    d.add_argument("events")
    d.add_argument("embeddings")
    d.add_argument("--runs", help="tier runs, for the confidence of events")
    d.add_argument("--out", help="folder for the merged events, the embeddings that are left and the pairs for review")
    d.add_argument("--as-of", default="1970-01-01")
    q = verbs.add_parser("sql")
    q.add_argument("text")
    s = verbs.add_parser("seed")
    s.add_argument("json")
    s.add_argument("out")
    e = verbs.add_parser("enqueue-seeds", help="add the registry's links to the queue table, those that are new")
    e.add_argument("registry")
    e.add_argument("queue")
    e.add_argument("--as-of", required=True)
    w = verbs.add_parser("run-pipeline", help="fetched pages (url, html, error) to failures and candidates")
    w.add_argument("pages")
    w.add_argument("registry")
    w.add_argument("out")
    w.add_argument("--as-of", required=True)
    b = verbs.add_parser("bootstrap-ontology", help="store the closure of a table of concepts (child, parent)")
    b.add_argument("concepts")
    b.add_argument("out")
    m = verbs.add_parser("list-models", help="the models that a machine needs, out of a JSON object of lists")
    m.add_argument("models")
    m.add_argument("machine")
    h = verbs.add_parser("doctor", help="tables, scratch folder, models and queue depths")
    h.add_argument("--database", default="pg")
    h.add_argument("--models")
    h.add_argument("--machine")
    h.add_argument("--pulled", nargs="*", default=[])
    h.add_argument("--all", action="store_true")
    a = p.parse_args(args)
    spark = session()
    if a.verb == "init-db":
        print(*files.create_tables(spark), sep="\n")
    elif a.verb == "generate-reports":
        rows = events.report_projection(events.live(spark.read.parquet(a.events)))
        print(*reports.write_reports(rows.withColumns({"ordinal": F.col("event_id"), "category": F.array_join("categories", ", ")}), a.folder, a.as_of), sep="\n")
    elif a.verb == "dedup-sweep":
        swept(spark, a)
    elif a.verb == "sql":
        files.query(spark, a.text).show(truncate=False)
    elif a.verb == "seed":
        files.seed_events(files.read_seed_json(spark, a.json)).write.mode("overwrite").parquet(a.out)
    elif a.verb == "enqueue-seeds":
        print(f"enqueued {enqueue(spark, a)} new seed urls")
    elif a.verb == "run-pipeline":
        found = worker.dispatched(spark.read.parquet(a.pages), prompts.load_registry(a.registry).tables(spark)["parsers"])
        worker.failures(found).write.mode("overwrite").parquet(f"{a.out}/failed")
        worker.candidates(found, date.fromisoformat(a.as_of)).write.mode("overwrite").parquet(f"{a.out}/candidates")
    elif a.verb == "bootstrap-ontology":
        print(graph.stored_closure(spark.read.parquet(a.concepts), a.out).count())
    elif a.verb == "list-models":
        print(" ".join(json.loads(Path(a.models).read_text()).get(a.machine, [])))
    elif a.verb == "doctor":
        return doctor(spark, a)
    return 0


def swept(spark: SparkSession, a: argparse.Namespace) -> None:
    """Pairs, verdicts and counts; with ``--out`` the merges are done as well."""
    every, vectors = spark.read.parquet(a.events), spark.read.parquet(a.embeddings)
    ev, at = events.live(every), F.lit(a.as_of).cast("timestamp")
    near = knn.self_neighbours(vectors.join(ev.select("event_id"), "event_id", "left_semi"), 5, 0.92)
    near = near.select(F.col("id").alias("a"), F.col("neighbour_id").alias("b"), "cosine")
    standing = ev.select("event_id", "scraped_at")
    standing = events.best_confidence(standing, spark.read.parquet(a.runs)).withColumnRenamed("best", "confidence") if a.runs else standing.withColumn("confidence", F.lit(0.0))
    verdicts = scratch.table(dedup.swept(near, ev, standing))
    dedup.sweep_report(verdicts).show()
    if a.out:
        tables = merging.swept({"events": every, "event_embeddings": vectors}, verdicts, at)
        for name, df in (tables | {"pending": dedup.pending_rows(verdicts, at)}).items():
            df.write.mode("overwrite").parquet(f"{a.out}/{name}")


def enqueue(spark: SparkSession, a: argparse.Namespace) -> int:
    """Appends the registry's links that the queue doesn't hold; how many there were."""
    t = prompts.load_registry(a.registry).tables(spark)
    fs, p = scratch.hadoop_path(spark, a.queue)
    schema = "canonical string, url string, tier int, priority double, metadata map<string,string>, added_at timestamp"
    known = spark.read.schema(schema).parquet(a.queue) if fs.exists(p) else spark.createDataFrame([], schema)
    new = scratch.table(queue.new_seeds(queue.seeds(t["seed_urls"], t["external_urls"]), known).withColumn("added_at", F.lit(a.as_of).cast("timestamp")))
    new.write.mode("append").parquet(a.queue)
    return new.count()


def doctor(spark: SparkSession, a: argparse.Namespace) -> int:
    """One line a check; the first failure ends it unless ``--all``."""
    needed = json.loads(Path(a.models).read_text()).get(a.machine, []) if a.models else []

    def tables() -> str:
        missing = [t for t in files.TABLES if not spark.catalog.tableExists(f"{a.database}.{t}")]
        if missing:
            raise LookupError(f"missing: {missing}")
        return f"{len(files.TABLES)} tables"

    def models() -> str:
        rows = lambda names, col: spark.createDataFrame([(n,) for n in names], f"{col} string")
        missing = sorted(r[0] for r in events.missing_models(rows(needed, "name"), rows(a.pulled, "pulled")).collect())
        if missing:
            raise LookupError(f"missing: {missing}")
        return f"{len(needed)} models present"

    def depths() -> str:
        counted = queue.depths(spark.table(f"{a.database}.scrape_queue")).orderBy("tier").collect()
        return " ".join(f"tier{r['tier']}={r['depth']}" for r in counted) or "empty"

    failed = 0
    for name, check in (("tables", tables), ("scratch", lambda: scratch.folder(spark)), ("models", models), ("queue", depths)):
        try:
            print(f"  {name:<10} OK    {check()}")
        except Exception as e:
            failed = 1
            print(f"  {name:<10} FAIL  {type(e).__name__}: {str(e).splitlines()[0]}")
            if not a.all:
                break
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
