"""Merges over the whole table set: events folded, their links moved, their embeddings dropped; and what goes to review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalendria.functions import jsonx
from kalendria.operators.dedup import MERGED, reroute, without
from kalendria.plans import scratch

#: Tables that hang on events by ``event_id``, with the column that names the other side.
LINKS = {"event_people": "person_id", "event_organisations": "org_id"}


def checked(merges: DataFrame, events: DataFrame) -> DataFrame:
    """(winner, loser, seq), ``seq`` being their order; a pair of one event, of an unknown one or of one that is gone ends the query."""
    side = lambda c: events.select(F.col("event_id").alias(c), F.lit(True).alias(f"_{c}"), F.col("superseded_by").isNotNull().alias(f"_{c}_gone"))
    met = merges.select("winner", "loser", "seq").join(side("winner"), "winner", "left").join(side("loser"), "loser", "left")
    fault = (
        F.when(F.col("winner") == F.col("loser"), "winner and loser are the same")
        .when(F.col("_winner").isNull() | F.col("_loser").isNull(), "no such event")
        .when(F.col("_winner_gone") | F.col("_loser_gone"), "a side is superseded already")
    )
    good = lambda c: F.when(fault.isNotNull(), F.raise_error(fault)).otherwise(F.col(c)).alias(c)
    return met.select(good("winner"), good("loser"), "seq")


def descents(merges: DataFrame) -> DataFrame:
    """(event_id, heir, path, last): every loser with each winner above it, and the ``seq`` on the way down; ``last`` marks the winner that stands.

    A round climbs one merge; chains are as long as winners lose in turn.
    """
    up = merges.select(F.col("loser").alias("heir"), F.col("winner").alias("_up"), F.col("seq").alias("_seq"))
    layer = scratch.table(merges.select(F.col("loser").alias("event_id"), F.col("winner").alias("heir"), F.array("seq").alias("path")))
    out = None
    while True:
        met = scratch.table(layer.join(up, "heir", "left"))
        now = met.select("event_id", "heir", "path", F.col("_up").isNull().alias("last"))
        out = now if out is None else out.unionByName(now)
        higher = met.filter("_up IS NOT NULL").select("event_id", F.col("_up").alias("heir"), F.concat(F.array("_seq"), "path").alias("path"))
        if higher.isEmpty():
            return out
        layer = higher


def folded_events(events: DataFrame, merges: DataFrame, family: DataFrame, reason: str, at: Column) -> DataFrame:
    """Events after all merges in order: a winner keeps what it has, then takes from its losers as they came, and from theirs.

    A FALSE or an empty list is something. Notes are joined under audit lines,
    losers point at their winners.
    """
    cols = [c for c in MERGED if c in events.columns]
    child = events.select("event_id", F.coalesce("notes", F.lit("")).alias("_own"), *(F.col(c).alias(f"_{c}") for c in cols))
    given = family.join(child, "event_id").groupBy("heir").agg(
        *(F.min_by(f"_{c}", F.when(F.col(f"_{c}").isNotNull(), F.col("path"))).alias(f"_{c}") for c in cols),
        F.sort_array(F.collect_list(F.struct("path", F.col("event_id").alias("id"), F.col("_own").alias("text")))).alias("_notes"),
    )
    says = lambda n, every: F.exists(every, lambda x: (x["text"] != "") & (F.slice(x["path"], 1, F.size(n["path"])) == n["path"]))
    head = lambda n: F.concat(F.lit("\n--- merged from "), n["id"].cast("string"), F.lit(" ---\n"), n["text"])
    more = F.array_join(F.transform(F.filter("_notes", lambda n: says(n, F.col("_notes"))), head), "")
    lost = merges.select(F.col("loser").alias("_lost"), F.col("winner").alias("_by"))
    wide = events.join(given, events["event_id"] == given["heir"], "left").join(lost, F.col("event_id") == F.col("_lost"), "left")
    told = F.when(F.coalesce(more, F.lit("")) == "", F.col("notes")).otherwise(F.concat(F.coalesce("notes", F.lit("")), more))
    gone = F.concat(F.coalesce(told, F.lit("")), F.lit("\n[superseded by "), F.col("_by").cast("string"), F.lit(f": {reason}]"))
    new = {c: F.coalesce(c, f"_{c}") for c in cols}
    new |= {"notes": F.when(F.col("_lost").isNotNull(), gone).otherwise(told), "superseded_by": F.coalesce("_by", "superseded_by")}
    if "last_checked" in events.columns:
        new["last_checked"] = F.when(F.col("heir").isNotNull(), at).otherwise(F.col("last_checked"))
    return wide.select(*(new.get(c, F.col(c)).alias(c) for c in events.columns))


def merged(tables: dict[str, DataFrame], merges: DataFrame, reason: str, at: Column, fold: bool = True) -> dict[str, DataFrame]:
    """The table set after ``merges`` (winner, loser, seq), a row a loser: events, both kinds of links, runs and embeddings.

    Without ``fold`` events are collapsed: the loser only points at its winner.
    """
    events = tables["events"]
    good = scratch.table(checked(merges, events))
    family = scratch.table(descents(good))
    moves = family.filter("last").select(F.col("event_id").alias("loser"), F.col("heir").alias("winner"))
    pointed = events.join(good.select(F.col("loser").alias("event_id"), F.col("winner").alias("_by")), "event_id", "left").withColumn("superseded_by", F.coalesce("_by", "superseded_by"))
    out = dict(tables)
    out["events"] = folded_events(events, good, family, reason, at) if fold else pointed.select(events.columns)
    for name, key in LINKS.items():
        if name in tables:
            out[name] = reroute(tables[name], moves, [key, "role"])
    if "tier_runs" in tables:
        runs = tables["tier_runs"]
        moved = runs.join(moves, runs["event_id"] == moves["loser"], "left").withColumn("event_id", F.coalesce("winner", "event_id"))
        out["tier_runs"] = moved.select(runs.columns)
    if "event_embeddings" in tables:
        out["event_embeddings"] = without(tables["event_embeddings"], moves)
    return out


def swept(tables: dict[str, DataFrame], verdicts: DataFrame, at: Column) -> dict[str, DataFrame]:
    """The table set after a sweep's merges."""
    return merged(tables, verdicts.filter("verdict = 'merge'").select("winner", "loser", "seq"), "sweep", at)


def incoming_rows(best: DataFrame, merge: float, grey: float, as_of: Column) -> DataFrame:
    """Review rows for vectors whose nearest live event (query_id, neighbour_id, cosine) is near but not near enough."""
    grey_zone = best.filter((F.col("cosine") >= grey) & (F.col("cosine") < merge))
    return grey_zone.select(F.lit("incoming").alias("kind"), F.col("neighbour_id").alias("event_id"), F.col("query_id").alias("incoming_id"), "cosine", F.lit("ann_topk_pending").alias("reason"), as_of.alias("ts"))


def review_payload(event_id: Column, vec: Column) -> Column:
    """An event and its vector as the older review queue takes them."""
    return jsonx.stable_json(event_id=event_id.cast("long"), vec=vec)
