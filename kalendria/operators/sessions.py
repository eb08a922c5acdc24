"""Scrape sessions, placeholder events and the audit log, as appended rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalendria.functions.fetching import session_id
from kalendria.operators.upsert import append, with_new_ids


def begin(sessions: DataFrame, machine: str, at: Column, token: Column | None = None) -> DataFrame:
    row = sessions.sparkSession.range(1).select(session_id(at, F.lit(machine), token).alias("session_id"), F.lit(machine).alias("machine"), at.alias("started_at"))
    return append(sessions, row)


def end(sessions: DataFrame, session: str, at: Column, n_events: int) -> DataFrame:
    mine = F.col("session_id") == session
    return sessions.withColumns({"ended_at": F.when(mine, at).otherwise(F.col("ended_at")), "n_events": F.when(mine, F.lit(n_events)).otherwise(F.col("n_events"))})


def minimal_events(events: DataFrame, rows: DataFrame) -> DataFrame:
    """Placeholders under new ids behind the events there are."""
    return append(events, with_new_ids(rows.drop("event_id"), events, "event_id"))


def log_runs(tier_runs: DataFrame, rows: DataFrame) -> DataFrame:
    """Audit rows; an event may be unknown."""
    return append(tier_runs, rows)


def cache_stats(lookups: DataFrame, key: str = "text_hash") -> DataFrame:
    """(size, hits, misses) of a cache that keeps every key: a miss the first time, a hit after that."""
    return lookups.agg(F.countDistinct(key).alias("size"), (F.count(key) - F.countDistinct(key)).alias("hits"), F.countDistinct(key).alias("misses"))
