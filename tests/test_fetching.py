"""Waits, ids, sessions and parser choice."""

from pyspark.sql import functions as F

from kalendria.functions import fetching
from kalendria.operators import sessions


def test_waits_stay_in_bounds(spark):
    d = spark.range(2000).select(fetching.backoff_seconds(F.col("id") % 12, seed=1).alias("b"), fetching.human_delay(3).alias("h"), fetching.backoff_seconds(F.lit(1), F.lit(9999)).alias("r"))
    lo = d.agg(F.min("b"), F.max("b"), F.min("h"), F.max("h"), F.max("r")).first()
    assert 1 <= lo[0] and lo[1] == 600 and 5 <= lo[2] and 15 < lo[3] <= 60 and lo[4] == 600


def test_parsers_and_pairs(spark):
    df = spark.createDataFrame([("p.ieee", ["When", " x ", "Where", "y", "When", "z", "odd"]), ("p.listing", []), (None, None)], "m string, t array<string>")
    got = [tuple(r) for r in df.select(fetching.parser_of(F.col("m")), fetching.pairs_to_map(F.col("t"))).collect()]
    assert got[0] == (None, {"Where": "y", "When": "z"}) and got[1] == ("listing", {}) and got[2][0] is None


def test_sessions(spark):
    at = F.lit("2025-01-02 03:04:05").cast("timestamp")
    empty = spark.createDataFrame([], "session_id string, machine string, started_at timestamp, ended_at timestamp, n_events long")
    one = sessions.begin(empty, "box", at, F.lit("abcdef0123"))
    done = sessions.end(one, "2025-01-02T03:04Z-box-abcdef01", at, 5).first()
    assert done["n_events"] == 5 and done["ended_at"] is not None
    ev = spark.createDataFrame([(7, "A")], "event_id long, acronym string")
    more = sessions.minimal_events(ev, spark.createDataFrame([("B",), ("C",)], "acronym string"))
    assert {r["event_id"] for r in more.collect()} == {7, 8, 9}
    assert tuple(sessions.cache_stats(spark.createDataFrame([("a",), ("a",), ("b",)], "text_hash string")).first()) == (2, 1, 2)
