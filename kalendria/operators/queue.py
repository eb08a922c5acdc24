"""The prioritised job queue as tables: enqueue, pop, leases, routes and counts.

A queue row has job_id, url, tier, score, ts, attempts and metadata; a lease row
has job_id and expires. Times are columns, never the clock.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendria.functions import jsonx
from kalendria.functions.text import canonical_url, host
from kalendria.plans.ranking import numbered

TIERS = (1, 2, 3, 4)
GATE = "30 days"


def score(priority: Column, ts: Column) -> Column:
    """Smaller pops first: priority outweighs time, in whole milliseconds, halves away from zero."""
    t = F.unix_micros(ts)
    millis = F.signum(t) * F.floor((F.abs(t) + 500) / 1000)
    return -priority * F.lit(1e13) + millis.cast("double")


def jobs(requests: DataFrame, gate: bool = True, ttl: str = GATE) -> DataFrame:
    """Requests as queue rows. With the gate, a job passes only if the last one that passed is older than ``ttl``."""
    canonical = canonical_url(F.col("url"))
    tier = F.when(F.col("tier").isin(*TIERS), F.col("tier")).otherwise(F.raise_error(F.lit("no such tier")))
    rows = requests.withColumns({"canonical": canonical, "tier": tier})
    rows = rows.withColumn("job_id", F.substring(F.sha2("canonical", 256), 1, 32)).withColumn("score", score(F.col("priority"), F.col("ts")))
    if not gate:
        return rows
    timed = rows.withColumn("_t", F.unix_millis("ts"))
    passed = _opened(timed, "job_id", "_t", F.expr(f"unix_millis(timestamp_seconds(0) + interval {ttl})"))
    first = F.row_number().over(Window.partitionBy("job_id", "_t").orderBy("ts", "score", "url"))
    return timed.join(passed, ["job_id", "_t"], "left_semi").withColumn("_n", first).filter("_n = 1").drop("_n", "_t")


def _opened(rows: DataFrame, key: str, t: str, step: Column) -> DataFrame:
    """(key, t) at which a gate opens: first, and then not until ``step`` after it last did.

    A request that comes ``step`` or more after the one before always passes, so
    the times fall into bursts between such gaps, and only a burst is followed
    from opening to opening: the one part that a key's own order makes serial.
    """
    w = Window.partitionBy(key).orderBy(t)
    gap = F.coalesce(F.col(t) - F.lag(t).over(w) >= step, F.lit(True))
    bursts = rows.select(key, t).distinct().withColumn("_gap", gap.cast("int")).withColumn("_burst", F.sum("_gap").over(w))
    times = bursts.groupBy(key, "_burst").agg(F.array_sort(F.collect_list(t)).alias("all"), F.first(step).alias("_step"))

    @F.pandas_udf("array<bigint>")
    def opens(every: pd.Series, steps: pd.Series) -> pd.Series:
        def one(ts, step):
            # from each opening straight to the first time that is late enough
            out, at = [], 0
            while at < len(ts):
                out.append(int(ts[at]))
                at = int(np.searchsorted(ts, ts[at] + step))
            return out

        return pd.Series([one(ts, step) for ts, step in zip(every, steps, strict=True)])

    return times.select(key, F.explode_outer(opens("all", "_step")).alias(t))


def pop_order(queue: DataFrame) -> DataFrame:
    """Every job's place in its tier: by score, ties by job id, jobs without a score last. A tier may hold all jobs, so places are counted over ranges."""
    return numbered(queue, ["tier"], [F.asc_nulls_last("score"), F.asc_nulls_last("job_id")], "pop")


def pop(queue: DataFrame, tier: int, n: int, at: Column, lease_seconds: int = 600) -> DataFrame:
    """The next ``n`` jobs of a tier, leased, their attempts counted."""
    first = queue.filter(F.col("tier") == tier).orderBy("score", "job_id").limit(n)
    return first.withColumns({"attempts": F.col("attempts") + 1, "expires": at + F.make_dt_interval(secs=F.lit(lease_seconds))})


def remaining(queue: DataFrame, taken: DataFrame) -> DataFrame:
    return queue.join(taken.select("job_id"), "job_id", "left_anti")


complete = remaining


def fail(jobs: DataFrame, reason: str, escalate_to: Column | None = None) -> DataFrame:
    """Failed jobs with their destination: tier 3 or 4, or the dead letters."""
    to = F.lit(None).cast("int") if escalate_to is None else escalate_to
    checked = F.when(to.isNull() | to.isin(3, 4), to).otherwise(F.raise_error(F.lit("escalation only to tier 3 or 4")))
    return jobs.withColumns({"failure_reason": F.lit(reason), "destination": F.coalesce(F.concat(F.lit("tier"), checked.cast("string")), F.lit("dead"))})


def extend_lease(leases: DataFrame, job_id: str, at: Column, seconds: int) -> DataFrame:
    """A live lease runs on from ``at``; an expired one is an error."""
    mine = F.col("job_id") == job_id
    longer = F.when(F.col("expires") > at, at + F.make_dt_interval(secs=F.lit(seconds))).otherwise(F.raise_error(F.lit("lease expired")))
    return leases.withColumn("expires", F.when(mine, longer).otherwise(F.col("expires")))


def dead_letters(failed: DataFrame) -> DataFrame:
    return failed.filter(F.col("destination") == "dead").orderBy("ts", "job_id")


def requeue(leases: DataFrame, at: Column, expired_only: bool = False) -> DataFrame:
    """Leased jobs back in the queue, without priority; all of them unless ``expired_only``. Attempts are those of the job's own payload."""
    back = leases.filter(F.col("expires") <= at) if expired_only else leases
    return back.withColumns({"score": F.unix_millis(at).cast("double"), "attempts": F.col("attempts") - 1}).drop("expires")


def seeds(seed_urls: DataFrame, external: DataFrame) -> DataFrame:
    """Seed and external links as tier-1 requests with their metadata."""
    meta = F.map_filter(F.create_map(F.lit("source_block"), F.col("kind"), F.lit("category"), F.col("category"), F.lit("letter"), F.col("letter")), lambda k, v: v.isNotNull())
    one = seed_urls.select("url", F.lit(1).alias("tier"), F.lit(0.0).alias("priority"), meta.alias("metadata"))
    two = external.select("url", F.lit(1).alias("tier"), F.lit(0.0).alias("priority"), F.create_map(F.lit("source_block"), F.lit("external")).alias("metadata"))
    return one.unionByName(two)


def new_seeds(requests: DataFrame, known: DataFrame) -> DataFrame:
    """The requests that are new to the queue, once each by canonical link: their count is what seeding adds."""
    keyed = requests.withColumn("canonical", canonical_url(F.col("url")))
    first = keyed.groupBy("canonical").agg(F.min_by(F.struct(*requests.columns), F.struct("priority", "url")).alias("r"))
    return first.join(known.select("canonical"), "canonical", "left_anti").select("canonical", "r.*")


def payloads(rows: DataFrame, at: Column, target: Column | None = None) -> DataFrame:
    """(list, payload): events with their text for tier 2, or with a reason for a target tier; tier 4 has no worker, so its rows go to the dead letters."""
    common = {"event_id": F.col("event_id"), "text": F.col("text"), "source_url": F.col("source_url"), "enqueued_at": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX")}
    if target is None:
        return rows.select(F.lit("queue:tier2").alias("list"), jsonx.stable_json(**common).alias("payload"))
    to = F.when(target == 4, F.lit("dead")).otherwise(F.concat(F.lit("escalate:tier"), target.cast("string")))
    return rows.select(to.alias("list"), jsonx.stable_json(**common, reason=F.col("reason")).alias("payload"))


def encoded(jobs: DataFrame) -> Column:
    """A job as compact JSON with its keys in order."""
    fields = {c: F.col(c) for c in ("job_id", "url", "tier", "attempts", "metadata") if c in jobs.columns}
    return jsonx.stable_json(**fields, enqueued_at=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))


def decoded(raw: Column) -> Column:
    """The job in a payload, a failure's reason left out; a time without a zone is UTC."""
    job = F.from_json(raw, "job_id string, url string, tier int, attempts int, metadata map<string,string>, enqueued_at string")
    return F.struct(*(job[c].alias(c) for c in ("job_id", "url", "tier", "attempts", "metadata")), F.to_timestamp(job["enqueued_at"]).alias("ts"))


def rate_gate(requests: DataFrame, seconds: float) -> DataFrame:
    """``allowed`` for each request: a host passes once, then not again until ``seconds`` after that pass."""
    w = Window.partitionBy("host").orderBy("ts", "seq")
    order = requests.withColumn("host", host(F.col("url"))).withColumn("_t", F.unix_millis("ts"))
    gates = _opened(order, "host", "_t", F.lit(int(seconds * 1000))).withColumn("_open", F.lit(True))
    first = F.row_number().over(Window.partitionBy("host", "_t").orderBy("seq")) == 1
    return order.join(gates, ["host", "_t"], "left").withColumn("allowed", F.coalesce(F.col("_open") & first, F.lit(False))).withColumn("gap_ms", F.col("_t") - F.lag("_t").over(w)).drop("_open", "_t")


def cursors(events: DataFrame) -> DataFrame:
    """Last page of each source."""
    return events.groupBy("source").agg(F.max_by("page", "ts").alias("page"))


def depths(queue: DataFrame) -> DataFrame:
    return queue.groupBy("tier").agg(F.count(F.lit(1)).alias("depth"))


def metrics(events: DataFrame) -> DataFrame:
    return events.groupBy("name").agg(F.sum("value").alias("value"))
