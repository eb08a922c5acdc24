"""The queue as a stream: a gate that admits a job once, and workers as micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kalendria.functions.text import canonical_url
from kalendria.operators.queue import score


def admitted(requests: DataFrame, gate: str = "30 days", ts: str = "ts") -> DataFrame:
    """Requests whose job was not seen within ``gate`` of event time; state is kept by job and expires."""
    rows = requests.withColumn("canonical", canonical_url(F.col("url"))).withColumn("job_id", F.substring(F.sha2("canonical", 256), 1, 32))
    once = rows.withWatermark(ts, gate).dropDuplicatesWithinWatermark(["job_id"])
    return once.withColumn("score", score(F.col("priority"), F.col(ts)))


def worker(jobs: DataFrame, handle: Callable[[DataFrame], DataFrame], done: str, failed: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Runs ``handle`` on each micro-batch; it returns the rows with ``failure_reason`` (NULL if well), which decides their sink.

    A batch that dies is run again from the checkpoint, as a lease that ran out.
    A batch writes to folders of its own number, so running it again changes nothing.
    """

    def each(batch: DataFrame, number: int) -> None:
        ordered = batch.orderBy("score", "job_id")
        out = handle(ordered).persist()
        out.filter(F.col("failure_reason").isNull()).write.mode("overwrite").parquet(f"{done}/batch={number}")
        out.filter(F.col("failure_reason").isNotNull()).write.mode("overwrite").parquet(f"{failed}/batch={number}")
        out.unpersist()

    w = jobs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()
