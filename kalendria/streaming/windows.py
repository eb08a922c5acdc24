"""Windowed counts over event time; the same expressions serve batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _summed(rows: DataFrame, window, by: list[str]) -> DataFrame:
    n = rows.groupBy(window.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return n.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total")


def tumbling(rows: DataFrame, size: str, ts: str = "ts", by: list[str] | None = None) -> DataFrame:
    return _summed(rows, F.window(ts, size), by or [])


def sliding(rows: DataFrame, size: str, step: str, ts: str = "ts", by: list[str] | None = None) -> DataFrame:
    return _summed(rows, F.window(ts, size, step), by or [])


def sessions(rows: DataFrame, gap: str, by: list[str], ts: str = "ts") -> DataFrame:
    return _summed(rows, F.session_window(ts, gap), by)


def watermarked(rows: DataFrame, late: str, ts: str = "ts") -> DataFrame:
    return rows.withWatermark(ts, late)
