"""What the operators of this subpackage share: scratch tables and set-up."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalendria.plans.scratch import drop, hadoop_path
from kalendria.plans.scratch import folder as scratch_dir
from kalendria.plans.scratch import table as staged

__all__ = ["broadcast_if_small", "documents", "drop", "fold_ascii", "hadoop_path", "lean", "scratch_dir", "staged"]

#: The fixed alphabet pair for lower-casing ASCII letters and nothing else.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """A broadcast hint when the counted ``rows`` are within ``limit``; else a shuffled join."""
    return F.broadcast(df) if rows <= limit else df


def lean(run):
    """The batch function, giving memory it no longer needs back to the system at its end: idle workers keep what their last task took."""

    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def fold_ascii(text):
    """A-Z to a-z; every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
