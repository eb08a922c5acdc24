"""Tables written once to the folder that the cluster shares, and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Only where the session names no shared folder and all its tasks run on this machine, as in tests.
FALLBACK_DIR = "/tmp/checkpoints"


def folder(spark: SparkSession) -> str:
    """A new folder below the shared folder that the cluster names; a cluster that names none is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share: a folder of each machine's own would lose rows")
        base = FALLBACK_DIR
    return f"{base.rstrip('/')}/kalendria-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Hadoop sees them."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


#: Rows that make a file of their own, where a caller knows about how many there are.
FILE_ROWS = 1_000_000


def table(df: DataFrame, rows: int | None = None, each: int = FILE_ROWS) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again.

    Cuts the lineage: a lost executor costs a reread, not a recomputation. The
    files go when the session's JVM ends, or earlier through :func:`drop`. With
    ``rows``, about as many as there are, a file holds ``each`` of them or more:
    a small table does not become as many files as a large one has partitions.
    """
    spark = df.sparkSession
    path = folder(spark)
    (df if rows is None else df.coalesce(max(1, -(-rows // each)))).write.parquet(path)
    fs, p = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._kalendria_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes the files behind :func:`table` results that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_kalendria_path", None)
        if path:
            fs, p = hadoop_path(df.sparkSession, path)
            fs.delete(p, True)
