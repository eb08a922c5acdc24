"""Exact nearest neighbours by cosine, and an approximate pre-selection for large tables.

A search for one vector sends it to the rows. Query sets and self joins deal rows
into blocks and compare pairs of blocks as matrices, each in a task of its own; a
pair of blocks gives at most k rows a vector, so neither memory nor output grows
with the square of the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendria.functions import vectors

#: Rows of a block of query sets and self joins, and cosines that are held at once.
BLOCK, HELD = 8192, 1 << 21

#: What can be searched: embeddings, their id, and the table and columns that name them.
TABLES = {"events": ("event_embeddings", "event_id", "events", "event_id", "acronym"), "concepts": ("concept_embeddings", "concept_name", "concepts", "name", "name")}


def labelled(found: DataFrame, table: str, names: DataFrame, id_col: str | None = None) -> DataFrame:
    """``found`` with the ``name`` of each hit, '' where the named table has none; an unknown ``table`` is an error."""
    if table not in TABLES:
        raise ValueError(f"unknown table {table!r}")
    _, own, _, key, label = TABLES[table]
    known = names.select(F.col(key).alias("_key"), F.col(label).alias("name"))
    return found.join(known, found[id_col or own] == known["_key"], "left").withColumn("name", F.coalesce("name", F.lit(""))).drop("_key")


def neighbours(rows: DataFrame, query: list[float], k: int, min_cosine: float = -1.0, id_col: str = "event_id", vec_col: str = "vec", dim: int | None = None) -> DataFrame:
    """The ``k`` rows nearest to one vector; a wrong length is an error."""
    if dim is not None and len(query) != dim:
        raise ValueError(f"vector of length {dim} expected, got {len(query)}")
    size = math.sqrt(sum(float(x) ** 2 for x in query))
    q = F.array(*(F.lit(float(x) / size if size else 0.0) for x in query))
    cos = vectors.dot(F.col(vec_col), q) / F.nullif(vectors.norm(F.col(vec_col)), F.lit(0.0))
    scored = rows.withColumn("cosine", cos).filter(F.col("cosine") >= min_cosine)
    return scored.orderBy(F.desc("cosine"), id_col).limit(k)


def verdict(cosine: Column, merge: float = 0.97, grey: float = 0.92) -> Column:
    return F.when(cosine >= merge, "duplicate").when(cosine >= grey, "pending").otherwise("new")


def best_neighbour(queries: DataFrame, rows: DataFrame, id_col: str = "event_id", vec_col: str = "vec", block: int = BLOCK) -> DataFrame:
    """(query_id, neighbour_id, cosine): for each query its nearest other row."""
    return nearest(queries, rows, 1, -1.0, id_col, vec_col, block).drop("rank")


def nearest(queries: DataFrame, rows: DataFrame, k: int, min_cosine: float = -1.0, id_col: str = "event_id", vec_col: str = "vec", block: int = BLOCK) -> DataFrame:
    """(query_id, neighbour_id, cosine, rank): for each query its ``k`` nearest other rows at ``min_cosine`` or more, exactly.

    Both sides are dealt into blocks; every block of queries meets every block of
    rows in a task of its own. Null vectors and zero vectors have no neighbours.
    """
    many_q, many_r = (max(1, math.ceil(x.count() / block)) for x in (queries, rows))

    def dealt(df: DataFrame, asked: bool, own: int, other: int) -> DataFrame:
        mine = F.pmod(F.xxhash64(id_col), F.lit(own)).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        names = ("q", "r") if asked else ("r", "q")
        return df.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), F.lit(asked).alias("asked"), mine.alias(names[0]), each.alias(names[1]))

    tasks = dealt(queries, True, many_q, many_r).unionByName(dealt(rows, False, many_r, many_q))

    def scan(key, table):
        asked = table.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        ids, m = table.column("id").to_numpy(), _units(_matrix(table.column("vec")))
        return _top(ids[asked], m[asked], ids[~asked], m[~asked], k, min_cosine)

    found = tasks.groupBy("q", "r").applyInArrow(scan, "id bigint, neighbour_id bigint, cosine double")
    return _ranked(found, k).withColumnRenamed("id", "query_id")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "neighbour_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _top(ids: np.ndarray, q: np.ndarray, other: np.ndarray, r: np.ndarray, k: int, min_cosine: float) -> pa.Table:
    """The ``k`` nearest rows of each query, ties by id: never more, however many are equal."""
    order = np.argsort(other, kind="stable")
    other, r = other[order], r[order]
    out = [], [], []
    step = max(1, HELD // max(1, len(r)))
    for at in range(0, len(q) if len(r) else 0, step):
        cos = np.nan_to_num(q[at : at + step] @ r.T, nan=-np.inf)
        cos[ids[at : at + step][:, None] == other[None, :]] = -np.inf
        cos[cos < min_cosine] = -np.inf
        edge = np.partition(cos, len(r) - min(k, len(r)), axis=1)[:, len(r) - min(k, len(r))]
        for i in range(len(cos)):
            over, tied = np.flatnonzero(cos[i] > edge[i]), np.flatnonzero(cos[i] == edge[i])
            near = np.concatenate([over, tied[: k - len(over)]]) if np.isfinite(edge[i]) else over
            out[0].append(np.full(len(near), ids[at + i]))
            out[1].append(other[near])
            out[2].append(cos[i, near])
    cat = [np.concatenate(c) if c else np.zeros(0) for c in out]
    return pa.table({"id": cat[0].astype(np.int64), "neighbour_id": cat[1].astype(np.int64), "cosine": cat[2].astype(np.float64)})


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _units(m: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(m, axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(size > 0, m / size, np.nan)


def self_neighbours(rows: DataFrame, k: int, min_cosine: float, n: int | None = None, id_col: str = "event_id", vec_col: str = "vec") -> DataFrame:
    """(id, neighbour_id, cosine, rank): for each row its ``k`` nearest others at ``min_cosine`` or more, exactly."""
    n = rows.count() if n is None else n
    blocks = max(1, math.ceil(n / BLOCK))
    dealt = rows.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tasks = paired.select(F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "vec")

    def compare(key, table):
        lo, hi = (x.as_py() for x in key)
        block, ids = table.column("block").to_numpy(), table.column("id").to_numpy()
        m = _units(_matrix(table.column("vec")))
        a, b = block == lo, block == hi
        return pa.concat_tables([_top(ids[x], m[x], ids[y], m[y], k, min_cosine) for x, y in ([(a, b)] if lo == hi else [(a, b), (b, a)])])

    return _ranked(tasks.groupBy("lo", "hi").applyInArrow(compare, "id bigint, neighbour_id bigint, cosine double"), k)


def close_pairs(rows: DataFrame, min_cosine: float, id_col: str = "event_id", vec_col: str = "vec", planes: list[list[float]] | None = None, width: float = 1.0) -> DataFrame:
    """(a, b, cosine, met), a < b: all pairs at ``min_cosine`` or more, exactly; ``met`` tells whether they share a bucket on one of ``planes``.

    A pair of blocks is a task; its pairs leave as they are found, so a task holds two blocks and ``HELD`` cosines.
    """
    known = rows.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).dropDuplicates()
    blocks = max(1, math.ceil(rows.count() / BLOCK))
    dealt = known.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tasks = paired.select(F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "vec")
    normals = np.array(planes).T if planes else None

    def compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, hi = (x.as_py() for x in key)
        table = pa.Table.from_batches(list(batches))
        block, ids = table.column("block").to_numpy(), table.column("id").to_numpy()
        m = _units(_matrix(table.column("vec")))
        bucket = None if normals is None else np.floor(np.nan_to_num(m) @ normals / width)
        x, y = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        step = max(1, HELD // max(1, len(y)))
        for at in range(0, len(x), step):
            part = x[at : at + step]
            i, j = np.nonzero(m[part] @ m[y].T >= min_cosine)  # a comparison with a missing length is not true
            i, j = part[i], y[j]
            up = ids[i] < ids[j]
            i, j = (i[up], j[up]) if lo == hi else (np.where(up, i, j), np.where(up, j, i))
            for cut in range(0, len(i), HELD >> 3):
                a, b = i[cut : cut + (HELD >> 3)], j[cut : cut + (HELD >> 3)]
                met = np.zeros(len(a), bool) if bucket is None else (bucket[a] == bucket[b]).any(axis=1)
                yield pa.RecordBatch.from_pydict({"a": ids[a], "b": ids[b], "cosine": np.einsum("ij,ij->i", m[a], m[b]), "met": met})

    return tasks.groupBy("lo", "hi").applyInArrow(compare, "a bigint, b bigint, cosine double, met boolean").filter("a < b")


def lsh_pairs(rows: DataFrame, min_cosine: float, id_col: str = "event_id", vec_col: str = "vec", tables: int = 8, seed: int = 7) -> DataFrame:
    """(a, b, cosine) by random-projection hashing of unit vectors, re-ranked exactly; approximate in what it finds, exact in what it says.

    On unit vectors |a - b|^2 = 2 - 2 cos, so a cosine bound is a distance bound.
    """
    return hashed_pairs(rows, min_cosine, id_col, vec_col, tables, seed).filter("met").drop("met")


def hashed_pairs(rows: DataFrame, min_cosine: float, id_col: str = "event_id", vec_col: str = "vec", tables: int = 8, seed: int = 7) -> DataFrame:
    """All close pairs, and whether the hashing of :func:`lsh_pairs` finds them.

    Buckets as wide as twice the reach hold a large part of all rows, so a join on
    buckets would make nearly every pair of rows, some of them eight times; pairs
    are compared by blocks instead, and only the close ones asked for their buckets.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    width = max(2 * math.sqrt(2 - 2 * min_cosine), 0.2)
    first = rows.select(vectors.unit(F.col(vec_col)).alias("u")).filter(F.col("u").isNotNull()).limit(1).select(array_to_vector("u").alias("features"))
    if first.isEmpty():
        return close_pairs(rows, min_cosine, id_col, vec_col)
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=width, numHashTables=tables, seed=seed).fit(first)  # its planes hang on length and seed alone
    planes = [[float(x) for x in v.toArray()] for v in model._java_obj.randUnitVectors()]
    return close_pairs(rows, min_cosine, id_col, vec_col, planes, width)
