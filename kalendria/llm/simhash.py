"""SimHash near-duplicates found through vantage-point trees.

Fingerprints: a bit is set if it is set in over half the XXH64 hashes of the
text's word shingles. Two documents link when at most ``radius`` bits differ;
a document's component is named by the smallest id that links reach.

Search: fingerprints are cut into ``PARTS`` parts. Of two that differ in ``radius``
bits, the two parts that differ least differ in no more than :func:`reach` of them:
none for 4 bits and six parts. Every pair of parts is a space with a vantage-point
tree of its own, fitted on a bounded, hash-ordered sample (``SAMPLE``), bounds
chosen so that both branches hold as many points. Each tree deals *every* distinct
fingerprint to the shard of its leaf, and copies it as a query to the shards across
a boundary that the triangle bound can't rule out; within a reach of 0 there are
none. In a shard the tree goes on in memory: a branch is visited only if the query's
distance to the vantage point is within reach of its bound; the last blocks are
compared outright, on whole fingerprints. So the links are exact.

Size: exact copies share a fingerprint and enter once. Each distinct fingerprint is
dealt once a tree, 15 times, whatever their number. A shard reports a forest (an
edge from each linked fingerprint to its local root), never all pairs of a group;
blocks whose members are already connected are skipped. A shard beyond ``BLOCK``
rows is split into salted pieces whose pairs go to tasks of their own. Components
come from label propagation with pointer jumping over that forest, each round
written to the shared folder; only counts and the sample reach the driver.

Edge cases: null and empty texts, and those of white space, have fingerprint 0,
linked like any other; fewer words than a shingle make one shingle; repeated
rows keep a result each; null ids are never a component's name unless the whole
component has none; an empty table gives an empty result; extra columns are not
read; texts are hashed whole, in slices.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalendria.llm.support import broadcast_if_small, drop, staged
from kalendria.plans import components as plans

SEED = 42
#: Parts of a fingerprint; each two of them are the space of a tree.
PARTS = 6
#: Fingerprints the trees are fitted on, at most; all are indexed.
SAMPLE = 131_072
#: Fingerprints of a leaf that a tree aims at, and rows of a shard from which it is split.
LEAF, BLOCK = 16_384, 1_048_576
#: Comparisons below which a block is done outright.
OUTRIGHT = 1 << 16
SLICE = 1 << 16
#: Rows up to which the keys of documents that go are broadcast.
BROADCAST_ROWS = 100_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The unsigned 64-bit SimHash of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        part = words[at : min(n, at + SLICE) + shingle - 1]
        line = b" ".join(part)
        ends = np.cumsum([len(w) + 1 for w in part]) - 1
        starts = [0, *(ends[: len(part) - 1] + 1).tolist()]
        stops = ends[min(shingle, len(part)) - 1 :].tolist()
        h = xxhash.xxh64_intdigest
        hashes = np.array([h(line[a:b], SEED) for a, b in zip(starts, stops, strict=False)], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 4) -> DataFrame:
    """(doc_id, tkey, fp): the text's hash, to tell rows of one id apart, and the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(x.as_py(), shingle) for x in b.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())], ["doc_id", "tkey", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tkey"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, tkey bigint, fp bigint")


def spaces(parts: int = PARTS) -> list[np.uint64]:
    """For each pair of parts, the mask of its bits."""
    cuts = [64 * i // parts for i in range(parts + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [np.uint64(x | y) for x, y in combinations(masks, 2)]


def reach(radius: int, parts: int = PARTS) -> int:
    """Bits in which the two closest parts differ at most when ``radius`` bits differ in all: those of an even spread."""
    each, more = divmod(radius, parts)
    return 2 * each + max(0, more - (parts - 2))


class VantageTree:
    """A vantage-point tree over some bits of fingerprints; leaves are numbered from 0."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.nodes: dict[int, tuple[np.uint64, int]] = {}
        self.leaves: list[int] = []
        self._fit(np.sort(sample), 1, depth)
        self.number = {leaf: i for i, leaf in enumerate(self.leaves)}

    def _fit(self, points: np.ndarray, at: int, depth: int) -> None:
        best = None
        if depth and len(points) >= 16:
            for vantage in points[:: max(1, len(points) // 8)][:8]:
                upto = np.cumsum(np.bincount(np.bitwise_count(points ^ vantage), minlength=65))
                bound = int(np.abs(2 * upto - len(points)).argmin())
                uneven = abs(2 * int(upto[bound]) - len(points))
                if uneven < len(points) and (best is None or uneven < best[0]):
                    best = uneven, vantage, bound
        if best is None:
            self.leaves.append(at)
            return
        _, vantage, bound = best
        self.nodes[at] = vantage, bound
        near = np.bitwise_count(points ^ vantage) <= bound
        self._fit(points[near], 2 * at, depth - 1)
        self._fit(points[~near], 2 * at + 1, depth - 1)

    def deal(self, values: np.ndarray, radius: int, at: int = 1, rows: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows) where ``values[rows]`` may have neighbours within ``radius`` in the leaf."""
        rows = np.arange(len(values)) if rows is None else rows
        if at not in self.nodes:
            if len(rows):
                yield self.number[at], rows
            return
        vantage, bound = self.nodes[at]
        d = np.bitwise_count(values[rows] ^ vantage).astype(np.int32)
        yield from self.deal(values, radius, 2 * at, rows[d <= bound + radius])
        yield from self.deal(values, radius, 2 * at + 1, rows[d > bound - radius])


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, members: np.ndarray) -> None:
        roots = {self.root(int(i)) for i in np.unique(self.up[members])}
        if len(roots) > 1:
            low = min(roots)
            for r in roots:
                self.up[r] = low

    def flat(self) -> np.ndarray:
        while (nxt := self.up[self.up]).tolist() != self.up.tolist():
            self.up = nxt
        return self.up

    def one(self, members: np.ndarray) -> bool:
        up = self.up
        r = up[members]
        while not np.array_equal(nxt := up[r], r):
            r = nxt
        up[members] = r
        return len(r) == 0 or bool((r == r[0]).all())


class Spanning(Forest):
    """A forest that keeps the links which made it: of members to the last one, where they joined two trees."""

    def __init__(self, n: int):
        super().__init__(n)
        self.made: list[tuple[int, int]] = []

    def join(self, members: np.ndarray) -> None:
        last, own, by = int(members[-1]), self.root(int(members[-1])), {}
        heads, at = np.unique(self.up[members], return_index=True)
        for head, i in zip(heads.tolist(), at.tolist(), strict=True):
            by.setdefault(self.root(head), int(members[i]))
        low = min(by)
        for r, member in by.items():
            self.up[r] = low
            if r != own:
                self.made.append((last, member))


def local_links(fps: np.ndarray, own: np.ndarray, space: np.uint64, radius: int) -> np.ndarray:
    """Root of each fingerprint of a shard, by exact links in which one side is the shard's own and the bits of ``space`` are within reach."""
    forest = Forest(len(fps))
    _search(forest, fps, own, space, radius)
    return forest.flat()


def local_pairs(fps: np.ndarray, own: np.ndarray, space: np.uint64, radius: int) -> np.ndarray:
    """Of the links of :func:`local_links` as many pairs as join the same fingerprints; each pair is a link itself."""
    forest = Spanning(len(fps))
    _search(forest, fps, own, space, radius)
    return np.array(forest.made, np.int64).reshape(-1, 2)


def _search(forest: Forest, fps: np.ndarray, own: np.ndarray, space: np.uint64, radius: int) -> None:
    part, near_by = fps & space, reach(radius)

    def outright(p: np.ndarray, q: np.ndarray) -> None:
        rows = max(1, (1 << 20) // max(1, len(q)))
        for at in range(0, len(p), rows):
            some = p[at : at + rows]
            if forest.one(np.concatenate([some, q])):
                continue
            near = np.bitwise_count(fps[some][:, None] ^ fps[q][None, :]) <= radius
            for i in np.flatnonzero(near.sum(axis=1) > (own[some])):  # an own point always meets itself
                forest.join(np.append(q[near[i]], some[i]))

    def visit(p: np.ndarray, q: np.ndarray) -> None:
        if not len(p) or not len(q):
            return
        if len(p) * len(q) <= OUTRIGHT:
            return outright(p, q)
        for k in range(3):
            v = p[(len(p) * (2 * k + 1)) // 6]
            close = np.concatenate([p[np.bitwise_count(fps[p] ^ fps[v]) <= radius], q[np.bitwise_count(fps[q] ^ fps[v]) <= radius]])
            forest.join(np.append(close, v))
            dp = np.bitwise_count(part[p] ^ part[v]).astype(np.int32)
            bound = int(np.median(dp))
            near = dp <= bound
            if 0 < near.sum() < len(p):
                if k == 0 and forest.one(np.concatenate([p, q])):
                    return None
                dq = np.bitwise_count(part[q] ^ part[v]).astype(np.int32)
                visit(p[near], q[dq <= bound + near_by])
                visit(p[~near], q[dq > bound - near_by])
                return None
        if not forest.one(np.concatenate([p, q])):
            outright(p, q)
        return None

    visit(np.flatnonzero(own), np.arange(len(fps)))


def link_edges(nodes: DataFrame, n: int, radius: int, direct: bool = False) -> DataFrame:
    """(a, b): fingerprints and the local roots they link to, over all shards; with ``direct`` pairs that are links themselves, the lesser first."""
    sample = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toArrow().column(0).to_numpy().view(np.uint64)
    depth = max(0, math.ceil(math.log2(max(1, n) / LEAF)))
    masks, near_by = spaces(), reach(radius)
    trees = [VantageTree(sample & m, depth) for m in masks]
    offsets = np.cumsum([0, *(len(t.leaves) for t in trees)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for tree, mask, offset in zip(trees, masks, offsets, strict=False):
                values, home = fps & mask, np.empty(len(fps), np.int64)
                shards = np.empty(len(fps), np.int32)
                for leaf, rows in tree.deal(values, 0):
                    home[rows], shards[rows] = leaf, offset + leaf
                yield pa.RecordBatch.from_arrays([pa.array(shards), pa.array(fps.view(np.int64)), pa.array(np.ones(len(fps), bool))], ["shard", "fp", "own"])
                for leaf, rows in tree.deal(values, near_by) if near_by else ():
                    rows = rows[home[rows] > leaf]  # a pair across leaves meets in the lower one
                    shard = pa.array(np.full(len(rows), offset + leaf, np.int32))
                    yield pa.RecordBatch.from_arrays([shard, pa.array(fps[rows].view(np.int64)), pa.array(np.zeros(len(rows), bool))], ["shard", "fp", "own"])

    dealt = staged(nodes.select("fp").mapInArrow(deal, "shard int, fp bigint, own boolean"), n * len(trees))
    # as many rows as leaves that are over-full, at most
    large = dealt.groupBy("shard").count().filter(F.col("count") > BLOCK).select(F.col("shard").alias("_s"), F.ceil(F.col("count") / BLOCK).cast("int").alias("_p"))
    salted = dealt.join(F.broadcast(large), F.col("shard") == F.col("_s"), "left").select("shard", "fp", "own", F.coalesce("_p", F.lit(1)).alias("pieces"))
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
    # piece i meets piece j in the task (min, max)
    paired = salted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    tasks = paired.select("shard", F.least("salt", "other").alias("lo"), F.greatest("salt", "other").alias("hi"), "fp", "own")

    def links(key, table):
        fps = table.column("fp").to_numpy().view(np.uint64)
        own = table.column("own").to_numpy(zero_copy_only=False).astype(bool)
        space = masks[int(np.searchsorted(offsets, key[0].as_py(), side="right")) - 1]
        if direct:
            a, b = np.sort(fps.view(np.int64)[local_pairs(fps, own, space, radius)], axis=1).T
            return pa.table({"a": a, "b": b})
        roots = local_links(fps, own, space, radius)
        moved = roots != np.arange(len(fps))
        return pa.table({"a": fps[moved].view(np.int64), "b": fps[roots[moved]].view(np.int64)})

    return tasks.groupBy("shard", "lo", "hi").applyInArrow(links, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) for every end of an edge: the least fingerprint of its component."""
    return plans.components(edges).withColumnRenamed("id", "fp")


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, tkey, fp, component_id, who) for each row of ``docs``.

    ``who`` (absent, doc_id, tkey) is the row that stands for the component, the
    same for all its members: one of least id, and among them of least text hash.
    """
    prints = staged(fingerprints(docs, text_col, id_col, shingle))
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "tkey")).alias("who")), prints.count())
    n = nodes.count()
    edges = staged(link_edges(nodes, n, radius), n)
    rooted = nodes.join(components(edges), "fp", "left").select("fp", "rep", "who", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"), F.min("who").alias("who"))
    named = staged(rooted.drop("rep", "who").join(least, "root").select("fp", "component_id", "who"), n)
    drop(nodes, edges)
    return prints.join(named, "fp", "left").select("doc_id", "tkey", "fp", "component_id", "who")


def one_a_group(docs: DataFrame, found: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """The rows of ``docs`` that stand for their groups in ``found`` (doc_id, tkey, who), each (id, text) once.

    Only rows that go, and those of an (id, text) that repeats, are named in the
    joins with the texts; they are broadcast where few. Of rows that repeat an id
    and a text the one whose columns sort first as JSON stays.
    """
    stands = F.col("doc_id").eqNullSafe(F.col("who.doc_id")) & (F.coalesce("tkey", F.lit(0)) == F.coalesce("who.tkey", F.lit(0)))
    named = found.groupBy(F.col("doc_id").alias("_id"), F.col("tkey").alias("_tkey")).agg(F.count(F.lit(1)).alias("_n"), F.bool_or(stands).alias("_stays"))
    odd = staged(named.filter(~F.col("_stays") | (F.col("_n") > 1)))
    twice = odd.filter("_stays")
    # the columns are asked of their tables: documents may have columns of the same names
    on = lambda keys: docs[id_col].eqNullSafe(keys["_id"]) & F.xxhash64(docs[text_col]).eqNullSafe(keys["_tkey"])
    plain = docs.join(broadcast_if_small(odd, odd.count(), BROADCAST_ROWS), on(odd), "left_anti")
    again = docs.join(broadcast_if_small(twice, twice.count(), BROADCAST_ROWS), on(twice), "left_semi")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    first = again.groupBy(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).agg(F.min_by(row, F.to_json(row)).alias("_row"))
    return plain.unionByName(first.select("_row.*"))


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of each group of ``docs``: the one of least id (rows without an id only where no member has one)."""
    return one_a_group(docs, near_duplicates(docs, text_col, id_col, shingle, radius), text_col, id_col)
