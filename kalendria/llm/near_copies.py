"""Near copies through SimHash and vantage-point trees, by exact Jaccard similarity of five-word shingles, for the pipeline's stage.

Two documents link when the sets of their word shingles have a Jaccard similarity
of ``SIMILARITY`` or more; a component is named by the smallest id that links reach.

Search: documents of one shingle set become one node with the SimHash fingerprint of
that set. The vantage-point trees of :mod:`simhash` find the fingerprints that agree
within ``RADIUS`` bits, as pairs that span their groups; nodes of one fingerprint are
compared with their neighbours. Each such pair is a link if the whole sets are alike
enough. Texts at a similarity of 0.8 differ in about 10 of 64 bits, where the triangle
bound rules nothing out, so what the trees leave apart is looked up once more: a node's
least hashes under ``BANDS * ROWS`` permutations make ``BANDS`` band values, and nodes
that share one meet (a pair at similarity 0.8 is missed with probability 3e-6, at 0.9
below 1e-12). In a band whose members lie in several components, nodes are put in order
of their next band value, so that the most alike stand side by side, and neighbours of
different components are compared on their whole sets. Bands that are still apart are
joined without loss by prefixes: with shingles in order from rare to frequent, two sets
at ``SIMILARITY`` share one among the first ``n - ceil(0.8 n) + 1`` of either, and the
places at which they share it bound how much they can have in common. Only pairs of
different components are compared.

Size: each distinct fingerprint is dealt 15 times, band values are dealt out for all
nodes, sets only for nodes that share a band or that the trees pair. A band of more
than ``CHAIN`` nodes is ordered in salted parts whose first members make a chain of
their own. In the join by prefixes the members of the component that is most frequent
under a shingle are not compared with each other. What stays quadratic is a group of
texts that share their *rarest* shingles and yet are less alike than ``SIMILARITY``.

Edge cases: words are cut and folded as for SimHash; fewer words than a shingle
make one shingle; null and empty texts, and those of white space, have the empty
set, linked to each other; repeated rows keep a result each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendria.llm import simhash
from kalendria.llm.simhash import BROADCAST_ROWS, one_a_group
from kalendria.llm.support import broadcast_if_small, drop, lean, staged
from kalendria.plans.components import components

SEED = 42
SHINGLE = 5
#: Least similarity of a link, as a fraction of whole numbers.
SIMILARITY = (4, 5)
#: Bits in which fingerprints of a pair differ at most.
RADIUS = 4
#: Edges up to which one task finds the components.
ONE_TASK = 262_144
BANDS, ROWS = 32, 5
#: Nodes of a band that one task orders, about.
CHAIN = 65_536
#: Rows of a file of sets, or of pairs that meet them; of prefixes and pairs; of nodes with their bands.
SET_ROWS, PAIR_ROWS, NODE_ROWS = 4_096, 32_768, 65_536
#: Shingles hashed under all permutations at once, and rows held at once.
SLICE, SOME = 1024, 256

_DRAWN = np.random.default_rng(SEED).integers(0, 1 << 64, (3, BANDS * ROWS), dtype=np.uint64)
_ADD, _TIMES, _BAND = _DRAWN[0][:, None], _DRAWN[1][:, None] | np.uint64(1), _DRAWN[2] | np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit words over all of them (the finaliser of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(w, SEED) for w in words], dtype=np.uint64)
    n = max(1, len(words) - shingle + 1)
    out = np.full(n, min(len(words), shingle), np.uint64)
    for j in range(min(shingle, len(words))):
        out = _mixed(out + hashes[j : j + n])
    return np.unique(out)


def bands(found: np.ndarray) -> np.ndarray:
    """The band values of a set of hashes; none for the empty set."""
    if not len(found):
        return np.zeros(0, np.uint64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), SLICE):
        least = np.minimum(least, ((found[at : at + SLICE][None, :] ^ _ADD) * _TIMES).min(axis=1))
    return _mixed((least * _BAND).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def fingerprint(found: np.ndarray) -> int:
    """The unsigned SimHash of a set of hashes: the bits set in over half of them; 0 for the empty set."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(found), simhash.SLICE):
        ones += np.unpackbits(found[at : at + simhash.SLICE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(found), bitorder="little").view("<u8")[0])


def _node(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes(), SEED)


def prints(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(doc_id, tkey, node, n, fp, bands) for each row: the text's hash, its shingle set's hash, size, fingerprint and band values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, SOME):
                part = b.slice(at, SOME)
                sets = [shingles(x.as_py()) for x in part.column(2)]
                node = np.array([_node(s) for s in sets], dtype=np.uint64).view(np.int64)
                n = np.array([len(s) for s in sets], dtype=np.int32)
                fp = np.array([fingerprint(s) for s in sets], dtype=np.uint64).view(np.int64)
                banded = pa.array([bands(s).view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(node, pa.int64()), pa.array(n, pa.int32()), pa.array(fp, pa.int64()), banded], ["doc_id", "tkey", "node", "n", "fp", "bands"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tkey"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, tkey bigint, node bigint, n int, fp bigint, bands array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame, text_col: str, id_col: str, many: int | None = None) -> DataFrame:
    """(node, shingles), one row for each node of ``wanted`` (doc_id, tkey), which has ``many`` rows."""
    many = wanted.count() if many is None else many

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0):
                s = shingles(x.as_py())
                node = np.array([_node(s)], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array([s.view(np.int64)], pa.list_(pa.int64()))], ["node", "shingles"])

    on = docs[id_col].eqNullSafe(wanted["_id"]) & F.xxhash64(docs[text_col]).eqNullSafe(wanted["_tkey"])
    rows = docs.join(broadcast_if_small(wanted, many, BROADCAST_ROWS), on, "left_semi").select(F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), "node bigint, shingles array<bigint>").dropDuplicates(["node"])


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    up, down = SIMILARITY
    left, right = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").filter(both * (up + down) >= (F.size("sa") + F.size("sb")) * up).select("a", "b")


def _ordered(node: str, other: str) -> list[Column]:
    return [F.least(node, other).alias("a"), F.greatest(node, other).alias("b")]


def _alike_in_size(n: str, m: str) -> Column:
    up, down = SIMILARITY
    return F.least(n, m) * down >= F.greatest(n, m) * up


def _dealt(banded: DataFrame) -> DataFrame:
    """``banded`` (node, n, band, next) where a band has several nodes, with their number and a salted part of the band."""
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    return banded.join(shared, "band").withColumn("salt", F.pmod(F.xxhash64("node"), F.ceil(F.col("m") / CHAIN)))


def _chained(dealt: DataFrame) -> DataFrame:
    """(a, b): neighbours of different roots in the bands of ``dealt`` (node, n, root, band, next, m, salt)."""
    follow = lambda rows, w: rows.select("node", "n", "root", *(F.lead(c).over(w).alias(f"{c}2") for c in ("node", "n", "root")))
    inside = follow(dealt, Window.partitionBy("band", "salt").orderBy("next", "node"))
    heads = dealt.filter(F.col("m") > CHAIN).groupBy("band", "salt").agg(F.min(F.struct("node", "n", "root")).alias("h")).select("band", "salt", "h.*")
    across = follow(heads, Window.partitionBy("band").orderBy("salt"))
    met = inside.unionByName(across).filter(F.col("node2").isNotNull() & (F.col("root") != F.col("root2")) & _alike_in_size("n", "n2"))
    return met.select(*_ordered("node", "node2")).distinct()


def _tree_pairs(nodes: DataFrame, n: int) -> DataFrame:
    """(a, b): nodes whose fingerprints agree within ``RADIUS`` bits, enough of them to span each group of such fingerprints."""
    fps = staged(nodes.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("one")).select("fp", "one.node", "one.n"), n)
    found = staged(simhash.link_edges(fps, fps.count(), RADIUS, direct=True), n)
    left, right = (fps.select(F.col("fp").alias(x), F.col("node").alias(f"node{x}"), F.col("n").alias(f"n{x}")) for x in "ab")
    across = found.join(left, "a").join(right, "b").filter(_alike_in_size("na", "nb")).select(*_ordered("nodea", "nodeb"))
    same = _dealt(nodes.select("node", "n", F.col("fp").alias("band"), F.get("bands", F.lit(0)).alias("next")))
    pairs = staged(across.unionByName(_chained(same.withColumn("root", F.col("node")))).distinct(), n)
    drop(fps, found)
    return pairs


def _least(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ends of the edges (a, b), each once, and the least id of the component of each."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, up = at[: len(a)], at[len(a) :], np.arange(len(ids))
    while True:
        new, low = up.copy(), np.minimum(up[x], up[y])
        np.minimum.at(new, up[x], low)
        np.minimum.at(new, up[y], low)
        while not np.array_equal(far := new[new], new):
            new = far
        if np.array_equal(new, up):
            return ids, ids[up]
        up = new


def _labels(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of an edge: up to ``ONE_TASK`` edges in one task, more round by round, which asks the driver for many more jobs."""
    many = edges.count()
    if many > ONE_TASK:
        return components(edges).select(F.col("id").alias("node"), "root")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if found:
            node, root = _least(*(np.concatenate(x) for x in zip(*found, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])

    return staged(edges.select("a", "b").coalesce(1).mapInArrow(lean(run), "node bigint, root bigint"), many * 2)


def _apart(dealt: DataFrame, edges: DataFrame) -> DataFrame:
    """``dealt`` with roots, where links have not joined the members of a band into one component."""
    labels = _labels(edges)
    named = dealt.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = named.groupBy("band").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).filter("_lo <> _hi").select("band")
    return named.join(open_, "band", "left_semi")


def _prefixed(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): of ``nodes`` (node, n, root) all pairs of different roots that can be similar enough."""
    up, down = SIMILARITY
    many = nodes.count()
    shingled = nodes.join(sets, "node").select("node", "n", "root", F.explode("shingles").alias("t"))
    common = shingled.groupBy("t").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    known = shingled.join(common, "t").groupBy("node", "n", "root").agg(F.sort_array(F.collect_list(F.struct("c", "t"))).alias("ts"))
    # shingles of one set alone come first and need no row
    alone = F.col("n") - F.size("ts")
    prefix = F.col("n") - F.floor((F.col("n") * up + down - 1) / down).cast("int") + 1
    first = known.select("node", "n", "root", alone.alias("alone"), F.posexplode_outer(F.slice("ts", 1, F.greatest(prefix - alone, F.lit(0)))).alias("i", "s")).filter(F.col("i").isNotNull())
    entries = staged(first.select("node", "n", "root", (F.col("alone") + F.col("i") + 1).alias("p"), F.col("s.t").alias("t")), many * 16, PAIR_ROWS)
    per = entries.groupBy("t", "root").agg(F.count(F.lit(1)).alias("k"))
    mixed = per.groupBy("t").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.count(F.lit(1)).alias("roots")).filter("roots > 1").select("t", "main")
    met = staged(entries.join(mixed, "t"), many * 16, PAIR_ROWS)
    few = met.filter("root <> main")
    other = met.select("t", *(F.col(c).alias(f"{c}2") for c in ("node", "n", "root", "p")))
    once = (F.col("root2") == F.col("main")) | (F.col("node") < F.col("node2"))
    reach = (1 + F.least(F.col("n") - F.col("p"), F.col("n2") - F.col("p2"))) * (up + down) >= (F.col("n") + F.col("n2")) * up
    out = few.join(other, "t").filter((F.col("root") != F.col("root2")) & once & _alike_in_size("n", "n2") & reach)
    pairs = staged(out.select(*_ordered("node", "node2")).distinct(), many * 2, PAIR_ROWS)
    drop(entries, met)
    return pairs


def link_edges(docs: DataFrame, nodes: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(a, b): linked nodes, enough of them to reach every member of a component."""
    n = nodes.count()
    close = _tree_pairs(nodes, n)
    following = F.get("bands", (F.col("j") + 1) % BANDS)
    banded = nodes.select("node", "n", "bands", F.posexplode("bands").alias("j", "band")).select("node", "n", "band", following.alias("next"))
    dealt = staged(_dealt(banded))
    met = dealt.select("node").unionByName(close.select(F.col("a").alias("node"))).unionByName(close.select(F.col("b").alias("node"))).distinct()
    wanted = staged(nodes.join(met, "node", "left_semi").select(F.col("who.doc_id").alias("_id"), F.col("who.tkey").alias("_tkey")), n)
    many = wanted.count()
    sets = staged(_sets(docs, wanted, text_col, id_col, many), many, SET_ROWS)
    edges = staged(_links(close, sets), many * 2, SET_ROWS)
    more = staged(_links(_chained(_apart(dealt, edges)), sets), many * 2, SET_ROWS)
    near = edges.unionByName(more)
    left = staged(_apart(dealt, near).select("node", "n", "root").distinct(), many)
    pairs = _prefixed(left, sets)
    out = staged(near.unionByName(_links(pairs, sets)), many * 4, SET_ROWS)
    drop(close, dealt, wanted, sets, edges, more, left, pairs)
    return out


def near_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, tkey, component_id, who) for each row of ``docs``.

    ``who`` (absent, doc_id, tkey) is the row that stands for the component, the
    same for all its members: one of least id, and among them of least text hash.
    """
    rows = staged(prints(docs, text_col, id_col))
    nodes = staged(rows.groupBy("node").agg(F.min("doc_id").alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "tkey")).alias("who"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), rows.count(), NODE_ROWS)
    edges = link_edges(docs, nodes, text_col, id_col)
    labels = _labels(edges)
    rooted = nodes.join(labels, "node", "left").select("node", "rep", "who", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"), F.min("who").alias("who"))
    named = staged(rooted.drop("rep", "who").join(least, "root").select("node", "component_id", "who"), nodes.count())
    drop(nodes, edges)
    return rows.select("doc_id", "tkey", "node").join(named, "node", "left").select("doc_id", "tkey", "component_id", "who")


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of each group of ``docs``: the one of least id (rows without an id only where no member has one)."""
    return one_a_group(docs, near_copies(docs, text_col, id_col), text_col, id_col)
