"""Repeated passages by a sparse suffix array.

Of every run of ``window`` words the suffix that starts with the least hash of
``k`` words is retained: minimiser positions, chosen by content, so that copies
of a passage retain the same places. A retained suffix governs the windows for
which it was chosen; its stretch runs from the first word of the first of them to
the last word of the last. Stretches that occur twice are repeats whole. Where
suffixes begin alike in different stretches, the suffixes are sorted by what
follows, and again by what goes before; neighbours in either order are compared
word by word, to the right and to the left, and a window is repeated where the
two extensions cover it. A window that neither bound rules out (no neighbour
shares as much to that side) and no neighbour settles is looked up by itself.
So the result is exact: a word is repeated if and only if it lies in a run of
``window`` words that occurs at two places or more, in one document or several.
Equal stretches are told by 128 bits of hash, single windows likewise; all else by
their words.

Size: documents give a row for about every 18th word, with hashes for its first
words and its stretch. Equal stretches are counted with partial aggregation before
anything is sorted, so a group of copies, however large, is one row. Sorting is by
range over suffix and context, so a frequent beginning is split over tasks; the
rows at the borders of ranges, two a task, are compared on the driver. Texts are
read again only for documents that hold a stretch to be compared. Joins back to
the suffixes have one row a key on their other side, so that skewed keys can be
split.

Edge cases: null and empty texts and those under ``window`` words have no
repeats; repeated rows repeat each other and keep a row each; null ids are kept;
extra columns are not read; an empty table gives an empty result; very long
texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalendria.llm.support import broadcast_if_small, drop, staged

BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
PIECE = 1 << 18
#: Contexts that a task sorts and a file holds, about.
CONTEXT_ROWS = 32_768
#: Documents to be read again up to which their keys are broadcast.
BROADCAST_ROWS = 100_000
#: A place and the set of its windows that repeat share one long: so many bits are for windows.
WINDOW_BITS = 35
#: Ends every word of a context: no word holds it, and a shared run of words is a shared beginning of the text.
END = "\t"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Hashes of any run of a text's words, through prefix sums."""

    def __init__(self, text: str | None):
        h = xxhash.xxh64_intdigest
        self.words = (text or "").encode().split()
        words = np.array([h(w) for w in self.words], dtype=np.uint64)
        self.n = len(words)
        up = np.full(self.n + 1, BASE, np.uint64)
        down = np.full(self.n + 1, INVERSE, np.uint64)
        up[0] = down[0] = 1
        self.down = np.cumprod(down, dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(up, dtype=np.uint64)[: self.n], dtype=np.uint64)])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def anchors(r: Rolling, window: int, k: int) -> tuple[np.ndarray, ...]:
    """(position, first window, last window, hash of its k words, hash of its stretch) of each retained suffix."""
    if r.n < window:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    at = np.arange(r.n - k + 1)
    grams = r.of(at, at + k)
    run = window - k + 1
    least = []
    for s in range(0, r.n - window + 1, PIECE):
        view = np.lib.stride_tricks.sliding_window_view(grams[s : s + PIECE + run - 1], run)[:PIECE]
        least.append(np.arange(s, s + len(view)) + view.argmin(axis=1))
    chosen = np.concatenate(least)
    first = np.flatnonzero(np.diff(chosen, prepend=-1))
    last = np.append(first[1:], len(chosen)) - 1
    pos = chosen[first]
    return pos, first, last, grams[pos], r.of(first, last + window)


def retained(docs: DataFrame, window: int, k: int, text_col: str, id_col: str) -> DataFrame:
    """(doc_id, tkey, pos, lo, hi, g, ext) for each retained suffix, and for each row one at position -1 with its number of words as ``lo``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part, rows, cols = b.slice(at, 256), [], []
                for i, x in enumerate(part.column(2)):
                    r = Rolling(x.as_py())
                    pos, lo, hi, g, ext = anchors(r, window, k)
                    cols.append((np.append(pos, -1), np.append(lo, r.n), np.append(hi, r.n), np.append(g, np.uint64(0)), np.append(ext, np.uint64(0))))
                    rows.append(np.full(len(pos) + 1, i))
                take = pa.array(np.concatenate(rows))
                out = [np.concatenate(c) for c in zip(*cols, strict=True)]
                arrays = [part.column(0).take(take), part.column(1).take(take)]
                arrays += [pa.array(c.astype(np.int32)) for c in out[:3]] + [pa.array(c.astype(np.uint64).view(np.int64)) for c in out[3:]]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "tkey", "pos", "lo", "hi", "g", "ext"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tkey"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, tkey bigint, pos int, lo int, hi int, g bigint, ext bigint")


CONTEXT = "g bigint, ext bigint, least int, most int, follows binary, precedes binary"


def contexts(docs: DataFrame, asked: DataFrame, n: int, window: int, text_col: str, id_col: str) -> DataFrame:
    """The ``n`` stretches of ``asked`` (g, ext, at) as words: from the suffix on, and before it from right to left.

    A window lies ``least`` to ``most`` words before the suffix.
    """
    named = asked.select("g", "ext", F.col("at.doc_id").alias("_d"), F.col("at.tkey").alias("_t"), F.col("at.pos").alias("pos"), F.col("at.lo").alias("lo"), F.col("at.hi").alias("hi"))
    by_doc = staged(named.groupBy("_d", "_t").agg(F.collect_list(F.struct("g", "ext", "pos", "lo", "hi")).alias("asked")))
    keys = by_doc.select("_d", "_t")
    on = lambda df: df["doc_id"].eqNullSafe(F.col("_d")) & df["tkey"].eqNullSafe(F.col("_t"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tkey"), F.col(text_col).alias("text"))
    held = rows.join(broadcast_if_small(keys, keys.count(), BROADCAST_ROWS), on(rows), "left_semi")
    met = held.join(by_doc, on(held)).select("text", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = END.encode()
        for b in batches:
            for text, asked in zip(b.column(0), b.column(1), strict=True):
                words = text.as_py().encode().split()
                flat = asked.values
                pos, lo, hi = (flat.field(c).to_numpy() for c in ("pos", "lo", "hi"))
                follows = [end.join(words[p : h + window]) + end for p, h in zip(pos, hi, strict=True)]
                precedes = [end.join(words[s:p][::-1]) + end if s < p else b"" for s, p in zip(lo, pos, strict=True)]
                yield pa.RecordBatch.from_arrays([flat.field("g"), flat.field("ext"), pa.array(pos - hi), pa.array(pos - lo), pa.array(follows), pa.array(precedes)], ["g", "ext", "least", "most", "follows", "precedes"])

    # repeated rows give the same stretches again
    out = staged(met.mapInArrow(run, CONTEXT).dropDuplicates(["g", "ext"]), n, CONTEXT_ROWS)
    drop(by_doc)
    return out


def shared(a: bytes, b: bytes) -> int:
    """How many words two contexts share from their beginning."""
    end = END.encode()
    if a == b:
        return a.count(end)
    m = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8, m), np.frombuffer(b, np.uint8, m)
    differ = np.flatnonzero(x != y)
    return a.count(end, 0, int(differ[0]) if len(differ) else m)


def span_bits(least: int, most: int) -> int:
    return ((1 << (most + 1)) - 1) & ~((1 << max(least, 0)) - 1) if most >= max(least, 0) else 0


def compared(x: dict, y: dict, window: int) -> list[tuple[int, int, int, int, int]]:
    """(g, ext, windows settled, words shared after, words shared before) for both of two neighbours that begin alike."""
    if x["g"] != y["g"]:
        return []
    after, before = shared(x["follows"], y["follows"]), shared(x["precedes"], y["precedes"])
    return [(z["g"], z["ext"], span_bits(max(z["least"], window - after), min(z["most"], before)), after, before) for z in (x, y)]


FOUND = "g bigint, ext bigint, bits bigint, after int, before int"
FIELDS = ["g", "ext", "least", "most", "follows", "precedes"]


def neighbours(rows: DataFrame, first: str, second: str, window: int, n: int) -> tuple[DataFrame, DataFrame]:
    """(g, ext, bits, after, before), and the table behind it, from comparing ``n`` rows that stand side by side by suffix, ``first`` and ``second`` context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, top = TaskContext.get().partitionId(), None, None
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]

        def batch(found: list, edge: list) -> pa.RecordBatch:
            cols = list(zip(*found, strict=True)) if found else [()] * 5
            n = len(found)
            held = [pa.array(list(c) + [None] * len(edge), t) for c, t in zip(cols, kinds, strict=True)]
            border = pa.array([None] * n + [{"part": part, "row": e} for e in edge], BORDER)
            return pa.RecordBatch.from_arrays([*held, border], ["g", "ext", "bits", "after", "before", "border"])

        for b in batches:
            found = []
            for row in b.to_pylist():
                if last is None:
                    top = row
                else:
                    found += compared(last, row, window)
                last = row
            yield batch(found, [])
        if last is not None:
            yield batch([], [top, last])

    row = pa.struct([("g", pa.int64()), ("ext", pa.int64()), ("least", pa.int32()), ("most", pa.int32()), ("follows", pa.binary()), ("precedes", pa.binary())])
    BORDER = pa.struct([("part", pa.int32()), ("row", row)])
    ordered = rows.select(FIELDS).repartitionByRange(max(1, -(-n // CONTEXT_ROWS)), "g", first, second).sortWithinPartitions("g", first, second)
    out = staged(ordered.mapInArrow(run, f"{FOUND}, border struct<part:int,row:struct<{CONTEXT.replace(' ', ':').replace(',:', ',')}>>"))
    edges = {}
    for r in out.filter(F.col("border").isNotNull()).select("border.*").collect():
        edges.setdefault(r["part"], []).append({c: bytes(v) if isinstance(v, bytearray) else v for c, v in r["row"].asDict().items()})
    in_order = [sorted(edges[p], key=lambda e: (e["g"], e[first], e[second])) for p in sorted(edges)]
    across = [x for a, b in zip(in_order, in_order[1:], strict=False) for x in compared(a[-1], b[0], window)]
    inside = out.filter(F.col("border").isNull()).drop("border")
    return inside.unionByName(rows.sparkSession.createDataFrame(across, FOUND)), out


def find_repeats(docs: DataFrame, window: int = 50, k: int = 16, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, spans array<struct<start, end>>) for each row; spans are disjoint runs of word positions, end exclusive."""
    if window - k + 1 > WINDOW_BITS:
        raise ValueError(f"a suffix may govern {WINDOW_BITS} windows at most")
    every = staged(retained(docs, window, k, text_col, id_col))
    suffixes = every.filter(F.col("pos") >= 0)

    # equal stretches count as one; a beginning that occurs once can't repeat
    exts = staged(suffixes.groupBy("g", "ext").agg(F.count(F.lit(1)).alias("times"), F.min_by(F.struct("doc_id", "tkey", "pos", "lo", "hi"), F.struct("tkey", "lo")).alias("at")))
    groups = exts.groupBy("g").agg(F.sum("times").alias("all"), F.count(F.lit(1)).alias("kinds")).filter(F.col("all") > 1)
    live = staged(exts.join(groups, "g").select("g", "ext", "times", "kinds", "at"))
    whole = live.filter(F.col("times") > 1).select("g", "ext", F.lit((1 << WINDOW_BITS) - 1).alias("bits"))

    # different stretches with one beginning: neighbours by what follows and by what goes before
    asked = live.filter(F.col("kinds") > 1)
    n = asked.count()
    rows = contexts(docs, asked, n, window, text_col, id_col)
    after, after_table = neighbours(rows, "follows", "precedes", window, n)
    before, before_table = neighbours(rows, "precedes", "follows", window, n)
    settled = after.unionByName(before).groupBy("g", "ext").agg(F.bit_or("bits").alias("bits"), F.max("after").alias("after"), F.max("before").alias("before"))
    settled = staged(rows.join(settled, ["g", "ext"]).withColumn("may", _bits(F.greatest("least", window - F.col("after"), F.lit(0)), F.least("most", "before"))), n, CONTEXT_ROWS)

    # windows that no neighbour settles and no bound rules out, against all of their group that may repeat
    unclear = settled.filter(F.col("may").bitwiseAND(F.bitwise_not("bits")) != 0).select("g").distinct()
    opened = staged(settled.join(unclear, "g", "left_semi").select("g", "ext", "most", "follows", "precedes", F.col("may").bitwiseOR(F.col("bits")).alias("open")).mapInArrow(_windows(window), "g bigint, ext bigint, off int, w binary"), n)
    twice = opened.groupBy("g", "w").count().filter(F.col("count") > 1).select("g", "w")
    single = opened.join(twice, ["g", "w"]).select("g", "ext", F.expr("shiftleft(1L, off)").alias("bits"))

    marks = whole.unionByName(settled.filter("bits <> 0").select("g", "ext", "bits")).unionByName(single)
    marks = staged(marks.groupBy("g", "ext").agg(F.bit_or("bits").alias("bits")), live.count())
    packed = F.shiftleft(F.col("pos").cast("long"), WINDOW_BITS).bitwiseOR(F.col("bits"))
    hit = suffixes.join(marks, ["g", "ext"]).withColumn("bits", F.col("bits").bitwiseAND(_bits(F.col("pos") - F.col("hi"), F.col("pos") - F.col("lo"))))
    found = hit.groupBy(F.col("doc_id").alias("_d"), F.col("tkey").alias("_t")).agg(F.collect_set(packed).alias("packed")).mapInArrow(_spans(window), f"_d {every.schema['doc_id'].dataType.simpleString()}, _t bigint, spans {SPANS}")
    base = every.filter(F.col("pos") < 0).select("doc_id", "tkey", F.col("lo").cast("long").alias("n_words"))
    out = base.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("tkey").eqNullSafe(F.col("_t")), "left")
    drop(exts, live, rows, after_table, before_table, settled, opened)
    return out.select("doc_id", "n_words", F.coalesce("spans", F.expr(f"cast(array() as {SPANS})")).alias("spans"))


SPANS = "array<struct<start:int,end:int>>"


def _bits(least, most):
    """The set of windows ``least`` to ``most`` words before a suffix, as bits."""
    one = F.lit(1).cast("long")
    up = lambda n: F.call_function("shiftleft", one, n.cast("int"))
    return F.when(most >= least, up(most + 1) - up(least)).otherwise(F.lit(0).cast("long"))


def _windows(window: int):
    """The asked windows of stretches, by 128 bits of their words' hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = END.encode()
        for b in batches:
            out = []
            for r in b.to_pylist():
                words = r["precedes"].split(end)[:-1][::-1] + r["follows"].split(end)[:-1]
                for off in range(r["open"].bit_length()):
                    if r["open"] >> off & 1:
                        at = r["most"] - off
                        out.append((r["g"], r["ext"], off, xxhash.xxh3_128_digest(end.join(words[at : at + window]))))
            cols = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["g", "ext", "off", "w"])

    return run


def _spans(window: int):
    """Disjoint spans out of a document's places and the windows that repeat there; spans that touch become one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = []
            for x in b.column(2):
                v = x.values.to_numpy()
                pos, bits = v >> WINDOW_BITS, v & ((1 << WINDOW_BITS) - 1)
                starts = np.unique(np.concatenate([pos[(bits >> o) & 1 == 1] - o for o in range(WINDOW_BITS)]))
                cut = np.flatnonzero(np.diff(starts) > window)
                first, last = np.append(0, cut + 1), np.append(cut, len(starts) - 1)
                spans.append([{"start": int(starts[i]), "end": int(starts[j]) + window} for i, j in zip(first, last, strict=True)] if len(starts) else [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], ["_d", "_t", "spans"])

    return run
