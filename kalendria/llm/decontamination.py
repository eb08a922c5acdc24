"""Benchmark decontamination by winnowing.

Every text is turned into hashes of ``k``-word grams; of each run of ``w``
neighbouring grams the least hash is kept, so any span of ``k + w - 1`` words
that a document shares with a benchmark item leaves the same fingerprint in
both. With k = 6 and w = 5 that is every shared window of ten words. Joined
fingerprints give diagonals (document position minus item position); each is
then extended over the item's words, and only runs of equal words of a whole
window or more count, so hash collisions never show.

Items shorter than a window have no such run of grams: each of their lengths
(at most nine) is joined on the hash of exactly that many words instead.

Sizes: fingerprints of the benchmark are broadcast only up to a counted limit
and shuffled beyond it, and so are the documents' hits. Partial aggregation
precedes the shuffle of hits. Nothing is collected but the short lengths.

Edge cases: null and empty texts have no words and are clean; an item without
words is no window; rows that repeat both id and text give one result row, rows
that share an id with different texts one each; null ids are kept; an item with
a null id marks words but is not listed; extra columns are not read; an empty
benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalendria.llm.support import broadcast_if_small, drop, fold_ascii, staged

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows up to which fingerprints of the benchmark, or candidates of documents, are broadcast.
BROADCAST_ROWS = 100_000
#: A fingerprint is one long: 36 bits of hash, a flag, 27 bits of position (no array of words can be longer).
POSITION_BITS = 28
FLAG = 1 << (POSITION_BITS - 1)
#: Beyond the end of any array.
ALL = 2**30


def words_of(text: Column) -> Column:
    """The words as they are compared."""
    return F.array_remove(F.split(fold_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def rough_words_of(text: Column) -> Column:
    """The same words under the faster lower(): for fingerprints only, as it can equate more words, never fewer, once the final sigma, which depends on what follows a word, is the other."""
    return F.array_remove(F.split(F.translate(F.lower(F.coalesce(text, F.lit(""))), "ς", "σ"), NOT_WORD), "")


def _once(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def winnow(word_hashes: Column, k: int, w: int) -> Column:
    """Packed fingerprints of the array: of each run of ``w`` ``k``-word grams the least, leftmost on ties, once each."""

    def pack(hs: Column) -> Column:
        gram = lambda x, i: F.shiftleft(F.shiftright(F.xxhash64(x, *(F.get(hs, i + j) for j in range(1, k))), POSITION_BITS), POSITION_BITS)
        return F.slice(F.transform(hs, lambda x, i: gram(x, i).bitwiseOR(i.cast("long"))), 1, F.greatest(F.size(hs) - k + 1, F.lit(0)))

    def least(p: Column) -> Column:
        if w == 1:
            return p
        low = F.transform(p, lambda x, i: F.least(x, *(F.get(p, i + j) for j in range(1, w))))
        return F.array_distinct(F.slice(low, 1, F.greatest(F.size(p) - w + 1, F.lit(0))))

    return _once(_once(word_hashes, pack), least)


def find_leaks(
    docs: DataFrame, items: DataFrame, window: int = 10, k: int = 6, text_col: str = "text", id_col: str = "doc_id", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(doc_id, tkey, n_words, item_ids array, spans array<struct<start, len>>) for each document.

    ``spans`` are the runs of document words that lie in windows of items, in
    order, possibly overlapping between items.
    """
    bench = staged(
        items.select(F.col(item_id_col).alias("item_id"), words_of(F.col(item_text_col)).alias("item_words"), rough_words_of(F.col(item_text_col)).alias("rough"))
        .filter(F.size("item_words") > 0)
        .withColumn("ikey", F.xxhash64("item_id", "item_words"))
        .dropDuplicates(["ikey"])
        .withColumn("need", F.least(F.size("item_words"), F.lit(window)))
    )
    short = sorted(r[0] for r in bench.filter(F.col("need") < window).select("need").distinct().collect())
    hashed = lambda words: F.transform(words, lambda x: F.xxhash64(x))
    key = F.shiftright("p", POSITION_BITS).alias("h")
    place = F.col("p").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")

    # the benchmark's fingerprints: full windows are winnowed, shorter items give their one gram
    test = bench.filter(F.col("need") == window).select("ikey", F.explode_outer(winnow(hashed(F.col("rough")), k, window - k + 1)).alias("p"))
    for n in short:
        test = test.unionByName(bench.filter(F.col("need") == n).select("ikey", F.explode_outer(winnow(hashed(F.col("rough")), n, 1)).alias("p")))
    test = staged(test.filter(F.col("p").isNotNull()).select("ikey", key, place.alias("ipos")).distinct())
    n_test = test.count()

    # the documents' fingerprints, and for each document one flagged entry that carries its number of words
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tkey"))
    words = keyed.select("doc_id", "tkey", hashed(rough_words_of(F.col("text"))).alias("hs"))
    size = F.shiftleft(F.shiftright("tkey", POSITION_BITS), POSITION_BITS).bitwiseOR(F.size("hs").cast("long") + FLAG)
    sets = [winnow(F.col("hs"), k, window - k + 1), *(winnow(F.col("hs"), n, 1) for n in short)]
    # explode_outer: explode() would have its array computed again in an inferred filter
    prints = words.select("doc_id", "tkey", F.explode_outer(F.concat(F.array(size), *sets)).alias("p")).select("doc_id", "tkey", key, place.alias("pos"))
    met = prints.join(broadcast_if_small(test, n_test, BROADCAST_ROWS), "h", "left").filter((F.col("pos") >= FLAG) | F.col("ikey").isNotNull())
    is_size = F.col("pos") >= FLAG
    base = staged(
        met.groupBy("doc_id", "tkey").agg(
            F.max(F.when(is_size, F.col("pos") - FLAG)).cast("long").alias("n_words"),
            F.collect_set(F.when(~is_size, F.struct("ikey", (F.col("pos") - F.col("ipos")).alias("diag")))).alias("cand"),
        )
    )

    drop(test)

    # exact check: the documents with candidates meet their own words again, and those of the items
    hits = base.filter(F.size("cand") > 0).select(F.col("doc_id").alias("_d"), F.col("tkey").alias("_t"), "cand")
    on = lambda d, t: F.col(d).eqNullSafe(F.col("_d")) & F.col(t).eqNullSafe(F.col("_t"))
    longest = bench.agg(F.max(F.size("item_words"))).first()[0] or 0
    n_hits = hits.agg(F.sum(F.size("cand"))).first()[0] or 0
    faced = (
        keyed.join(broadcast_if_small(hits, n_hits, BROADCAST_ROWS), on("doc_id", "tkey"))
        .select("_d", "_t", words_of(F.col("text")).alias("words"), "cand")
        .select("_d", "_t", F.transform("cand", lambda c: F.struct(c["ikey"].alias("ikey"), c["diag"].alias("diag"), F.slice("words", F.greatest(c["diag"], F.lit(0)) + 1, F.lit(longest)).alias("facing"))).alias("cand"))
        .select("_d", "_t", F.explode_outer("cand").alias("c"))
        .select("_d", "_t", "c.*")
        .join(broadcast_if_small(bench.select("ikey", "item_id", "item_words", "need"), n_test, BROADCAST_ROWS), "ikey")
    )
    same = F.zip_with(F.slice("item_words", F.greatest(-F.col("diag"), F.lit(0)) + 1, ALL), "facing", lambda a, b: F.coalesce(a == b, F.lit(False)))
    runs = faced.select("_d", "_t", "item_id", _runs(same, F.col("need"), F.greatest("diag", F.lit(0))).alias("runs"))
    hit = F.size("runs") > 0
    found = runs.groupBy("_d", "_t").agg(
        F.sort_array(F.collect_set(F.when(hit, F.col("item_id").cast("string")))).alias("item_ids"),
        _unpacked(F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.when(hit, F.col("runs"))))))).alias("spans"),
    )
    none = {"item_ids": "cast(array() as array<string>)", "spans": "cast(array() as array<struct<start:int,len:int>>)"}
    out = base.join(found, on("doc_id", "tkey"), "left")
    return out.select("doc_id", "tkey", "n_words", *(F.coalesce(c, F.expr(e)).alias(c) for c, e in none.items()))


def _runs(same: Column, need: Column, offset: Column) -> Column:
    """Each run of ``need`` or more equal words, as one long of its start and length in document words.

    Longs are made distinct by hashing; spans as structs would be compared pair by pair.
    """

    def found(s: Column) -> Column:
        on = lambda i: F.coalesce(F.get(s, i), F.lit(False))
        starts = F.array_compact(F.transform(s, lambda x, i: F.when(x & ~on(i - 1), i)))
        ends = F.array_compact(F.transform(s, lambda x, i: F.when(x & ~on(i + 1), i + 1)))
        packed = F.zip_with(starts, ends, lambda a, b: F.when(b - a >= need, F.shiftleft((offset + a).cast("long"), 31) + (b - a)))
        return F.array_compact(packed)

    return _once(same, found)


def _unpacked(runs: Column) -> Column:
    length = (1 << 31) - 1
    return F.transform(runs, lambda r: F.struct(F.shiftright(r, 31).cast("int").alias("start"), r.bitwiseAND(F.lit(length)).cast("int").alias("len")))


def covered_words(spans: Column) -> Column:
    """How many words lie under sorted, possibly overlapping spans."""
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(s["start"], a["end"]))).alias("n"),
        F.greatest(a["end"], s["start"] + s["len"]).alias("end"),
    )
    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda a: a["n"].cast("long"))


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` in whose text no window of an item occurs."""
    found = find_leaks(docs, items, text_col=text_col, id_col=id_col, **options).filter(F.size("spans") > 0)
    bad = staged(found.select(F.col("doc_id").alias("_id"), F.col("tkey").alias("_tkey")))
    on = docs[id_col].eqNullSafe(bad["_id"]) & F.xxhash64(docs[text_col]).eqNullSafe(bad["_tkey"])
    return docs.join(broadcast_if_small(bad, bad.count(), BROADCAST_ROWS), on, "left_anti")
