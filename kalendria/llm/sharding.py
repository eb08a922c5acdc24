"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record hashes into one of thousands of slots, for good. Only the map from
slots to shards is ever edited: a rebalancing sums the bytes of each slot, lets
every shard keep the slots that fit under the even share, and hands the rest,
largest first, to the emptiest shard. Each edit is stored as a new version.

Sizes: the slot table has ``slots`` rows whatever the input, so the map may be
broadcast and folded in one row; documents are dealt by slot, never by shard,
so no task holds more than one slot's rows at a time.

A record's id and text checksum decide its slot for good. Rows that repeat both
can't be told apart by what they hold; each takes a slot by its place in the
input, so that they spread like others. Equal texts under different ids spread
as well: a group of copies may exceed a shard's even share.

Edge cases: a null text counts 0 bytes and has a null checksum; null ids hash
like any value, mixed with the text's checksum so that they spread; repeated
rows each get a place of their own; an empty table gives an empty result and a
map of empty slots; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kalendria.llm.support import broadcast_if_small, hadoop_path, scratch_dir, staged

SLOTS = 4096
#: Repeated (id, checksum) pairs up to which they are broadcast.
BROADCAST_ROWS = 100_000


def with_slot(docs: DataFrame, slots: int = SLOTS, text_col: str = "text", id_col: str = "doc_id", overhead: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, vslot), a row for each row of ``docs``."""
    text = F.col(text_col)
    base = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.monotonically_increasing_id().alias("place"),
        )
    )
    repeated = base.groupBy(F.col("doc_id").alias("_d"), F.col("text_crc32").alias("_c")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    met = base.join(broadcast_if_small(repeated, repeated.count(), BROADCAST_ROWS), base["doc_id"].eqNullSafe(F.col("_d")) & base["text_crc32"].eqNullSafe(F.col("_c")), "left")
    own = F.when(F.col("_n").isNotNull(), F.col("place"))
    return met.select("doc_id", "size", "text_crc32", F.pmod(F.xxhash64("doc_id", "text_crc32", own), F.lit(slots)).cast("int").alias("vslot"))


def slot_weights(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(vslot, bytes, rows) for every slot, empty ones too."""
    spark = records.sparkSession
    summed = records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    every = spark.range(slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(summed, "vslot", "left").na.fill(0, ["bytes", "rows"])


class SlotMap:
    """A versioned slot-to-shard map below ``path``; versions are never rewritten."""

    def __init__(self, spark: SparkSession, path: str | None = None, slots: int = SLOTS):
        self.spark, self.path, self.slots = spark, path or scratch_dir(spark), slots

    def versions(self) -> list[int]:
        fs, p = hadoop_path(self.spark, self.path)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        done = [n for n in names if n.startswith("version=") and fs.exists(hadoop_path(self.spark, f"{self.path}/{n}/_SUCCESS")[1])]
        return sorted(int(n[8:]) for n in done)

    def read(self, version: int | None = None) -> DataFrame:
        """(vslot, shard) of a version, the last by default."""
        v = self.versions()[-1] if version is None else version
        return self.spark.read.schema("vslot int, shard int").parquet(f"{self.path}/version={v}")

    def _store(self, df: DataFrame) -> int:
        """Writes the next version under a number that one writer alone can claim."""
        v = (self.versions() or [-1])[-1] + 1
        while not self._claimed(v):
            v += 1
        df.select("vslot", "shard").coalesce(1).write.parquet(f"{self.path}/version={v}")
        return v

    def _claimed(self, v: int) -> bool:
        fs, p = hadoop_path(self.spark, f"{self.path}/_claims/{v}")
        try:
            fs.create(p, False).close()
        except Exception:
            if fs.exists(p):
                return False
            raise
        return True

    def create(self, shards: int) -> int:
        """Version 0: slots dealt in turn."""
        ids = self.spark.range(self.slots)
        return self._store(ids.select(F.col("id").cast("int").alias("vslot"), F.pmod("id", F.lit(shards)).cast("int").alias("shard")))

    def rebalance(self, weights: DataFrame, shards: int) -> int:
        """Stores an edited map: slots beyond a shard's even share move, largest first, to the emptiest shard."""
        now = self.read().join(weights.select("vslot", "bytes"), "vslot").withColumn("shard", F.when(F.col("shard") < shards, F.col("shard")))
        share = (weights.agg(F.sum("bytes")).first()[0] or 0) / shards
        upto = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot").rowsBetween(Window.unboundedPreceding, 0)
        filled = now.withColumn("upto", F.sum("bytes").over(upto))
        marked = filled.withColumn("stays", F.col("shard").isNotNull() & (F.col("upto") <= share))
        # one row of `slots` entries: the fold below is a bounded greedy packing
        one = marked.agg(
            F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("kept"),
            F.sort_array(F.collect_list(F.when(~F.col("stays"), F.struct("bytes", "vslot"))), asc=False).alias("moved"),
        )
        empty = F.array_repeat(F.lit(0).cast("long"), shards)
        load = F.aggregate("kept", empty, lambda a, k: _add(a, k["shard"], k["bytes"]))
        start = F.struct(load.alias("load"), F.expr("cast(array() as array<struct<vslot:int,shard:int>>)").alias("to"))

        def place(a, m):
            s = (F.array_position(a["load"], F.array_min(a["load"])) - 1).cast("int")
            step = F.transform(F.array(s), lambda t: F.struct(_add(a["load"], t, m["bytes"]).alias("load"), F.concat(a["to"], F.array(F.struct(m["vslot"].alias("vslot"), t.alias("shard")))).alias("to")))
            return F.get(step, F.lit(0))

        moved = one.select(F.explode(F.aggregate("moved", start, place)["to"]).alias("m")).select("m.vslot", "m.shard")
        return self._store(marked.filter("stays").select("vslot", "shard").unionByName(moved))

    def grow(self, weights: DataFrame, shards: int) -> int:
        """One more shard joins the ``shards`` there are; slots only move towards even loads."""
        return self.rebalance(weights, shards + 1)


def _add(load, at, more):
    return F.transform(load, lambda x, i: F.when(i == at, x + more).otherwise(x))


def assign_shards(docs: DataFrame, shards: int, slots: int = SLOTS, path: str | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, shard, vslot, position), sizes of shards near equal.

    ``position`` runs without gaps from 0 in each shard: the rows before a slot
    in its shard, from the slot table, plus the row's place in its slot.
    """
    records = staged(with_slot(docs, slots, text_col, id_col))
    weights = staged(slot_weights(records, slots))
    slot_map = SlotMap(docs.sparkSession, path, slots)
    if not slot_map.versions():
        slot_map.create(shards)
    version = slot_map.rebalance(weights, shards)
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    places = slot_map.read(version).join(weights, "vslot").select("vslot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    ranked = records.withColumn("rank", F.row_number().over(inside))
    return ranked.join(F.broadcast(places), "vslot").select("doc_id", "size", "text_crc32", "shard", "vslot", (F.col("before") + F.col("rank") - 1).alias("position"))
