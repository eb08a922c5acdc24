"""Inserts and updates as rewrites: the table and a batch in, the table out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What an update does to each column of an event.
OVERWRITTEN = (
    "acronym name edition_year categories is_workshop is_virtual when_raw start_date end_date abstract_deadline paper_deadline where_raw country region india_state "
    "origin_url raw_tags quality_flags quality_severity scrape_session_id"
).split()
PROTECTED = "official_url notification camera_ready rank description submission_system sponsor_names".split()
SEED_OVERWRITTEN = "acronym name categories when_raw start_date end_date paper_deadline where_raw raw_tags origin_url edition_year scrape_session_id".split()


def upsert(table: DataFrame, batch: DataFrame, keys: list[str], overwrite: list[str] = (), protect: list[str] = (), special: dict[str, Column] | None = None) -> DataFrame:
    """One full outer join: ``overwrite`` takes the new value, ``protect`` the new unless NULL, all else keeps the old.

    ``special`` has expressions over ``old.<c>`` and ``new.<c>``. The batch has a
    row a key (see :func:`folded`). Columns that the batch lacks stay.
    """
    old, new = table.alias("old"), batch.alias("new")
    on = None
    for k in keys:
        c = F.col(f"old.{k}") == F.col(f"new.{k}")
        on = c if on is None else on & c
    fresh = F.col(f"old.{keys[0]}").isNull()
    out = []
    for c in table.columns:
        o, n = F.col(f"old.{c}"), F.col(f"new.{c}") if c in batch.columns else F.lit(None).cast(table.schema[c].dataType)
        if c in keys:
            v = F.coalesce(o, n)
        elif special and c in special:
            v = special[c]
        elif c in overwrite and c in batch.columns:
            v = F.when(F.col(f"new.{keys[0]}").isNotNull(), n).otherwise(o)
        elif c in protect:
            v = F.coalesce(n, o)
        else:
            v = F.when(fresh, n).otherwise(o)
        out.append(v.alias(c))
    return old.join(new, on, "full_outer").select(*out)


def folded(batch: DataFrame, keys: list[str], seq: str, protect: list[str] = ()) -> DataFrame:
    """A batch in which a key comes several times, as its last row; protected columns take the last value that is not NULL."""
    last = F.struct(seq)
    cols = [c for c in batch.columns if c not in (*keys, seq)]
    aggs = [F.max_by(c, F.when(F.col(c).isNotNull(), last) if c in protect else last).alias(c) for c in cols]
    return batch.groupBy(*keys).agg(*aggs)


def upsert_events(table: DataFrame, batch: DataFrame, at: Column) -> DataFrame:
    """Events by id; kept notes win over new ones; series, source and first scrape of known events never change."""
    special = {}
    if "notes" in table.columns:
        special["notes"] = F.coalesce(F.nullif(F.col("old.notes"), F.lit("")), F.nullif(F.col("new.notes"), F.lit("")), F.lit(""))
        special["notes"] = F.when(F.col("new.event_id").isNull(), F.col("old.notes")).otherwise(special["notes"])
    for c in ("last_checked", "scraped_at"):
        if c in table.columns:
            touched = F.col("new.event_id").isNotNull() if c == "last_checked" else F.col("old.event_id").isNull()
            special[c] = F.when(touched, at).otherwise(F.col(f"old.{c}"))
    return upsert(table, batch, ["event_id"], OVERWRITTEN, PROTECTED, special)


def upsert_seeds(table: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert(table, batch, ["event_id"], SEED_OVERWRITTEN)


def upsert_entities(table: DataFrame, batch: DataFrame, key: str, overwrite: list[str] = ()) -> DataFrame:
    """People, venues, organisations, series: rows with a positive id update, others are inserted under new ids.

    All but ``overwrite`` columns keep their value where the new one is NULL.
    """
    known = batch.filter(F.col(key) > 0)
    new = batch.filter(F.coalesce(F.col(key), F.lit(0)) <= 0)
    rest = [c for c in table.columns if c != key]
    updated = upsert(table, known, [key], list(overwrite), [c for c in rest if c not in overwrite])
    return updated.unionByName(with_new_ids(new, updated, key).select(table.columns))


def with_new_ids(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Ids above the table's greatest. Numbering runs in two steps, counts of hash slots and places inside them, so no task sees all rows."""
    top = table.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    slots = rows.withColumn("_slot", F.pmod(F.xxhash64(*[c for c in rows.columns if c != key]), F.lit(256)))
    before = slots.groupBy("_slot").count()
    before = before.withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    place = F.row_number().over(Window.partitionBy("_slot").orderBy(*[c for c in rows.columns if c != key]))
    return slots.withColumn("_place", place).join(F.broadcast(before), "_slot").withColumn(key, (F.lit(top) + F.col("_before") + F.col("_place")).cast("long")).drop("_slot", "_place", "_before")


def insert_absent(table: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is new, once each; the table's own rows stay."""
    return table.unionByName(batch.dropDuplicates(keys).join(table.select(keys), keys, "left_anti").select(table.columns))


def append(table: DataFrame, rows: DataFrame) -> DataFrame:
    return table.unionByName(rows, allowMissingColumns=True).select(table.columns)


def replace_by_key(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """New rows in place of old ones of the same key, as embeddings are stored."""
    return table.join(rows.select(keys), keys, "left_anti").unionByName(rows.select(table.columns))
