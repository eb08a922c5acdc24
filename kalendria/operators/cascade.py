"""The deterministic shell of the model cascade: coercion, routes, quality flags and fan-out.

Answers come as recorded text; no model is called here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalendria.functions import dates, jsonx, text
from kalendria.functions.wordlists import ESCALATION_REASONS

# Confidence below which a tier hands on, and the tokens a default model takes.
THRESHOLD = {1: 0.85, 2: 0.85}
LONG_CONTEXT = 32_000


def answers(raw: DataFrame, keys: list[str], attempts: int = 2) -> DataFrame:
    """(keys, parsed, failed): the first of a record's attempts that parses, repaired if need be; ``failed`` if none does."""
    tried = raw.filter(F.col("attempt") < attempts).withColumn("json", jsonx.repaired_json_text(F.col("raw")))
    best = tried.groupBy(*keys).agg(F.min_by("json", F.when(F.col("json").isNotNull(), F.col("attempt"))).alias("json"))
    return best.select(*keys, F.try_parse_json("json").alias("parsed"), F.col("json").isNull().alias("failed"))


def tier1_fields(parsed: Column) -> dict[str, Column]:
    f = lambda n, k="string": jsonx.field(parsed, n, k)
    return {
        "is_cfp": jsonx.coerce_bool(f("is_cfp")),
        "is_workshop": jsonx.coerce_bool(f("is_workshop")),
        "is_virtual": jsonx.coerce_bool(f("is_virtual")),
        "categories": jsonx.coerce_categories(f("categories", "array<string>")),
        "confidence": jsonx.coerce_confidence(f("confidence")),
    }


def tier1_route(is_cfp: Column, confidence: Column, failed: Column | None = None) -> Column:
    """audit_only, escalate_2 or tier2; an answer that never parsed escalates."""
    route = F.when(~is_cfp, "audit_only").when(confidence < THRESHOLD[1], "escalate_2").otherwise("tier2")
    return route if failed is None else F.when(failed, "escalate_2").otherwise(route)


def tier1_reason(is_cfp: Column, confidence: Column, failed: Column | None = None) -> Column:
    low = F.when(is_cfp & (confidence < THRESHOLD[1]), "low_confidence")
    return low if failed is None else F.when(failed, "json_parse_fail").otherwise(low)


def tier2_model(tokens: Column, has_default: Column, has_long: Column) -> Column:
    """default, long_context, or escalate_4 / escalate_3 where the needed one is missing."""
    return F.when(tokens > LONG_CONTEXT, F.when(has_long, "long_context").otherwise("escalate_4")).otherwise(F.when(has_default, "default").otherwise("escalate_3"))


def least_confidence(*rounds: Column) -> Column:
    """Over the rounds that ran; 0 if none did."""
    return F.coalesce(F.array_min(F.array_compact(F.array(*rounds))), F.lit(0.0))


def tier2_route(severity: Column, confidence: Column) -> Column:
    return F.when(severity == "block", "escalate_4").when(confidence < THRESHOLD[2], "escalate_3").otherwise("persist")


def tier2_reason(severity: Column, confidence: Column) -> Column:
    return F.when(severity == "block", "quality_block").when(confidence < THRESHOLD[2], "low_confidence")


def tier2_rounds(answers: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """(record_id, confidence, severity, route, reason) from parsed answers by (record_id, round).

    Rounds 1 to 3 and each sponsor's round 4 count with their confidence, failed
    sponsors not at all; round 5 judges. A failed round 1, 2, 3 or 5 escalates. A
    record in ``duplicates`` (record_id, duplicate_of) ends after round 1.
    """
    conf = F.when((F.col("round") < 5) & ~F.col("failed"), jsonx.coerce_confidence(jsonx.field(F.col("parsed"), "confidence")))
    got = answers.groupBy("record_id").agg(
        F.min(conf).alias("confidence"),
        F.max(F.when(F.col("round") == 5, jsonx.field(F.col("parsed"), "severity"))).alias("severity"),
        F.bool_or(F.col("failed") & F.col("round").isin(1, 2, 3, 5)).alias("broken"),
    )
    sev, c = F.coalesce("severity", F.lit("ok")), F.coalesce("confidence", F.lit(0.0))
    if duplicates is not None:
        first = answers.filter("round = 1").groupBy("record_id").agg(F.max(conf).alias("c1"), F.bool_or("failed").alias("f1"))
        hit = duplicates.join(first, "record_id").filter(~F.col("f1")).select("record_id", "duplicate_of", "c1")
        got = got.join(hit, "record_id", "left")
        dup = F.col("duplicate_of").isNotNull()
        return got.select(
            "record_id",
            F.when(dup, F.col("c1")).otherwise(c).alias("confidence"),
            F.when(dup, "ok").otherwise(sev).alias("severity"),
            F.when(dup, "collapse").when(F.col("broken"), "escalate_3").otherwise(tier2_route(sev, c)).alias("route"),
            F.when(~dup, F.when(F.col("broken"), "json_parse_fail").otherwise(tier2_reason(sev, c))).alias("reason"),
            "duplicate_of",
        )
    return got.select(
        "record_id",
        c.alias("confidence"),
        sev.alias("severity"),
        F.when(F.col("broken"), "escalate_3").otherwise(tier2_route(sev, c)).alias("route"),
        F.when(F.col("broken"), "json_parse_fail").otherwise(tier2_reason(sev, c)).alias("reason"),
    )


def to_event(parsed: Column) -> list[Column]:
    """The typed fields of an event out of round 1's answer."""
    s = lambda n: jsonx.coerce_str(jsonx.field(parsed, n))
    named = lambda n, size: F.substring(F.coalesce(s(n), F.lit("UNKNOWN")), 1, size).alias(n)
    strings = "when_raw where_raw country region india_state description rank official_url submission_system".split()
    days = "start_date end_date abstract_deadline paper_deadline notification camera_ready".split()
    return [
        named("acronym", 64),
        named("name", 512),
        jsonx.coerce_int(jsonx.field(parsed, "edition_year")).alias("edition_year"),
        jsonx.coerce_categories(jsonx.field(parsed, "categories", "array<string>")).alias("categories"),
        *(jsonx.coerce_bool(jsonx.field(parsed, n)).alias(n) for n in ("is_workshop", "is_virtual")),
        *(s(n).alias(n) for n in strings),
        *(dates.iso_date(jsonx.field(parsed, n)).alias(n) for n in days),
        *(jsonx.coerce_str_list(jsonx.field(parsed, n, "array<string>")).alias(n) for n in ("sponsor_names", "raw_tags")),
    ]


def fan_out(answers: DataFrame, entity: str, fields: list[str], key: str = "record_id") -> DataFrame:
    """A row for each object of the answer's list ``entity``, with the asked fields as text."""
    items = F.explode(jsonx.field(F.col("parsed"), entity, "array<variant>")).alias("item")
    return answers.select(key, items).select(key, *(jsonx.coerce_str(jsonx.field(F.col("item"), f)).alias(f) for f in fields))


def valid_reason(reason: Column) -> Column:
    return reason.isin(ESCALATION_REASONS)


def quality_flags(events: DataFrame, source_text: str | None = None) -> DataFrame:
    """Rule-based flags as a list column: dates out of order, a link not in the source, a journal, a place that contradicts."""
    milestones = [F.col(c) for c in ("abstract_deadline", "paper_deadline", "notification", "camera_ready", "start_date") if c in events.columns]
    flags = [F.when(dates.date_anomaly(*milestones), F.lit("date_anomaly"))]
    if "name" in events.columns:
        flags.append(F.when(text.contains_any(F.col("name"), ["journal", "transactions on", "special issue"]), F.lit("journal_not_conference")))
    if "official_url" in events.columns and source_text:
        flags.append(F.when(~F.col(source_text).contains(F.col("official_url")), F.lit("invented_url")))
    if {"is_virtual", "country"} <= set(events.columns):
        flags.append(F.when(F.col("is_virtual") & F.col("country").isNotNull(), F.lit("location_contradiction")))
    return events.withColumn("flags", F.array_compact(F.array(*flags)))
