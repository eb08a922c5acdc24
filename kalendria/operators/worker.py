"""The first tier's flow over fetched pages: failures, unknown sites, and the candidates that go to classification."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalendria.functions import fetching, text
from kalendria.operators.events import parser_for_host
from kalendria.sources import pages as source

# Why a fetch failed, and the reason its job gets.
FAILURES = {"permanent": "fetch_permanent", "robots": "robots_blocked", "timeout": "fetch_timeout"}


def dispatched(pages: DataFrame, registry: DataFrame) -> DataFrame:
    """``pages`` (url, html, error) with ``parser`` and ``kind``; both NULL for sites that none is registered for."""
    found = parser_for_host(pages.withColumn("host", text.host(F.col("url"))), registry)
    return found.withColumn("parser", fetching.parser_of(F.col("module"))).withColumn("kind", F.when(F.col("parser").isNotNull(), source.page_kind(F.col("url"))))


def failures(found: DataFrame) -> DataFrame:
    """(url, destination, reason): pages that were not fetched go to the dead letters, pages of unknown sites to tier 3."""
    reason = F.coalesce(*(F.when(F.col("error") == k, v) for k, v in FAILURES.items()), F.when(F.col("error").isNotNull(), F.lit(FAILURES["permanent"])), F.when(F.col("parser").isNull(), F.lit("unknown_site")))
    return found.select("url", F.when(F.col("error").isNull(), "tier3").otherwise("dead").alias("destination"), reason.alias("reason")).filter("reason IS NOT NULL")


def candidates(found: DataFrame, as_of: date) -> DataFrame:
    """(event_id, origin_url, snippet): each event that a listing names, or a detail page describes, with the text to classify."""
    good = found.filter("error IS NULL")
    listed = source.listings(good.filter("kind = 'listing'"), as_of).select("event_id", "origin_url", text.first_filled(F.col("name"), F.col("origin_url")).alias("snippet"))
    described = source.details(good.filter("kind = 'detail'"), as_of).select("event_id", "origin_url", text.first_filled(F.col("description"), F.col("origin_url")).alias("snippet"))
    return listed.unionByName(described)
