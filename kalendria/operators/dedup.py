"""Duplicate events: blocking, candidate pairs, winners, the sweep and lossless merges."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendria.functions.text import normalise_acronym
from kalendria.plans import scratch
from kalendria.plans.components import components

# Columns that a winner takes over from a loser where its own are NULL.
MERGED = (
    "acronym name series_id edition_year categories is_workshop is_virtual when_raw start_date end_date abstract_deadline paper_deadline "
    "notification camera_ready where_raw country region india_state venue_id origin_url official_url submission_system sponsor_names "
    "raw_tags description rank source quality_flags quality_severity"
).split()


#: Rows of a piece of a block at most, about, and pairs that make a task of their own.
PIECE, TASK_PAIRS = 2048, 1 << 24


def keyed_by_acronym(events: DataFrame, acronym: str = "acronym", year: str = "edition_year", id_col: str = "event_id") -> DataFrame:
    """(id, key, year) of rows with a non-empty normalised acronym and a year."""
    keyed = events.select(F.col(id_col).alias("id"), normalise_acronym(F.col(acronym)).alias("key"), F.col(year).alias("year"))
    return keyed.filter((F.col("key") != "") & F.col("year").isNotNull() & F.col("id").isNotNull())


def acronym_pairs(events: DataFrame, acronym: str = "acronym", year: str = "edition_year", id_col: str = "event_id") -> DataFrame:
    """(a, b), a < b: rows that share a non-empty normalised acronym and a year. Every pair of a block is a result of this operator."""
    return block_pairs(keyed_by_acronym(events, acronym, year, id_col)).select("x.a", "y.b")


def block_pairs(keyed: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """(x, y): structs (a, ...) and (b, ...) of an id and the ``carried`` columns, for every two rows a < b of a (key, year).

    Blocks are cut into pieces and each two of pieces are dealt by themselves,
    so a large block is many tasks and none holds more than two pieces of it. Ids
    are not NULL.
    """
    sizes = keyed.groupBy("key", "year").agg(F.count(F.lit(1)).alias("_n"))
    made = sizes.agg(F.sum(F.col("_n").cast("double") * F.col("_n"))).first()[0] or 0
    least = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, int(made // TASK_PAIRS) + 1)
    cut = keyed.join(sizes.filter(F.col("_n") > 1), ["key", "year"]).withColumn("_of", F.ceil(F.col("_n") / PIECE).cast("int"))
    own = cut.withColumn("_own", F.pmod(F.xxhash64("id"), "_of").cast("int")).withColumn("_row", F.struct("id", *carried) if carried else F.col("id"))
    one = own.select("key", "year", F.col("_own").alias("_p"), F.explode(F.sequence("_own", F.col("_of") - 1)).alias("_q"), F.lit(True).alias("_first"), "_row")
    two = own.select("key", "year", F.explode(F.sequence(F.lit(0), "_own")).alias("_p"), F.col("_own").alias("_q"), F.lit(False).alias("_first"), "_row")
    both = one.unionByName(two).repartition(tasks, "key", "year", "_p", "_q")
    met = both.groupBy("key", "year", "_p", "_q").agg(F.collect_list(F.when(F.col("_first"), F.col("_row"))).alias("_xs"), F.collect_list(F.when(~F.col("_first"), F.col("_row"))).alias("_ys"))
    pairs = met.select((F.col("_p") < F.col("_q")).alias("_two"), "_ys", F.explode("_xs").alias("_x")).select("_two", "_x", F.explode("_ys").alias("_y"))
    ids = [F.col(f"{c}.id" if carried else c) for c in ("_x", "_y")]
    up = ids[0] < ids[1]
    pairs = pairs.filter(F.col("_two") | up)
    pick = lambda k, first: F.when(up if first else ~up, F.col(f"_x.{k}")).otherwise(F.col(f"_y.{k}"))
    x, y = (F.struct(end(*ids).alias(to), *(pick(k, to == "a").alias(k) for k in carried)) for end, to in ((F.least, "a"), (F.greatest, "b")))
    return pairs.select(x.alias("x"), y.alias("y"))


def united_pairs(ann: DataFrame, blocked: DataFrame) -> DataFrame:
    """(a, b, is_ann, is_acronym, cosine), once each with a < b."""
    lo, hi = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    one = ann.select(lo, hi, F.lit(True).alias("is_ann"), F.lit(False).alias("is_acronym"), F.col("cosine"))
    two = blocked.select(lo, hi, F.lit(False).alias("is_ann"), F.lit(True).alias("is_acronym"), F.lit(None).cast("double").alias("cosine"))
    return one.unionByName(two).groupBy("a", "b").agg(F.max("is_ann").alias("is_ann"), F.max("is_acronym").alias("is_acronym"), F.max("cosine").alias("cosine"))


def pick_winners(pairs: DataFrame, standing: DataFrame) -> DataFrame:
    """(a, b, winner, loser): more confidence wins, then the later scrape, then the smaller id."""
    s = lambda side: standing.select(F.col("event_id").alias(side), F.struct("confidence", "scraped_at", (-F.col("event_id")).alias("minus")).alias(f"{side}_rank"))
    met = pairs.join(s("a"), "a").join(s("b"), "b")
    first = F.col("a_rank") > F.col("b_rank")
    return met.withColumns({"winner": F.when(first, F.col("a")).otherwise(F.col("b")), "loser": F.when(first, F.col("b")).otherwise(F.col("a"))}).drop("a_rank", "b_rank")


def sweep(pairs: DataFrame, standing: DataFrame, merge: float = 0.97, grey: float = 0.92) -> DataFrame:
    """(a, b, verdict, winner, loser, reason, cosine, seq): what one greedy pass in pair order decides.

    A pair is skipped if one side has lost already. Only pairs at ``merge`` or more
    make losers, so they alone are walked; ``seq`` is their order in a component.
    """
    won = pick_winners(pairs, standing).withColumn("cosine", F.nanvl("cosine", F.lit(None).cast("double")))
    return _judged(won, _lost(won.filter(F.col("cosine") >= merge)), merge, grey)


def _lost(strong: DataFrame) -> DataFrame:
    """(id, at, seq): the pair that makes an id a loser, in a greedy pass over (a, b, loser).

    Pairs of different connected components never touch, so each component is walked on its own.
    """
    stored = scratch.table(strong.select("a", "b", "loser"))
    rooted = stored.join(components(stored).withColumnRenamed("id", "a"), "a")

    def walk(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["a", "b"])
        lost: dict[int, tuple[int, int, int]] = {}
        for n, (a, b, loser) in enumerate(zip(g.a.to_numpy(), g.b.to_numpy(), g.loser.to_numpy(), strict=True), 1):
            if a not in lost and b not in lost:
                lost[loser] = (a, b, n)
        return pd.DataFrame([(k, *v) for k, v in lost.items()], columns=["id", "at_a", "at_b", "seq"])

    found = scratch.table(rooted.groupBy("root").applyInPandas(walk, "id long, at_a long, at_b long, seq long"))
    return found.select("id", F.struct(F.col("at_a").alias("a"), F.col("at_b").alias("b")).alias("at"), "seq")


def _verdicts(a_lost: Column, b_lost: Column, merge: float, grey: float) -> tuple[Column, Column]:
    """Verdict and reason of a pair (a, b, cosine, is_acronym), given at which pairs its sides lost."""
    this, c = F.struct("a", "b"), F.col("cosine")
    gone = F.coalesce(a_lost < this, F.lit(False)) | F.coalesce(b_lost < this, F.lit(False))
    verdict = F.when(gone, "skip").when(c >= merge, "merge").when((c >= grey) | F.col("is_acronym"), "pending").otherwise("none")
    return verdict, F.when(gone, None).when(c >= grey, "sweep").when(F.col("is_acronym"), F.when(c.isNull(), "acronym_match").otherwise("sweep"))


def _judged(won: DataFrame, lost: DataFrame, merge: float, grey: float) -> DataFrame:
    side = lambda c: lost.select(F.col("id").alias(c), F.col("at").alias(f"{c}_lost"), F.col("seq").alias(f"{c}_seq"))
    met = won.join(side("a"), "a", "left").join(side("b"), "b", "left")
    verdict, reason = _verdicts(F.col("a_lost"), F.col("b_lost"), merge, grey)
    seq = F.when(F.col("a_lost") == F.struct("a", "b"), F.col("a_seq")).when(F.col("b_lost") == F.struct("a", "b"), F.col("b_seq"))
    return met.select("a", "b", verdict.alias("verdict"), "winner", "loser", reason.alias("reason"), F.coalesce("cosine", F.lit(0.0)).alias("cosine"), seq.alias("seq"))


def sweep_sides(near: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The union of near pairs (a, b, cosine) and acronym pairs, unmade: (near pairs with their flags, keyed events with the ids they are near to in their own block).

    Near pairs are few, a handful a row; acronym pairs grow with the square of a
    block. So the flags are looked up from the near side, and acronym pairs meet no
    shuffle: each event brings along what must be left out of its pairs.
    """
    keyed = scratch.table(keyed_by_acronym(events))
    side = lambda c: keyed.select(F.col("id").alias(c), F.struct("key", "year").alias(f"{c}_key"))
    once = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cosine").groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    blocks = once.join(side("a"), "a", "left").join(side("b"), "b", "left").withColumn("_same", F.coalesce(F.col("a_key") == F.col("b_key"), F.lit(False)))
    flags = blocks.groupBy("a", "b").agg(F.lit(True).alias("is_ann"), F.max("_same").alias("is_acronym"), F.max("cosine").alias("cosine"))
    ann = scratch.table(flags)
    both = ann.filter("is_acronym").select(F.col("a").alias("id"), F.col("b").alias("_near"))
    both = both.unionByName(both.select(F.col("_near").alias("id"), F.col("id").alias("_near"))).groupBy("id").agg(F.collect_list("_near").alias("near"))
    return ann, keyed.join(both, "id", "left")


def _apart(pairs: DataFrame, keyed: DataFrame) -> DataFrame:
    """Block pairs that are no near pairs, once each."""
    rest = pairs.filter(F.col("x.near").isNull() | ~F.array_contains("x.near", F.col("y.b")))
    if keyed.groupBy("id").count().filter("count > 1").isEmpty():
        return rest
    return rest.withColumns({"_a": F.col("x.a"), "_b": F.col("y.b")}).dropDuplicates(["_a", "_b"])  # an id of several blocks


def united(near: DataFrame, events: DataFrame) -> DataFrame:
    """:func:`united_pairs` of near pairs and the acronym pairs of events, of any number."""
    ann, keyed = sweep_sides(near, events)
    rest = _apart(block_pairs(keyed, ("near",)), keyed)
    return ann.unionByName(rest.select("x.a", "y.b", F.lit(False).alias("is_ann"), F.lit(True).alias("is_acronym"), F.lit(None).cast("double").alias("cosine")))


def swept(near: DataFrame, events: DataFrame, standing: DataFrame, merge: float = 0.97, grey: float = 0.92) -> DataFrame:
    """:func:`sweep` over :func:`united` pairs: standing and losses come with the events, so acronym pairs meet no shuffle either."""
    ann, keyed = sweep_sides(near, events)
    won = pick_winners(ann, standing)
    lost = _lost(won.filter(F.col("cosine") >= merge))
    ranked = standing.select(F.col("event_id").alias("id"), F.struct("confidence", "scraped_at", (-F.col("event_id")).alias("minus")).alias("rank"))
    stood = scratch.table(keyed.join(ranked, "id").join(lost.select("id", F.col("at").alias("lost")), "id", "left"))
    rest = _apart(block_pairs(stood, ("near", "rank", "lost")), stood)
    first = F.col("x.rank") > F.col("y.rank")
    flat = rest.select("x.a", "y.b", F.when(first, F.col("x.a")).otherwise(F.col("y.b")).alias("winner"), F.when(first, F.col("y.b")).otherwise(F.col("x.a")).alias("loser"), F.lit(None).cast("double").alias("cosine"), F.lit(True).alias("is_acronym"), F.col("x.lost").alias("_xl"), F.col("y.lost").alias("_yl"))
    verdict, reason = _verdicts(F.col("_xl"), F.col("_yl"), merge, grey)
    judged = flat.select("a", "b", verdict.alias("verdict"), "winner", "loser", reason.alias("reason"), F.lit(0.0).alias("cosine"), F.lit(None).cast("long").alias("seq"))
    return _judged(won, lost, merge, grey).unionByName(judged)


def sweep_report(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(F.count(F.lit(1)).alias("examined"), F.count_if(F.col("verdict") == "merge").alias("merged"), F.count_if(F.col("verdict") == "pending").alias("queued"))


def pending_rows(verdicts: DataFrame, as_of: Column) -> DataFrame:
    """Pairs for review, in the one shape that reviews have."""
    return verdicts.filter(F.col("verdict") == "pending").select(
        F.lit("existing_pair").alias("kind"), F.col("a").alias("event_id"), F.col("b").alias("other_id"), "cosine", "reason", as_of.alias("ts")
    )


def resolved(links: DataFrame) -> DataFrame:
    """(loser, final): chains of winners that lost later, followed to their end."""
    now = links.select("loser", F.col("winner").alias("final"))
    while True:
        step = links.select(F.col("loser").alias("final"), F.col("winner").alias("further"))
        nxt = now.join(step, "final", "left").select("loser", F.coalesce("further", "final").alias("final"), F.col("further").isNotNull().alias("moved"))
        nxt = scratch.table(nxt)
        now = nxt.select("loser", "final")
        if not nxt.filter("moved").limit(1).count():
            return now


def merge_pairs(events: DataFrame, pairs: DataFrame, reason: str, at: Column) -> DataFrame:
    """The event table after merging (winner, loser) pairs, each row in one pair at most.

    A winner keeps what it has and takes over what it lacks; a FALSE or empty
    list is something. Notes are joined under an audit line. Losers point at
    their winners. Pairs that break the rules end the query.
    """
    cols = [c for c in MERGED if c in events.columns]
    checked = pairs.withColumn("loser", F.when(F.col("winner") != F.col("loser"), F.col("loser")).otherwise(F.raise_error(F.lit("winner and loser are the same"))))
    loser = events.join(checked.withColumnRenamed("loser", "event_id"), "event_id").select(
        F.col("winner").alias("_w"), F.col("event_id").alias("_l"), F.col("superseded_by").alias("_gone"), *(F.col(c).alias(f"_{c}") for c in [*cols, "notes"])
    )
    lost = checked.select(F.col("loser").alias("_lost"), F.col("winner").alias("_by"))
    wide = events.join(loser, F.col("event_id") == F.col("_w"), "left").join(lost, F.col("event_id") == F.col("_lost"), "left")
    wrong = (F.col("_w").isNotNull() & (F.col("superseded_by").isNotNull() | F.col("_gone").isNotNull())) | (F.col("_lost").isNotNull() & F.col("superseded_by").isNotNull())
    note = (
        F.when(F.coalesce("_notes", F.lit("")) == "", F.col("notes"))
        .otherwise(F.concat(F.coalesce("notes", F.lit("")), F.lit("\n--- merged from "), F.col("_l").cast("string"), F.lit(" ---\n"), F.col("_notes")))
    )
    gone = F.concat(F.coalesce("notes", F.lit("")), F.lit("\n[superseded by "), F.col("_by").cast("string"), F.lit(f": {reason}]"))
    new = {c: F.coalesce(c, f"_{c}") for c in cols}
    new["notes"] = F.when(F.col("_lost").isNotNull(), gone).otherwise(note)
    new["superseded_by"] = F.when(wrong, F.raise_error(F.lit("a side is superseded already"))).when(F.col("_lost").isNotNull(), F.col("_by")).otherwise(F.col("superseded_by"))
    if "last_checked" in events.columns:
        new["last_checked"] = F.when(F.col("_w").isNotNull(), at).otherwise(F.col("last_checked"))
    return wide.select(*(new.get(c, F.col(c)).alias(c) for c in events.columns))


def reroute(links: DataFrame, moves: DataFrame, keys: list[str]) -> DataFrame:
    """Bridge rows of losers moved to their winners, unless the winner has the same entity and role (NULL entities are equal, NULL roles are not).

    Rows are keyed anew once and meet in one aggregation.
    """
    moved = links.join(moves.select(F.col("loser").alias("_loser"), F.col("winner").alias("_winner")), links["event_id"] == F.col("_loser"), "left")
    came = F.col("_loser").isNotNull()
    apart = F.when(F.greatest(*(F.col(k).isNull() for k in keys[1:]), F.lit(False)), came)
    target = moved.select(F.coalesce("_winner", "event_id").alias("event_id"), *keys, apart.alias("_apart"), (~came).cast("int").alias("_own"))
    once = target.groupBy("event_id", *keys, "_apart").agg(F.sum("_own").alias("_own"))
    # a winner's own rows stay as many as they were
    again = F.explode(F.array_repeat(F.lit(1), F.greatest("_own", F.lit(1)).cast("int")))
    return once.select("event_id", *keys, again.alias("_n")).drop("_n")


def without(rows: DataFrame, losers: DataFrame) -> DataFrame:
    """Embeddings of rows that still stand."""
    return rows.join(losers, rows["event_id"] == losers["loser"], "left_anti")


def collapse(src_moves: DataFrame, events: DataFrame, at: Column) -> DataFrame:
    """Only the pointer: sources are superseded, nothing is folded."""
    m = src_moves.select(F.when(F.col("winner") != F.col("loser"), F.col("loser")).otherwise(F.raise_error(F.lit("source and target are the same"))).alias("_l"), F.col("winner").alias("_w"))
    return events.join(m, F.col("event_id") == F.col("_l"), "left").withColumn("superseded_by", F.coalesce("_w", "superseded_by")).drop("_l", "_w")


def ranked_candidates(neighbours: DataFrame, k: int = 5) -> DataFrame:
    """Confidence is the cosine; the label tells the first from the rest."""
    w = Window.partitionBy("id").orderBy(F.desc("cosine"), "neighbour_id")
    r = neighbours.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k)
    return r.withColumn("reason", F.when(F.col("n") == 1, "ann_top1").otherwise("ann_topk"))


def acronym_rules(pairs: DataFrame) -> DataFrame:
    """The deterministic part of the review rules, as columns over pairs with both sides' fields."""
    from kalendria.functions.dates import dates_compatible

    return pairs.withColumns(
        {
            "same_acronym": normalise_acronym(F.col("a_acronym")) == normalise_acronym(F.col("b_acronym")),
            "same_year": F.col("a_year").eqNullSafe(F.col("b_year")),
            "dates_fit": dates_compatible(F.col("a_start"), F.col("b_start")),
            "same_country": F.coalesce(F.lower("a_country") == F.lower("b_country"), F.lit(True)),
        }
    )
