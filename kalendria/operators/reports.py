"""Markdown reports out of report rows (acronym, name, category, when, where, deadline, url, ordinal).

Rows are sorted and formatted in Spark; the text of one report, which is small by
its nature, is put together last.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalendria.functions import dates, location
from kalendria.plans.ranking import numbered

# Report texts.
HEADS = {
    False: "| Acronym | Conference | Date | Location | Deadline | Link |\n|:--------|:-----------|:-----|:---------|:---------|:----:|",
    True: "| Acronym | Category | Conference | Date | Location | Deadline | Link |\n|:--------|:---------|:-----------|:-----|:---------|:---------|:----:|",
}
REGIONS = ["USA", "Europe", "UK", "Singapore", "Switzerland"]
TITLES = {
    "AI": "AI — Artificial Intelligence",
    "ML": "ML — Machine Learning & Deep Learning",
    "DevOps": "DevOps & Site Reliability Engineering",
    "Linux": "Linux & Open Source",
    "ChipDesign": "Chip Design — VLSI / EDA / FPGA / Semiconductor",
    "Math": "Mathematics",
    "Legal": "Legal, Cyber Law & Intellectual Property",
}


def line(with_category: bool) -> Column:
    """One table row. Pipes in cells are not escaped."""
    filled = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("N/A"))
    link = F.when(F.coalesce("url", F.lit("")) != "", F.concat(F.lit("[↗]("), F.col("url"), F.lit(")"))).otherwise("—")
    cells = [F.coalesce("acronym", F.lit("—")), *([F.coalesce("category", F.lit(""))] if with_category else []), F.substring(F.coalesce("name", F.lit("")), 1, 70), *(filled(c) for c in ("when", "where", "deadline")), link]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def ranked(rows: DataFrame, as_of: Column, by: list[str] | None = None) -> DataFrame:
    """``section`` (upcoming, past) and ``rank`` in it: upcoming by start, unknown last; past by start, latest first; ties by ordinal."""
    start = dates.start_date(F.col("when"))
    past = F.coalesce(start < as_of, F.lit(False))
    day = F.datediff(F.coalesce(start, F.lit("9999-12-31").cast("date")), F.lit("1970-01-01").cast("date"))
    tagged = rows.withColumns({"section": F.when(past, "past").otherwise("upcoming"), "_key": F.when(past, -day).otherwise(day)})
    w = Window.partitionBy(*(by or []), "section").orderBy("_key", "ordinal")
    return tagged.withColumn("rank", F.row_number().over(w)).drop("_key")


def report(rows: DataFrame, title: str, as_of: str, with_category: bool, found: str = "") -> str:
    """A whole report: title, counts, the upcoming table and the past one."""
    r = ranked(rows, F.lit(as_of).cast("date")).select("section", "rank", line(with_category).alias("line"))
    parts = _gathered(r)
    up, past = parts.get("upcoming", []), parts.get("past", [])
    none = f"_No {{}} conferences{found}._"
    body = lambda name, ls: "\n".join([HEADS[with_category], *ls]) if ls else none.format(name)
    return "\n".join(_top(title, as_of, up, past) + [f"## Upcoming ({len(up)})", "", body("upcoming", up), "", f"## Past ({len(past)})", "", body("past", past)]) + "\n"


def india_report(rows: DataFrame, as_of: str) -> str:
    """As :func:`report`, a table for each state."""
    r = ranked(rows.withColumn("state", location.india_state(F.coalesce("where", F.lit("")))), F.lit(as_of).cast("date"), ["state"])
    got = r.select("section", "state", "rank", line(True).alias("line")).orderBy("section", "state", "rank").collect()
    up, past = ([x for x in got if x["section"] == s] for s in ("upcoming", "past"))
    out = _top("India Conferences — State-wise", as_of, up, past)
    for name, part in (("Upcoming", up), ("Past", past)):
        out += [f"## {name} ({len(part)})", ""]
        for state in dict.fromkeys(x["state"] for x in part):
            out += [f"### {state}", "", HEADS[True], *(x["line"] for x in part if x["state"] == state), ""]
        if not part:
            out.append("_None._")
    return "\n".join(out) + "\n"


def _top(title: str, as_of: str, up: list, past: list) -> list[str]:
    return [f"# {title}", "", f"> Last updated: **{as_of}**  |  Upcoming: **{len(up)}**  |  Past: **{len(past)}**  |  Total: **{len(up) + len(past)}**", ""]


def _gathered(lines: DataFrame) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for r in lines.orderBy("section", "rank").collect():
        out.setdefault(r["section"], []).append(r["line"])
    return out


def write_reports(rows: DataFrame, folder: str, as_of: str) -> list[str]:
    """All reports of rows whose ``categories`` are a list: one a category, one by date, one a region, and India by state."""
    tags = location.location_tags(F.col("where"))
    found = [r[0] for r in rows.select(F.explode("categories").alias("c")).distinct().orderBy("c").collect()]
    texts = {f"{cat.lower()}.md": report(rows.filter(F.array_contains("categories", cat)), TITLES.get(cat, cat), as_of, False) for cat in found}
    texts["by_date.md"] = report(rows, "All Conferences — Sorted by Date", as_of, True)
    for tag in REGIONS:
        texts[f"{tag.lower()}.md"] = report(rows.filter(F.array_contains(tags, tag)), f"{tag} Conferences", as_of, True, " found")
    texts["india.md"] = india_report(rows.filter(F.array_contains(tags, "India")), as_of)
    Path(folder).mkdir(parents=True, exist_ok=True)
    for name, t in texts.items():
        Path(folder, name).write_text(t, encoding="utf-8")
    return sorted(texts)


def report_lines(rows: DataFrame, as_of: str) -> DataFrame:
    """(file, part, state, rank, line): every line of the reports that :func:`write_reports` makes, in one plan, in this order.

    Rows have ``categories`` as a list. They are numbered over ranges, so that no
    report is sorted in one task; only counts by report meet their titles.
    """
    day = F.lit(as_of).cast("date")
    start = dates.start_date(F.col("when"))
    past = F.coalesce(start < day, F.lit(False))
    key = F.datediff(F.coalesce(start, F.lit("9999-12-31").cast("date")), F.lit("1970-01-01").cast("date"))
    tags = location.location_tags(F.col("where"))
    named = lambda names: F.transform(names, lambda n: F.concat(F.lower(n), F.lit(".md")))
    own = F.filter(tags, lambda t: t.isin(*REGIONS, "India"))
    files = F.concat(F.coalesce(named(F.array_distinct("categories")), F.expr("cast(array() as array<string>)")), F.array(F.lit("by_date.md")), named(own))
    told = rows.select("*", F.explode(files).alias("file")).withColumns({"past": past, "_key": F.when(past, -key).otherwise(key)})
    told = told.withColumn("state", F.when(F.col("file") == "india.md", location.india_state(F.coalesce("where", F.lit("")))).otherwise(""))
    wide = F.col("file").isin("by_date.md", "india.md", *(f"{r.lower()}.md" for r in REGIONS))
    lined = told.select("file", "past", "state", "_key", "ordinal", F.when(wide, line(True)).otherwise(line(False)).alias("line"))
    body = numbered(lined, ["file", "past", "state"], [F.asc("_key"), F.asc("ordinal"), F.asc("line")])
    part = F.when(F.col("past"), 3).otherwise(1)

    titles = {"by_date.md": "All Conferences — Sorted by Date", "india.md": "India Conferences — State-wise"} | {f"{r.lower()}.md": f"{r} Conferences" for r in REGIONS}
    given = rows.sparkSession.createDataFrame(list(titles.items()), "file string, title string")
    category = rows.select(F.explode("categories").alias("c")).distinct().select(F.concat(F.lower("c"), F.lit(".md")).alias("file"), F.coalesce(F.create_map(*(F.lit(x) for kv in TITLES.items() for x in kv))[F.col("c")], F.col("c")).alias("title"))
    counts = lined.groupBy("file").agg(F.count_if(~F.col("past")).alias("up"), F.count_if("past").alias("gone"))
    every = given.unionByName(category).join(counts, "file", "left").na.fill(0, ["up", "gone"])
    text = lambda *parts: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))
    up, gone, india = F.col("up"), F.col("gone"), F.col("file") == "india.md"
    region = F.col("file").isin(*(f"{r.lower()}.md" for r in REGIONS))
    none = lambda word: F.when(india, "_None._").otherwise(text(f"_No {word} conferences", F.when(region, " found").otherwise(""), "._"))
    head = F.when(wide, HEADS[True]).otherwise(HEADS[False])
    at = lambda part, n, line: F.struct(F.lit(part).alias("part"), F.lit(n).cast("long").alias("rank"), line.alias("line"))
    start_of = lambda part, word, n: [at(part, -4, text(f"## {word.title()} (", n, ")")), at(part, -3, F.lit("")), at(part, -2, F.when(n == 0, none(word)).when(~india, head))]
    top = [at(0, 0, text("# ", F.col("title"))), at(0, 1, F.lit("")), at(0, 2, text(f"> Last updated: **{as_of}**  |  Upcoming: **", up, "**  |  Past: **", gone, "**  |  Total: **", up + gone, "**")), at(0, 3, F.lit(""))]
    lines = F.array(*top, *start_of(1, "upcoming", up), at(2, 0, F.when(~india, F.lit(""))), *start_of(3, "past", gone))
    frame = every.select("file", F.explode_outer(lines).alias("x")).select("file", "x.part", F.lit("").alias("state"), "x.rank", "x.line").filter("line IS NOT NULL")
    states = lined.filter("file = 'india.md'").select("file", "past", "state").distinct()
    heads = F.array(*(F.struct(F.lit(n).cast("long").alias("rank"), x.alias("line")) for n, x in ((-3, text("### ", F.col("state"))), (-2, F.lit("")), (-1, F.lit(HEADS[True])), (1 << 60, F.lit("")))))
    state_frame = states.select("file", part.alias("part"), "state", F.explode_outer(heads).alias("x")).select("file", "part", "state", "x.rank", "x.line")
    return body.select("file", part.alias("part"), "state", "rank", "line").unionByName(frame).unionByName(state_frame)


def save_reports(rows: DataFrame, folder: str, as_of: str) -> None:
    """All reports below ``folder`` on any file system, a report a folder ``file=<name>`` of text parts whose names sort in the order of their lines."""
    lines = report_lines(rows, as_of).repartitionByRange("file", "part", "state", "rank").sortWithinPartitions("file", "part", "state", "rank")
    lines.select("file", "line").write.mode("overwrite").partitionBy("file").text(folder)


def event_page() -> Column:
    """An event row as its Markdown page. Its headings and labels are fixed values."""
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("TBD"))
    s = lambda c, other="": F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(other))
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    ticked = lambda c: F.array_join(F.transform(c, lambda x: F.concat(F.lit("`"), x, F.lit("`"))), ", ")
    more = lambda name, c, body: F.when(F.size(F.coalesce(c, F.expr("cast(array() as array<string>)"))) > 0, text(f"\n## {name}\n\n", body, "\n"))
    lines = [
        text("# ", F.col("name"), " (", F.col("acronym"), ")"), "",
        text("**Type:** ", F.when(F.col("is_workshop"), "Workshop").otherwise("Conference"), "  "),
        text("**Category:** ", F.array_join("categories", ", "), "  "),
        text("**Year:** ", s("edition_year", "TBD"), "  "),
        text("**Rank:** ", s("rank", "N/A"), "  "),
        text("**Source:** ", F.col("source"), "  "),
        text("**URL:** ", F.coalesce(F.nullif(F.col("official_url"), F.lit("")), F.col("origin_url"), F.lit("")), "  "), "",
        "## Description", "", s("description", "_No description available._"), "",
        "## Deadlines", "", "| Milestone | Date |", "|-----------|------|",
        *(text(f"| {n} | ", day(c), " |") for n, c in (("Abstract deadline", "abstract_deadline"), ("Paper deadline   ", "paper_deadline"), ("Notification     ", "notification"), ("Camera ready     ", "camera_ready"))), "",
        "## Event", "", "| Field | Value |", "|-------|-------|",
        text("| Start    | ", day("start_date"), " |"), text("| End      | ", day("end_date"), " |"),
        text("| Location | ", s("where_raw", "TBD"), " |"), text("| Submission system | ", s("submission_system", "N/A"), " |"), "",
    ]
    body = F.concat_ws("\n", *(F.lit(x) if isinstance(x, str) else x for x in lines))
    notes = F.when(F.coalesce("notes", F.lit("")) != "", text("\n## Notes\n\n", F.col("notes"), "\n"))
    extra = [more("Sponsors", F.col("sponsor_names"), ticked("sponsor_names")), more("Tags", F.col("raw_tags"), ticked("raw_tags")), notes]
    return F.concat(body, *(F.coalesce(e, F.lit("")) for e in extra))
