"""Quality rules: a threshold table compiled into one Spark projection.

A rule is ``(metric, comparison, bound)``. :func:`compile_rules` turns the table
into a single boolean expression over the metric columns, so the whole operator
is a scan and a projection: no user functions, no shuffle, no state that grows.

Edge cases: a null text has no words and fails; an empty text likewise; ids may
be null or repeat, as each row is judged alone and keeps its own result; extra
columns are not read. Very long texts cost n log n in their own words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words, by language.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was on be with by this are at from or an".split(),
    "de": "der die und von zu den des das in ist im mit es ein eine".split(),
    "fr": "le la de et les des un une en du que pour par est".split(),
    "es": "el los las y que de la del se por con un una en".split(),
}

#: The default threshold table. A text is kept if every row holds.
THRESHOLDS: list[tuple[str, str, float]] = [
    ("n_words", ">=", 50),
    ("mean_word_chars", ">=", 3.0),
    ("mean_word_chars", "<=", 7.5),
    ("symbol_ratio", "<=", 0.1),
    ("stop_ratio", ">=", 0.05),
    ("dup_line_ratio", "<=", 0.5),
]

COMPARE = {
    ">=": lambda c, b: c >= F.lit(b),
    "<=": lambda c, b: c <= F.lit(b),
    ">": lambda c, b: c > F.lit(b),
    "<": lambda c, b: c < F.lit(b),
}

SPACE = r"[\x20\x09-\x0D]+"


def compile_rules(rules: list[tuple[str, str, float]]) -> Column:
    """One boolean expression: every rule of the table holds."""
    verdict = F.lit(True)
    for metric, op, bound in rules:
        verdict = verdict & COMPARE[op](F.col(metric), bound)
    return F.coalesce(verdict, F.lit(False))


def repeated_windows(text_windows: Column) -> Column:
    """How many words stand in windows (given as hashes) found twice or more."""
    at = F.transform(text_windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(text_windows)) == F.size(text_windows), F.lit(0)).otherwise(_covered(F.sort_array(at)))


def _covered(ordered: Column) -> Column:
    """Words under the windows whose hash has a neighbour of its own value; the windows are three words."""

    def starts(s: Column) -> Column:
        hit = F.transform(s, lambda x, j: F.when((F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["i"]))
        return F.sort_array(F.array_compact(hit))

    def total(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, j: F.when(j == 0, F.lit(3)).otherwise(F.least(F.lit(3), x - F.get(p, j - 1)))), F.lit(0), lambda a, b: a + b)

    # one-element arrays name the sorted windows and the starts, so that each is computed once
    return F.get(F.transform(F.transform(F.array(ordered), starts), total), F.lit(0))


def measure_quality(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", stop_words: dict[str, list[str]] | None = None) -> DataFrame:
    """The metrics that rules can name, one row for each row of ``docs``."""
    stop = sorted({w for ws in (stop_words or STOP_WORDS).values() for w in ws})
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    split = base.select(
        "doc_id",
        "text",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    counted = split.select(
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: w.isin(stop))).cast("long").alias("n_stop_words"),
        F.transform(
            F.slice(F.arrays_zip("words", F.slice("words", 2, 2**30), F.slice("words", 3, 2**30)), 1, F.greatest(F.size("words") - 2, F.lit(0))),
            lambda x: F.xxhash64(x),
        ).alias("windows"),
    )
    return counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        "n_stop_words",
        repeated_windows(F.col("windows")).cast("long").alias("n_repeat_words"),
    )


def judge_quality(docs: DataFrame, rules: list[tuple[str, str, float]] | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Metrics, ratios and ``passes`` for each row of ``docs``."""
    m = measure_quality(docs, text_col, id_col)
    rated = m.withColumns(
        {
            "mean_word_chars": F.try_divide("word_chars", "n_words"),
            "symbol_ratio": F.try_divide("n_symbols", "n_words"),
            "stop_ratio": F.try_divide("n_stop_words", "n_words"),
            "dup_line_ratio": F.coalesce(F.try_divide("n_dup_lines", "n_lines"), F.lit(0.0)),
        }
    )
    return rated.withColumn("passes", compile_rules(rules or THRESHOLDS))
