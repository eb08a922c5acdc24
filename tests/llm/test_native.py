"""Decontamination, sharding and quality rules against brute force, with the edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kalendria.llm import decontamination, quality_rules, sharding
from kalendria.llm.queries import op2_decontamination, op6_sharding, op7_quality_rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute_leaks(text, items):
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        m = min(len(iw), 10)
        for i in range(len(iw) - m + 1) if iw else ():
            for j in range(len(w) - m + 1):
                if w[j : j + m] == iw[i : i + m]:
                    hit |= set(range(j, j + m))
                    if item is not None:
                        ids.add(str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


@pytest.fixture
def tables(spark, tmp_path):
    def write(docs, items=(), extra=False):
        rows = [(*d, "x", 1) for d in docs]
        spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words long").write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return write


def make_texts(seed, n=60):
    r = random.Random(seed)
    vocab = ["a", "B", "cé", "É", "é", "d1", "the", "of"]
    line = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    items = [(i, line(r.choice([1, 3, 9, 10, 11, 25]))) for i in range(12)] + [(None, line(12)), (50, None), (51, "..."), (3, line(14)), (4, line(11))]
    docs = []
    for i in range(n):
        parts = [line(r.randint(0, 25))]
        if r.random() < 0.6:
            parts.append(r.choice(items)[1] or "")
        parts.append(line(r.randint(0, 12)))
        docs.append((i, r.choice([" ", ", ", "\n"]).join(parts)))
    return docs + [(100, None), (101, ""), (102, "!!"), (None, items[3][1]), (103, "w " * 5000 + items[5][1])], items


def test_leaks_match_brute_force(spark, tables):
    docs, items = make_texts(1)
    d = tables(docs, items)
    got = sorted((r[0] is None, r[0], *r[1:]) for r in op2_decontamination(spark, d).collect())
    want = sorted((i is None, i, *brute_leaks(t, items)) for i, t in docs)
    assert got == want


def test_leaks_past_the_broadcast_limit(spark, tables, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    docs, items = make_texts(2, 20)
    got = {r[0]: tuple(r[1:]) for r in op2_decontamination(spark, tables(docs, items)).collect()}
    assert got == {i: brute_leaks(t, items) for i, t in docs}


def test_many_runs_of_one_long_item(spark):
    """Every tenth word differs: thousands of runs on one diagonal, and an item that repeats itself."""
    item = " ".join(f"w{i}" for i in range(20_000))
    doc = " ".join("x" if i % 12 == 0 else f"w{i}" for i in range(20_000))
    docs = spark.createDataFrame([(1, doc), (2, "a b " * 3000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, "a b " * 30)], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.find_leaks(docs, items).collect()}
    assert len(got[1]["spans"]) == sum(len(range(s, min(s + 12, 20_000))) - 1 >= 10 for s in range(0, 20_000, 12))
    assert brute_leaks("a b " * 300, [(2, "a b " * 30)])[1] == 600 and got[2]["spans"][0]["start"] == 0


def test_leaks_of_empty_tables_and_repeats(spark, tables):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_leaks(docs, none).count() == 2
    assert decontamination.find_leaks(docs.limit(0), none).count() == 0
    items = spark.createDataFrame([(7, "c")], "item_id long, text string")
    clean = decontamination.keep_clean(docs, items)
    assert [tuple(r) for r in clean.collect()] == [(1, "a b"), (1, "a b")]


def brute_quality(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    win = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = Counter(win)
    rep = {p for i, g in enumerate(win) if c[g] > 1 for p in range(i, i + 3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep)


def test_quality_metrics_match_brute_force(spark, tables):
    r = random.Random(3)
    docs = [(i, "".join(r.choice(["the", "a", "é", "𝒳x", " ", " ", "\n", "\t", "#", "|", "\x0b"]) for _ in range(r.randint(0, 120)))) for i in range(80)]
    docs += [(200, None), (201, ""), (202, "of the and " * 60), (None, "x"), (203, "x\n\nx\n x\n")]
    got = {r[0]: r for r in op7_quality_rules(spark, tables(docs)).collect()}
    for i, t in docs:
        n, chars, sym, dup, rep = brute_quality(t)
        assert tuple(got[i][1:6]) == (n, chars, sym, dup, rep), (i, t)
        assert got[i]["base_failed"] == (n < 50 or 100 * rep > 50 * n)
        assert not (got[i]["base_failed"] and got[i]["kept"])


def test_rules_compile_to_one_projection(spark):
    docs = spark.createDataFrame([(1, "the of " * 40)], "doc_id long, text string")
    plan = quality_rules.judge_quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert quality_rules.judge_quality(docs, [("n_words", ">", 80)]).first()["passes"] is False
    assert quality_rules.judge_quality(docs, [("n_words", ">", 79)]).first()["passes"] is True


def test_shards_are_even_and_places_gapless(spark, tables):
    r = random.Random(4)
    docs = [(i, "é" * r.randint(0, 400)) for i in range(3000)] + [(None, None), (None, "q"), (5, "same"), (5, "same")]
    d = tables(docs)
    rows = op6_sharding(spark, d).collect()
    assert len(rows) == len(docs)
    by = {}
    for x in rows:
        by.setdefault(x["shard"], []).append(x)
    assert set(by) == set(range(24))
    sizes = [sum(x["size"] for x in v) for v in by.values()]
    assert max(sizes) - min(sizes) < 0.02 * sum(sizes) / 24
    assert all(sorted(x["slot"] for x in v) == list(range(len(v))) for v in by.values())
    text = {(i, (zlib.crc32(t.encode()) if t is not None else None)): t for i, t in docs}
    assert all(x["size"] == len((text[x["doc_id"], x["text_crc32"]] or "").encode()) + 8 for x in rows)


def test_rows_that_repeat_spread_over_shards(spark):
    docs = spark.range(10_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 20).otherwise(F.col("id")).alias("doc_id"), F.lit("x" * 100).alias("text"))
    rows = sharding.assign_shards(docs.repartition(3), 24).collect()
    load, places = Counter(), {}
    for r in rows:
        load[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["position"])
    assert len(rows) == 10_000 and len(load) == 24 and max(load.values()) - min(load.values()) <= 0.02 * sum(load.values()) / 24
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_map_versions_are_edits(spark, tmp_path):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.expr("repeat('x', cast(id % 97 as int))").alias("text"))
    records = sharding.with_slot(docs, 256)
    weights = sharding.slot_weights(records, 256)
    m = sharding.SlotMap(spark, str(tmp_path / "map"), 256)
    m.create(4)
    m.rebalance(weights, 4)
    m.grow(weights, 4)
    assert m.versions() == [0, 1, 2]
    a, b = ({r["vslot"]: r["shard"] for r in m.read(v).collect()} for v in (1, 2))
    assert len(a) == len(b) == 256
    assert sum(b[s] == a[s] for s in a) > len(a) / 2
    load = Counter()
    for r in weights.collect():
        load[b[r["vslot"]]] += r["bytes"]
    assert set(load) == set(range(5)) and max(load.values()) - min(load.values()) < 0.05 * sum(load.values()) / 5
    assert sharding.assign_shards(docs.limit(0), 3).count() == 0


def test_packing_against_a_recount(spark, tmp_path):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.expr("repeat('x', cast(id * id % 211 as int))").alias("text"))
    weights = sharding.slot_weights(sharding.with_slot(docs, 64), 64)
    m = sharding.SlotMap(spark, str(tmp_path / "map"), 64)
    m.create(5)
    m.rebalance(weights, 5)
    size, shard = {r["vslot"]: r["bytes"] for r in weights.collect()}, {s: s % 5 for s in range(64)}
    share, load, moved = sum(size.values()) / 5, [0] * 5, []
    for k in range(5):
        upto = 0
        for s in sorted((s for s in shard if shard[s] == k), key=lambda s: (-size[s], s)):
            upto += size[s]
            if upto <= share:
                load[k] += size[s]
            else:
                moved.append(s)
    for s in sorted(moved, key=lambda s: (size[s], s), reverse=True):
        shard[s] = load.index(min(load))
        load[shard[s]] += size[s]
    assert {r["vslot"]: r["shard"] for r in m.read().collect()} == shard
