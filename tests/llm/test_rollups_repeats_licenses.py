"""Token rollups, repeated passages and license scans against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kalendria.llm import license_scans, repeats, token_rollups
from kalendria.llm.queries import op4_token_rollups


def brute_repeats(docs, window):
    w = [(t or "").encode().split() for t in docs]
    c = Counter(tuple(x[i : i + window]) for x in w for i in range(len(x) - window + 1))
    out = []
    for x in w:
        on = {p for i in range(len(x) - window + 1) if c[tuple(x[i : i + window])] > 1 for p in range(i, i + window)}
        spans, at = [], None
        for p in range(len(x) + 1):
            if p in on and at is None:
                at = p
            if p not in on and at is not None:
                spans.append((at, p))
                at = None
        out.append((len(x), spans))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_match_brute_force(spark, seed):
    r = random.Random(seed)
    vocab = ["a", "b", "É", "é", "A"] if seed < 3 else [f"w{i}" for i in range(50)]
    passages = [[r.choice(vocab) for _ in range(r.randint(5, 15))] for _ in range(4)]
    texts = []
    for _ in range(70):
        w = [r.choice(vocab) for _ in range(r.randint(0, 12))]
        for _ in range(r.randint(0, 2)):
            w += r.choice(passages) + [r.choice(vocab) for _ in range(r.randint(0, 6))]
        texts.append(r.choice([" ", "\n", " \t"]).join(w))
    texts += texts[:3] + [None, "", "  "] + ["x y z"] * 30
    docs = spark.createDataFrame([(i if i % 9 else None, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ext string")
    got = repeats.find_repeats(docs, window=7, k=3).collect()
    want = brute_repeats(texts, 7)
    order = lambda rows: sorted(rows, key=repr)
    assert order((g["doc_id"], g["n_words"], [(s["start"], s["end"]) for s in g["spans"]]) for g in got) == order((i if i % 9 else None, n, s) for i, (n, s) in enumerate(want))


def test_repeats_in_one_place_of_many(spark):
    """A passage in a third of all documents, between words of their own; and copies of a very long text."""
    r = random.Random(4)
    passage = [f"p{i}" for i in range(90)]
    texts = []
    for i in range(90):
        own = [f"o{i}_{j}" for j in range(r.randint(30, 90))]
        cut = passage[r.randint(0, 30) : r.randint(60, 90)] if i % 3 == 0 else []
        texts.append(" ".join(own[:20] + cut + own[20:]))
    long = " ".join(str(r.randint(0, 10**9)) for _ in range(60_000))
    texts += [long, long + " tail"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {g["doc_id"]: (g["n_words"], [(s["start"], s["end"]) for s in g["spans"]]) for g in repeats.find_repeats(docs).collect()}
    assert got == dict(enumerate(brute_repeats(texts, 50)))


def test_windows_that_agree_with_different_neighbours():
    """One side with one neighbour, one with the other: only a look at the single window tells."""
    rows = [{"g": 1, "ext": e, "least": 0, "most": 4, "follows": f, "precedes": p} for e, f, p in ((1, b"a\tb\tc\t", b"x\ty\t"), (2, b"a\tb\td\t", b"x\tz\t"))]
    assert repeats.shared(b"a\tb\tc\t", b"a\tb\tcc\t") == 2 and repeats.shared(b"", b"x\t") == 0 and repeats.shared(b"a\t", b"a\tb\t") == 1
    found = repeats.compared(*rows, 3)
    assert found == [(1, 1, 0b10, 2, 1), (1, 2, 0b10, 2, 1)]
    assert repeats.compared(rows[0], rows[1] | {"g": 2}, 3) == []


def test_repeats_of_nothing(spark):
    assert repeats.find_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_retained_positions_do_not_depend_on_pieces(monkeypatch):
    text = " ".join(str(random.Random(3).random()) for _ in range(3)) + " " + " ".join(str(i * 7919 % 613) for i in range(900))
    whole = repeats.anchors(repeats.Rolling(text), 50, 16)
    monkeypatch.setattr(repeats, "PIECE", 64)
    assert all((a == b).all() for a, b in zip(whole, repeats.anchors(repeats.Rolling(text), 50, 16), strict=True))


def brute_licenses(text, threshold):
    """Every passage that begins and ends with a bigram of the template and is not too long."""
    import re

    norm = lambda t: re.findall("[a-z0-9]+", t.translate(license_scans.FOLD))
    pairs = lambda w: list(zip(w, w[1:], strict=False))
    g, out = pairs(norm(text or "")), {}
    for name, ts in license_scans.TEMPLATES.items():
        for t in ts:
            b = set(pairs(norm(t)))
            for i in range(len(g)):
                if g[i] in b:
                    for j in range(i, min(len(g), int(i + len(b) * (2 - threshold) / threshold + 1e-9))):
                        if g[j] in b:
                            a = set(g[i : j + 1])
                            d = 2 * len(a & b) / (len(a) + len(b))
                            if d >= threshold:
                                out[name] = max(out.get(name, 0), d)
    return sorted((round(d, 9), n) for n, d in out.items())


def test_licenses_match_brute_force(spark):
    r = random.Random(5)
    every = [t for ts in license_scans.TEMPLATES.values() for t in ts if len(t) < 700]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(r.randint(1, 3)):
            w = r.choice(every).split()
            for _ in range(r.choice([0, 0, 1, 2, 5])):
                w[r.randrange(len(w))] = r.choice(["the", "LICENSE", "é", "x"])
            lines += [" ".join(r.choice(["some", "of", "the", "license"]) for _ in range(r.randint(0, 6))), " ".join(w)]
        texts.append(r.choice(["\n", "\n\n", " ", "\n \t\n"]).join(lines))
    texts += [None, "", "x", "\n\n", "A" * 1000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, score long")
    got = {g["doc_id"]: sorted((round(m["score"], 9), m["license"]) for m in g["matches"]) for g in license_scans.scan_licenses(docs).collect()}
    assert got == {i: brute_licenses(t, license_scans.THRESHOLD) for i, t in enumerate(texts)}
    assert license_scans.scan_licenses(docs.limit(0)).count() == 0


def test_licenses_in_any_dress():
    index = license_scans.LicenseIndex()
    mit = license_scans.TEMPLATES["MIT"][3]
    names = lambda t: [m[0] for m in index.scan(t)]
    assert names(mit.replace(" ", "\t")) == ["MIT"]
    wrapped = "\n".join("# " + " ".join(mit.split()[i : i + 9]) for i in range(0, len(mit.split()), 9))
    assert names(f"#!/bin/sh\n#\n{wrapped}\n#\nimport os\nprint(os.name)\n" + "x = 1\n" * 200) == ["MIT"]
    apache = license_scans.TEMPLATES["Apache-2.0"][1].replace("You may", "\n\n   You may").replace("Unless", "\n\nUnless")
    assert names(f"A tool for people.\n\n{apache}\n\nSee the manual. " + "word " * 300) == ["Apache-2.0"]
    assert names("made for people. Licensed under the Apache License, Version 2.0. See the docs.") == ["Apache-2.0"]
    lgpl = license_scans.TEMPLATES["LGPL-3.0"][0]
    assert max(index.scan(f"x y {lgpl} z"), key=lambda m: m[1])[:2] == ("LGPL-3.0", 1.0)
    assert names("of the license and of the software " * 5000) == []


def test_rollups_equal_a_recount(spark, tmp_path):
    rows = [(i, f"some text no {i} " * (i % 7), f"s{i % 3}" if i % 5 else None, "en" if i % 2 else None, 1) for i in range(60)] + [(90, None, "s1", "en", 1), (91, "", "only", "en", 1), (5, "again", "s2", "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_tokens long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 60, 2)] + [(91, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {tuple(r) for r in op4_token_rollups(spark, str(tmp_path)).collect()}
    enc, want = token_rollups.encoding(token_rollups.DEFAULT_RANKS), {}
    gone = {i for i in range(0, 60, 2) if i % 4 == 0} | {91}
    for i, t, s, lang, _ in rows:
        if i not in gone:
            a = want.setdefault((s, lang), [0, 0, 0])
            a[0] += 1
            a[1] += len(enc.encode_ordinary(t or ""))
            a[2] += len(t or "")
    assert got == {(s, lang, "byte_bpe_50k/1", *a) for (s, lang), a in want.items()}


def test_batches_in_any_order_and_crashes(spark, tmp_path):
    counts = spark.createDataFrame([("a", "en", 10, 40)], "source string, lang string, n_tokens long, n_chars long")
    roll = token_rollups.Rollup(spark, str(tmp_path / "r"))
    roll.commit("revision", token_rollups.revised(counts.withColumn("new", F.lit(25)), "v1", "n_tokens", "new"))
    roll.commit("other", token_rollups.inserted(counts.withColumn("source", F.lit("b")), "v1"))
    roll.compact()
    roll.commit("arrival", token_rollups.inserted(counts, "v1"))
    assert sorted(map(tuple, roll.totals().collect())) == [("a", "en", "v1", 1, 25, 40), ("b", "en", "v1", 1, 10, 40)]
    # a crash before the renaming leaves a folder that nothing counts, and the retry goes through
    _ = token_rollups._summed(token_rollups.inserted(counts, "v1")).write.parquet(str(tmp_path / "r/_half"))
    # a crash after a base was made leaves deltas that it names already
    fs, kept = token_rollups.hadoop_path(spark, str(tmp_path / "r/deltas"))
    name = token_rollups._hash("late")
    roll.commit("late", token_rollups.inserted(counts, "v1"))
    copy = tmp_path / "copy"
    import shutil

    shutil.copytree(tmp_path / "r/deltas" / name, copy)
    before = sorted(map(tuple, roll.totals().collect()))
    roll.compact()
    shutil.copytree(copy, tmp_path / "r/deltas" / name)
    assert sorted(map(tuple, roll.totals().collect())) == before
    assert not any(roll.commit(b, token_rollups.inserted(counts, "v1")) for b in ("revision", "other", "arrival", "late"))
    assert sorted(map(tuple, roll.totals().collect())) == before


def test_batches_commit_once(spark, tmp_path):
    counts = spark.createDataFrame([("a", "en", 10, 40), ("a", "en", 5, 20)], "source string, lang string, n_tokens long, n_chars long")
    roll = token_rollups.Rollup(spark, str(tmp_path / "r"))
    assert roll.totals().count() == 0
    assert roll.commit("one", token_rollups.inserted(counts, "v1")) and not roll.commit("one", token_rollups.inserted(counts, "v1"))
    spark.range(1).write.parquet(str(tmp_path / "r/deltas/orphan"))  # what a crash before its commit leaves
    assert [tuple(r) for r in roll.totals().collect()] == [("a", "en", "v1", 2, 15, 60)]
    roll.commit("two", token_rollups.deleted(counts.limit(0), "v1"))
    roll.commit("three", token_rollups.revised(counts.withColumn("new", F.col("n_tokens") * 2), "v1", "n_tokens", "new"))
    roll.compact()
    assert not roll.commit("three", token_rollups.inserted(counts, "v1"))
    assert [tuple(r) for r in roll.totals().collect()] == [("a", "en", "v1", 2, 30, 60)]
    roll.commit("four", token_rollups.deleted(counts.withColumn("t", F.col("n_tokens") * 2), "v1", "t"))
    assert roll.totals().count() == 0
