"""The pipeline's near-copy stage on edited copies, against brute force over exact sets."""

import random

import corpus_pipeline
import numpy as np
from kalendria.llm import near_copies, simhash


def brute(texts):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))]


def edited(r, words, n):
    out = list(words)
    for i in r.sample(range(len(out)), n):
        out[i] = f"edit{r.randint(0, 10**9)}"
    return " ".join(out)


def test_edited_copies_against_brute_force(spark):
    r = random.Random(8)
    texts = [None, "", " \n", "a b c", "A b  c", "one two three four five"]
    for k in range(60):
        words = [f"w{r.randint(0, 5000)}" for _ in range(r.choice((40, 100, 300)))]
        texts += [" ".join(words)] + [edited(r, words, e) for e in (1, 2, 3, len(words) // 25, len(words) // 10)]
    hub = [f"h{i}" for i in range(200)]
    texts += [edited(r, hub, 3) for _ in range(60)]  # two of them may be less alike than each is to a third
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = brute(texts)
    assert {x["doc_id"]: x["component_id"] for x in near_copies.near_copies(docs).collect()} == dict(enumerate(want))
    kept = {x["doc_id"] for x in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == set(want)
    assert len(kept) < simhash.keep_one(docs).count()  # what four bits of 64 leave


def test_texts_alike_below_the_bound_are_not_all_paired(spark):
    """A group whose members share 70 % of their shingles: prefixes leave hardly a pair to compare."""
    r = random.Random(9)
    base = " ".join(f"b{i}" for i in range(140))
    texts = [f"{base} " + " ".join(f"x{k}_{i}" for i in range(60)) for k in range(300)]
    texts += [edited(r, base.split(), 1) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = near_copies.prints(docs, "text", "doc_id")
    nodes = rows.selectExpr("node", "n", "node as root")
    sets = near_copies._sets(docs, rows.selectExpr("doc_id as _id", "tkey as _tkey"), "text", "doc_id")
    assert near_copies._prefixed(nodes, sets).count() < 3000
    assert {x["doc_id"]: x["component_id"] for x in near_copies.near_copies(docs).collect()} == dict(enumerate(brute(texts)))


def test_one_row_of_each_group_stays(spark):
    a, b = (" ".join(f"{p}{i}" for i in range(200)) for p in "ab")
    rows = [(1, a, "y"), (1, a, "x"), (1, f"{a} more", "z"), (None, b, "p"), (None, f"{b} more", "q"), (2, None, "n"), (3, "", "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tkey string")
    for _ in range(2):
        kept = sorted(((x["doc_id"] or 0, x["tkey"]) for x in near_copies.keep_one(docs.repartition(5)).collect()))
        assert len(kept) == 3 and kept[0][0] == 0 and kept[1][0] == 1 and kept[2] == (2, "n")
        assert kept[1][1] in ("x", "z")  # of equal (id, text) the first as JSON


def test_links_come_from_the_trees(spark, monkeypatch):
    """Copies with few edits are linked through fingerprints and trees: bands have nothing left to join, and no pair below the bound passes."""
    r = random.Random(21)
    texts = []
    for _ in range(25):
        words = [f"w{r.randint(0, 5000)}" for _ in range(400)]
        texts += [" ".join(words)] + [edited(r, words, 1) for _ in range(3)]
    short = [f"s{i}" for i in range(9)]  # fingerprints of few shingles can agree where the sets do not
    texts += [" ".join(short), " ".join([*short, "more"]), " ".join([*short[1:], "other"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = []
    found = simhash.link_edges
    monkeypatch.setattr(simhash, "link_edges", lambda *a, **k: asked.append(a[2]) or found(*a, **k))
    rows = near_copies.prints(docs, "text", "doc_id").cache()
    pairs = near_copies._tree_pairs(rows.select("node", "n", "fp", "bands"), len(texts)).collect()
    assert asked == [near_copies.RADIUS]
    node, fp = ({x["doc_id"]: x[c] for x in rows.collect()} for c in ("node", "fp"))
    of = {v: k for k, v in node.items()}
    assert all(((fp[of[a]] ^ fp[of[b]]) % (1 << 64)).bit_count() <= near_copies.RADIUS for a, b in pairs)
    sets = near_copies._sets(docs, rows.selectExpr("doc_id as _id", "tkey as _tkey"), "text", "doc_id")
    linked = {(of[x["a"]], of[x["b"]]) for x in near_copies._links(spark.createDataFrame(pairs), sets).collect()}
    up = list(range(len(texts)))
    for _ in texts:
        for a, b in linked:
            up[a] = up[b] = min(up[a], up[b])
    want = brute(texts)
    assert sum(a == b for a, b in zip(up, want, strict=True)) >= 0.9 * len(texts) and all(want[a] == want[b] for a, b in linked)
    asked.clear()
    assert {x["doc_id"]: x["component_id"] for x in near_copies.near_copies(docs).collect()} == dict(enumerate(want))
    assert asked == [near_copies.RADIUS]


def test_pairs_of_the_trees_are_links_and_span(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 32)
    monkeypatch.setattr(simhash, "OUTRIGHT", 256)
    r = random.Random(5)
    fps = [r.getrandbits(64) for _ in range(100)]
    for _ in range(300):
        x = r.choice(fps)
        fps.append(x ^ sum(1 << b for b in r.sample(range(64), r.choice([1, 3, 4, 5]))))
    signed = sorted({x - (x >> 63 << 64) for x in fps})
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    for block in (1 << 20, 64):
        monkeypatch.setattr(simhash, "BLOCK", block)
        pairs = [tuple(x) for x in simhash.link_edges(nodes, len(signed), 4, direct=True).collect()]
        assert all(a < b and ((a ^ b) % (1 << 64)).bit_count() <= 4 for a, b in pairs)
        all_ = np.array([(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) % (1 << 64)).bit_count() <= 4])
        want, got = (dict(zip(*(x.tolist() for x in near_copies._least(*np.array(p).T)), strict=True)) for p in (all_, pairs))
        assert got == want


def test_components_in_one_task_or_in_rounds(spark, monkeypatch):
    r = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(r.randint(100, 400), r.randint(100, 400)) for _ in range(200)] + [(-5, 9), (7, 7)]
    table = spark.createDataFrame(edges, "a long, b long").repartition(3)
    one = sorted(map(tuple, near_copies._labels(table).collect()))
    monkeypatch.setattr(near_copies, "ONE_TASK", 0)
    assert one == sorted(map(tuple, near_copies._labels(table).collect())) and dict(one)[40] == -5
    assert near_copies._labels(table.limit(0)).count() == 0
