"""Pairs of vectors and of blocks: the same as by brute force, and made without a join that grows with the square of a bucket or group."""

import numpy as np

from kalendria.operators import catalogue, dedup, knn


def vector_rows(n=300):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(n, 16))
    m[n // 2 :] = m[: n - n // 2] + 0.2 * rng.normal(size=(n - n // 2, 16))
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(n), m, strict=True)]
    return rows, [(1000, None), (1001, [0.0] * 16), (1002, rows[0][1]), (1003, rows[0][1]), rows[0]]


def test_hashed_pairs_are_compared_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK", 64)
    monkeypatch.setattr(knn, "HELD", 4096)
    rows, odd = vector_rows()
    df = spark.createDataFrame(rows + odd, "event_id long, vec array<float>")
    vec = {i: np.float32(v).astype(float) for i, v in rows + odd if v and any(v)}
    cos = {(a, b): c for a in vec for b in vec if a < b and (c := vec[a] @ vec[b] / np.linalg.norm(vec[a]) / np.linalg.norm(vec[b])) >= 0.6}
    every = {(r["a"], r["b"]): r["cosine"] for r in knn.close_pairs(df, 0.6).collect()}
    assert set(every) == set(cos) and all(abs(every[p] - cos[p]) < 1e-9 for p in cos)
    found = knn.lsh_pairs(df, 0.6)
    got = [(r["a"], r["b"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) <= set(cos) and len(got) >= 0.9 * len(cos)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_recall_asks_one_pass_for_both_counts(spark, tmp_path):
    rows, odd = vector_rows()
    spark.createDataFrame(rows + odd[:4], "vec_id long, embedding array<float>").selectExpr("*", "0 AS label").write.parquet(f"{tmp_path}/embeddings.parquet")
    recall = catalogue.queries()["lsh_recall"](spark, str(tmp_path))
    assert "Join" not in recall._jdf.queryExecution().optimizedPlan().toString()
    got = recall.first()
    assert (got["exact"], got["enough"]) == (knn.close_pairs(catalogue.vecs(spark, str(tmp_path)), catalogue.GREY).count(), True)


def test_swept_blocks_in_pieces_are_the_same_as_pairs_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dedup, "PIECE", 3)
    rng = np.random.default_rng(5)
    events = [(i, f"{'AB'[i % 2]}C 2025", 7 if i % 5 else None) for i in range(40)] + [(50, None, 7), (51, "ZZ", 7)]
    df = spark.createDataFrame(events, "event_id long, acronym string, edition_year int")
    pairs = {(int(a), int(b)): float(c) for a, b, c in zip(rng.integers(0, 52, 90), rng.integers(0, 52, 90), rng.choice([0.3, 0.42, 0.5, 0.6], 90), strict=True) if a != b}
    near = spark.createDataFrame([(a, b, c) for (a, b), c in pairs.items()], "a long, b long, cosine double")
    block = {i: (a[:2], y) for i, a, y in events if a and y}
    acronym = {(a, b) for a in block for b in block if a < b and block[a] == block[b]}
    assert sorted(map(tuple, dedup.acronym_pairs(df).collect())) == sorted(acronym)
    cosine = {}
    for (a, b), c in pairs.items():
        k = (min(a, b), max(a, b))
        cosine[k] = max(c, cosine.get(k, -1.0))
    every = sorted(acronym | set(cosine))
    got = {(r["a"], r["b"]): (r["is_ann"], r["is_acronym"], r["cosine"]) for r in dedup.united(near, df).collect()}
    assert got == {p: (p in cosine, p in acronym, cosine.get(p)) for p in every}
    standing = spark.range(52).selectExpr("id AS event_id", "0.5D AS confidence", "timestamp_seconds(id % 17) AS scraped_at")
    lost, want = set(), {}
    for a, b in every:
        winner, loser = (a, b) if (a % 17, -a) > (b % 17, -b) else (b, a)
        c = cosine.get((a, b))
        verdict = "skip" if a in lost or b in lost else "merge" if c and c >= 0.45 else "pending" if (c and c >= 0.4) or (a, b) in acronym else "none"
        if verdict == "merge":
            lost.add(loser)
        want[a, b] = (verdict, winner, loser, c or 0.0)
    swept = dedup.swept(near, df, standing, 0.45, 0.4)
    rows = swept.collect()
    assert len(rows) == len(want) and {(r["a"], r["b"]): (r["verdict"], r["winner"], r["loser"], r["cosine"]) for r in rows} == want
    assert {v[0] for v in want.values()} == {"skip", "merge", "pending", "none"}
    assert all((r["seq"] is not None) == (r["verdict"] == "merge") for r in rows)
