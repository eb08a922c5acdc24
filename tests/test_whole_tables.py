"""Queries that must read whole tables, on small fixtures and by brute force."""

import hashlib
import re

from kalendria.operators import catalogue

ACRONYM = re.compile(r"\b([A-Z][A-Z0-9]{1,11}(?:[ -]?20[0-9]{2})?)\b")


def test_document_hints_keep_every_row(spark, tmp_path):
    texts = ["see ICML 2024 here", "Université de ÉTAPS, voir ICDT 2023", "naïve ABCé XYZ", None, "", "短い文 KDD 2022 です"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in catalogue.queries()["document_hints"](spark, str(tmp_path)).collect()}
    assert set(got) == set(range(len(texts)))
    for i, t in enumerate(texts):
        found = ACRONYM.search(t or "")
        assert got[i]["acronym"] == (found[1] if found else ""), t
        assert t is None or (got[i]["text_hash"] == hashlib.sha1(t.encode()).hexdigest() and got[i]["tokens"] == max(1, len(t) // 4))


def test_sweep_reads_ids_beyond_any_bound(spark, tmp_path):
    parts = [(i, f"Brand#{i % 2}", 7) for i in (4, 8, 496, 500, 2000, 2004, 90000)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    vecs = [(i, [1.0 if j == i % 64 else 0.0 for j in range(64)], 0) for i in (1, 5001, 65, 70000)]
    vecs.append((5065, vecs[0][1], 0))
    spark.createDataFrame(vecs, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    want = {(a, b) for a, *_ in parts for b, *_ in parts if a < b} | {(1, 65), (1, 5065), (65, 5065)}
    pairs = catalogue.queries()["pair_union_flags"](spark, str(tmp_path)).collect()
    assert {(r["a"], r["b"]) for r in pairs} == want
    swept = catalogue.queries()["sweep_verdicts"](spark, str(tmp_path)).collect()
    assert {(r["a"], r["b"]) for r in swept} == want
