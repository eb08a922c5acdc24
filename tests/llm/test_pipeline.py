"""The pipeline on a small corpus with planted cases, stage by stage."""

import random

import corpus_pipeline
from kalendria.llm.sentencepiece_codec import DEFAULT_MODEL, PieceCodec

WORDS = {
    "en": "the weather of this town and that which was there with other people from here again today".split(),
    "de": "das wetter in dieser stadt und der mann ist nicht mit den anderen leuten gegangen heute".split(),
    "fr": "le temps dans cette ville et les autres hommes ne sont pas avec nous pour la fête".split(),
    "es": "el tiempo en esta ciudad y los otros hombres no están con nosotros para la fiesta".split(),
}


def corpus():
    r = random.Random(4)
    line = lambda lang, n: " ".join(r.choice(WORDS[lang]) + (str(r.randint(0, 99)) if r.random() < 0.4 else "") for _ in range(n))
    docs = [(i, line(lang := r.choice(sorted(WORDS)), 80), lang, f"s{i % 3}", 0) for i in range(200)]
    item = line("en", 30)
    docs += [(300, docs[7][1], "en", "s", 0), (301, docs[7][1].replace("\n", " "), None, "s", 0)]
    docs += [(302, f"{line('en', 60)} {item} {line('en', 20)}", "en", "s", 0)]
    docs += [(303, f"{line('en', 60)} password = hunter2hunter2 {line('en', 20)}", "en", "s", 0)]
    docs += [(304, "12345 !!! ???", "en", "s", 0), (305, None, "en", "s", 0), (306, "", None, None, None)]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s, _ in docs], [(1, item), (2, "unseen words only here for nothing at all in any text of this corpus")]


def test_stages_and_run(spark, tmp_path):
    docs, items = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != "sentencepiece":
            assert out.columns == now.columns and [t for _, t in out.dtypes] == [t for _, t in now.dtypes]
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r["doc_id"] for r in now.collect()}
    clean = set(range(200)) | {300, 301, 302, 303}
    assert kept["language_id"] == clean
    assert kept["near_dedup"] == clean - {300, 301}
    assert kept["decontamination"] == kept["near_dedup"] - {302} == kept["secret_scans"] == kept["sentencepiece"]
    redacted = spark.read.parquet(f"{tmp_path}/secret_scans").filter("doc_id = 303").first()
    assert "hunter2" not in redacted["text"] and "[secret]" in redacted["text"] and redacted["n_chars"] == len(redacted["text"])
    codec = PieceCodec.load(DEFAULT_MODEL)
    coded = {r["doc_id"]: r["pieces"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(coded) == kept["sentencepiece"] and codec.decode(coded[303]) == redacted["text"]


def test_stages_take_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_against_brute_force(spark, tmp_path):
    """Every stage recomputed without its operator's search: pairs of shingle sets, windows one by one, spans and ids text by text."""
    from test_native import brute_leaks
    from test_near_copies import brute, edited

    from kalendria.llm import secrets

    docs, items = corpus()
    r = random.Random(12)
    docs += [(1000 + i, edited(r, docs[i][1].split(), i % 25), "en", "s", 1) for i in range(60)]
    docs += [(2000 + i, f"{docs[100 + i][1]} the bearer Zk3vQ9xW2mT7pL5rB8nY4cD{i}6", "en", "s", 1) for i in range(20)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = sorted((d[0], d[1]) for d in docs if d[1] and any(c.isalpha() for c in d[1]))
    roots = brute([t for _, t in left])
    left = [x for i, x in enumerate(left) if roots[i] == i]
    left = [(i, t) for i, t in left if not brute_leaks(t, items)[4]]
    meter, codec = secrets.Novelty(), PieceCodec.load(DEFAULT_MODEL)
    want = {i: codec.encode(secrets.redacted(t, secrets.spans_of(t, meter))) for i, t in left}
    assert {x["doc_id"]: x["pieces"] for x in corpus_pipeline.run(spark, str(tmp_path)).collect()} == want


def test_stages_pass_clashing_columns_on(spark, tmp_path):
    names = ["_id", "_tkey", "tkey", "who", "node", "spans", "pieces", "component_id", "_n", "_row", "_stays", "cand", "p"]
    rows = [(i % 9 if i % 5 else None, f"words of one text {i % 7} and some others", "en", "s", 1, *[i] * len(names)) for i in range(40)]
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} long" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == now.columns, name
        now = spark.createDataFrame(out.collect(), out.schema)
    assert 0 < now.count() < 40
