"""Secret scans, SimHash, language identification and the piece codec against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kalendria.llm import language_id, secrets, simhash
from kalendria.llm.queries import op1_secret_scans, op3_simhash, op9_language_id, op10_sentencepiece
from kalendria.llm.sentencepiece_codec import DEFAULT_MODEL, PieceCodec, decode_pieces, encode_pieces


def table(spark, path, rows):
    spark.createDataFrame([(*r, 3, "s") for r in rows], "doc_id long, text string, lang string, spans long, source string").write.parquet(f"{path}/documents.parquet")
    return str(path)


def brute_base(t):
    t, out = t or "", []
    pat = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for k, (kind, p, ok) in enumerate([("assign", pat, lambda m: len(m.group(2)) >= 8), ("access", "AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16), ("hex", "[0-9a-f]+", lambda m: len(m.group()) >= 32)]):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(p, t) if ok(m)]
    return [x[2] for x in sorted(out)]


def test_secrets_match_brute_force(spark, tmp_path):
    r = random.Random(5)
    bits = ["password", "PassWd", "toKen", "toKKen", "api_key", "APIKEY", " = ", ":", '"', "'", "=", "abcdefgh12", "short", "AKIA", "IOSFODNN7EXAMPLE", "AKIA1", "deadbeef" * 5, "f" * 31, " ", "é", "𝒳", "\n"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 40))), "en") for i in range(300)] + [(900, None, None), (901, "", None), (None, "token = abcdefgh", None)]
    got = {r["doc_id"]: r for r in op1_secret_scans(spark, table(spark, tmp_path, rows)).collect()}
    for i, t, _ in rows:
        want = brute_base(t)
        g = got[i]
        assert (g["n_assign"], g["n_access"], g["n_hex"]) == tuple(sum(x.startswith(k) for x in want) for k in ("assign", "access", "hex")), t
        assert g["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [x for x in g["spans"].split(",") if x and not x.startswith("novel")] == want
        starts = [int(x.split(":")[1]) for x in g["spans"].split(",") if x]
        assert starts == sorted(starts)


def test_novelty_tells_keys_from_identifiers(spark):
    meter = secrets.Novelty()
    key = "the bearer credential is Zk3vQ9xW2mT7pL5rB8nY4cD6 here"
    assert [s[2] for s in secrets.spans_of(key, meter)] == ["novel"]
    assert secrets.spans_of("use credential get_client_secret_config_value1 here", meter) == []
    assert secrets.spans_of("nothing near Zk3vQ9xW2mT7pL5rB8nY4cD6", meter) == []
    repeated = "Zk3vQ9xW2mT7pL5rB8nY4cD6 seen before, bearer Zk3vQ9xW2mT7pL5rB8nY4cD6"
    assert secrets.spans_of(repeated, meter) == []


def test_redaction_keeps_rows_and_columns(spark):
    rows = [(1, "a token = 0123456789abcdef b", 7), (2, None, 8), (3, "clean", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans long")
    got = {r["doc_id"]: r for r in secrets.redact_secrets(docs).collect()}
    assert got[1]["text"] == "a [secret] b" and got[2]["text"] is None and got[3]["text"] == "clean" and got[1]["spans"] == 7


def brute_fp(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, radius=4):
    up = list(range(len(ids)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                up[root(i)] = root(j)
    low = {}
    for i, x in enumerate(ids):
        low[root(i)] = min(x, low.get(root(i), x))
    return {x: low[root(i)] for i, x in enumerate(ids)}


def test_simhash_matches_brute_force(spark, tmp_path):
    r = random.Random(6)
    vocab = [f"w{i}" for i in range(300)] + ["É", "A", "a"]
    base = [[r.choice(vocab) for _ in range(r.choice([3, 40, 400]))] for _ in range(25)]
    rows = []
    for i in range(220):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2])):
            w[r.randrange(len(w))] = r.choice(vocab)
        rows.append((1000 - i, r.choice([" ", "\n", "\x0b "]).join(w), "en"))
    rows += [(5, None, None), (6, "", None), (7, " \t", None)]
    got = op3_simhash(spark, table(spark, tmp_path, rows)).collect()
    ids, fps = [x[0] for x in rows], [brute_fp(x[1]) for x in rows]
    assert {g["doc_id"]: int(g["fingerprint"], 16) for g in got} == dict(zip(ids, fps, strict=True))
    assert all(len(g["fingerprint"]) == 16 for g in got)
    assert {g["doc_id"]: g["component_id"] for g in got} == brute_components(ids, fps)


@pytest.mark.parametrize("block", [1 << 30, 64])
def test_trees_find_every_link(spark, monkeypatch, block):
    """Chains and balls of fingerprints over many leaves, and shards in salted pieces."""
    monkeypatch.setattr(simhash, "LEAF", 32)
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "OUTRIGHT", 256)
    r = random.Random(7)
    fps = [r.getrandbits(64) for _ in range(300)]
    for _ in range(500):
        x = r.choice(fps)
        for b in r.sample(range(64), r.choice([1, 3, 4, 5, 6])):
            x ^= 1 << b
        fps.append(x)
    fps = sorted(set(fps))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(x, i) for i, x in enumerate(signed)], "fp long, rep long")
    edges = simhash.link_edges(nodes, len(fps), 4)
    roots = {x["fp"]: x["root"] for x in simhash.components(edges).collect()}
    want = brute_components(signed, fps)
    groups, same = {}, {}
    for x in signed:
        groups.setdefault(roots.get(x, x), set()).add(x)
        same.setdefault(want[x], set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, same.values()))


def test_trees_copy_queries_over_boundaries(spark, monkeypatch):
    """Beyond four bits two parts may differ, and shards across a bound are asked as well."""
    monkeypatch.setattr(simhash, "LEAF", 32)
    assert [simhash.reach(r) for r in (3, 4, 5, 6, 10)] == [0, 0, 1, 2, 2]
    r = random.Random(11)
    fps = [r.getrandbits(64) for _ in range(150)]
    fps += [x ^ sum(1 << b for b in r.sample(range(64), r.choice([5, 6, 7]))) for x in fps]
    signed = np.array(sorted(set(fps)), np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(x, i) for i, x in enumerate(signed)], "fp long, rep long")
    roots = {x["fp"]: x["root"] for x in simhash.components(simhash.link_edges(nodes, len(signed), 6)).collect()}
    want, groups, same = brute_components(signed, fps := [x % (1 << 64) for x in signed], 6), {}, {}
    for x in signed:
        groups.setdefault(roots.get(x, x), set()).add(x)
        same.setdefault(want[x], set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, same.values())) and fps


def test_keep_one_of_each_group(spark):
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(3, long), (1, long), (1, long), (2, "another text of five words"), (None, long), (None, "alone here with no id")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["text"] for r in kept.collect()) == sorted([long, "another text of five words", "alone here with no id"])
    assert simhash.near_duplicates(kept.limit(0)).count() == 0


SAMPLES = {
    "en": "the weather of this town and that which was there with the other people from here",
    "de": "das wetter in dieser stadt und der mann ist nicht mit den anderen leuten gegangen",
    "fr": "le temps dans cette ville et les autres hommes ne sont pas avec nous pour la fête",
    "es": "el tiempo en esta ciudad y los otros hombres no están con nosotros para la fiesta",
}


def test_languages_of_held_out_rows(spark, tmp_path):
    r = random.Random(8)
    rows = []
    for i in range(400):
        lang = r.choice(sorted(SAMPLES))
        w = SAMPLES[lang].split()
        rows.append((i, " ".join(r.choice(w) for _ in range(30)), lang if r.random() < 0.9 else None))
    truth = {i: next(k for k in SAMPLES if set(t.split()) <= set(SAMPLES[k].split())) for i, t, _ in rows}
    rows += [(1000, None, "en"), (1001, "", None), (1002, "123 !?", "fr"), (None, "the weather of this town", "en")]
    got = op9_language_id(spark, table(spark, tmp_path, rows)).collect()
    assert len(got) == len(rows)
    for g in got:
        assert 0 <= g["score"] <= 1
        if g["doc_id"] is not None:
            assert g["held_out"] == (zlib.crc32(str(g["doc_id"]).encode()) % 4 == 2)
    pred = {g["doc_id"]: g["lang_pred"] for g in got}
    assert [pred[i] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert sum(pred[i] == lang for i, lang in truth.items()) >= 0.98 * len(truth)
    docs = spark.createDataFrame([(1, "text", None, 1)], "doc_id long, text string, lang string, score long")
    assert language_id.identify(docs, language_id.fit_languages(docs)).first()["lang_pred"] == "und"
    assert language_id.keep_identified(docs, language_id.fit_languages(docs)).count() == 0


def test_accuracy_on_held_out_rows_alone(spark):
    r = random.Random(12)
    rows = [(i, " ".join(r.choice(SAMPLES[lang].split()) for _ in range(20)), lang) for i in range(600) for lang in [r.choice(sorted(SAMPLES))]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, truth = language_id.fit_languages(docs), {i: lang for i, _, lang in rows}
    held = {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    got = {g["doc_id"]: (g["lang_pred"], g["score"]) for g in language_id.identify(docs, model).collect()}
    assert len(held) > 100 and sum(got[i][0] == truth[i] for i in held) >= 0.98 * len(held)
    for i, text, _ in r.sample(rows, 25):  # n-grams one by one, and every duel by itself
        data = (" " + text + " ").encode()
        grams = [(g, data[j : j + g]) for g in (3, 4) for j in range(len(data) - g + 1)]
        at = lambda g, b: ((int.from_bytes(b) * 2654435761 if g == 3 else int.from_bytes(b) * 2246822519 + 97) & 0xFFFFFFFF) >> 18
        margins = {d: sum(float(model.weights[at(*x), k]) for x in grams) / len(grams) + float(model.bias[k]) for k, d in enumerate(model.duels)}
        win = lambda level, names: max(names, key=lambda n: (sum((m >= 0) == (n == d[1]) for d, m in margins.items() if d[0] == level and n in d[1:]), -names.index(n)))
        family = win("family", sorted(model.groups))
        assert got[i][0] == win(family, model.groups[family])


def test_fitting_draws_from_every_language(spark):
    """Thousands of rows without an id, repeated rows, and a language of long texts only."""
    r = random.Random(13)
    text = lambda lang, n=30: " ".join(r.choice(SAMPLES[lang].split()) for _ in range(n))
    rows = [(None, text("en"), "en") for _ in range(1500)] + [(7, SAMPLES["fr"], "fr")] * 1500 + [(i, text("fr"), "fr") for i in range(60)]
    rows += [(i, text("de"), "de") for i in range(100)] + [(i, text("es", 45_000), "es") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_languages(docs)
    assert [model.predict(SAMPLES[lang])[0] for lang in sorted(SAMPLES)] == sorted(SAMPLES)


def test_bucket_pieces_join_up(monkeypatch):
    text = "ab " * 500
    whole = language_id.profile(text)
    monkeypatch.setattr(language_id, "PIECE", 64)
    assert np.array_equal(whole, language_id.profile(text))


def brute_viterbi(codec, pieces, chunk):
    """Greatest sum of scores over all segmentations, characters as bytes at the byte score."""
    best = [0.0] + [-np.inf] * len(chunk)
    for e in range(1, len(chunk) + 1):
        for s in range(e):
            if chunk[s:e] in pieces:
                best[e] = max(best[e], best[s] + pieces[chunk[s:e]][1])
        best[e] = max(best[e], best[e - 1] + codec.byte_score * len(chunk[e - 1].encode()))
    return best[-1]


def test_codec_against_brute_force_and_round_trip(spark):
    r = random.Random(9)
    pieces = {p: (i + 256, -float(r.randint(1, 30))) for i, p in enumerate({"".join(r.choice("abc") for _ in range(r.randint(1, 5))) for _ in range(40)} | {"▁", "▁a", "▁▁", "▁bc"})}
    codec = PieceCodec(pieces, list(range(256)))
    score = {i: s for i, s in pieces.values()}
    for _ in range(400):
        chunk = "▁" * r.randint(0, 3) + "".join(r.choice("abcdé") for _ in range(r.randint(1, 12)))
        ids = codec.viterbi(chunk)
        assert sum(score.get(i, codec.byte_score) for i in ids) == brute_viterbi(codec, pieces, chunk)
    for _ in range(300):
        text = "".join(r.choice("ab é▁ \n\x00𝒳") for _ in range(r.randint(0, 30)))
        assert codec.decode(codec.encode(text)) == text
    with pytest.raises(ValueError):
        PieceCodec({"a▁b": (1, 0.0)}, list(range(256)))


def test_whole_texts_against_brute_force_and_odd_ids(spark):
    """Encoding in words and parts loses nothing against one segmentation of the whole text."""
    r = random.Random(10)
    pieces = {p: (i + 256, -float(r.randint(1, 30))) for i, p in enumerate(sorted({"".join(r.choice("abcd") for _ in range(r.randint(1, 4))) for _ in range(25)} | {"▁", "▁a", "▁b"}))}
    codec = PieceCodec(pieces, list(range(256)))
    score = {i: s for i, s in pieces.values()}
    for _ in range(300):
        text = "".join(r.choice("abcdé ") for _ in range(r.randint(1, 25)))
        assert sum(score.get(i, codec.byte_score) for i in codec.encode(text)) == brute_viterbi(codec, pieces, "▁" + text.replace(" ", "▁"))
    assert codec.decode([0xC3]) == "\ufffd" and codec.decode([10**6, 65]) == "\ufffdA" and codec.decode([None, 65]) == "\ufffdA" and codec.decode([]) == ""


def test_long_texts_without_blanks():
    import time

    codec, r = PieceCodec.load(DEFAULT_MODEL), random.Random(3)
    text = "".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(300_000))
    began = time.process_time()
    assert codec.decode(codec.encode(text)) == text
    assert time.process_time() - began < 20


def test_codec_agrees_with_the_library(spark):
    """The library, told that the same pieces are a unigram model, gives segmentations of the same score."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(open(DEFAULT_MODEL, "rb").read())
    model.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    other = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    mine = PieceCodec.load(DEFAULT_MODEL)
    for text in ["Hello world, this is a test of pieces.", "le naïf été", "x" * 50, "tion of the and "]:
        ids = mine.encode(text)
        assert mine.decode(ids) == text
        value = lambda x: sum(other.get_score(i) for i in x)
        assert abs(value(ids) - value(other.encode(text))) < 1 or value(ids) > value(other.encode(text))


def test_encoded_tables_round_trip(spark, tmp_path):
    rows = [(1, "A  text\n with ▁ and \U0001f600", "en"), (2, None, None), (3, "", None), (None, "x", None), (4, "long " * 20000, None)]
    d = table(spark, tmp_path, rows)
    got = op10_sentencepiece(spark, d).collect()
    assert all(g["round_trip"] for g in got if g["pieces"] is not None) and sum(g["pieces"] is None for g in got) == 1
    docs = spark.read.parquet(f"{d}/documents.parquet")
    back = {r["doc_id"]: r["text"] for r in decode_pieces(encode_pieces(docs)).collect()}
    assert back == {i: t for i, t, _ in rows}
    assert encode_pieces(docs.filter(F.lit(False))).count() == 0
