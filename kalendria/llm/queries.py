"""The driver's queries of this subpackage: thin digests of the operators' outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalendria.llm import decontamination, language_id, license_scans, quality_rules, repeats, secrets, sentencepiece_codec, sharding, simhash, token_rollups
from kalendria.llm.support import documents, staged


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    names = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(names(base), 256).alias("base_sha256"),
        names(F.col("spans")).alias("spans"),
        count("novel").alias("n_novel"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = decontamination.covered_words(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive with an estimate, are counted, and those labelled toxic retired; both first batches come twice."""
    version = "byte_bpe_50k/1"
    counts = staged(token_rollups.count_tokens(documents(spark, sf_dir)).withColumn("estimate", F.ceil(F.col("n_bytes") / 4)))
    toxic = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic = 1").select("doc_id").distinct()
    rollup = token_rollups.Rollup(spark)
    for _ in range(2):
        rollup.commit("arrivals", token_rollups.inserted(counts, version, "estimate"))
        rollup.commit("counted", token_rollups.revised(counts, version, "estimate", "n_tokens"))
    rollup.commit("retired", token_rollups.deleted(counts.join(toxic, "doc_id", "left_semi"), version))
    return rollup.totals()


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scans.scan_licenses(documents(spark, sf_dir))
    best = F.get("matches", F.lit(0))
    return found.select(
        "doc_id",
        best["license"].alias("license"),
        F.round(best["score"], 6).alias("score"),
        F.size("matches").cast("long").alias("n_licenses"),
        F.array_join(F.sort_array(F.transform("matches", lambda m: m["license"])), ",").alias("licenses"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(documents(spark, sf_dir), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("position").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "vslot"
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = quality_rules.judge_quality(documents(spark, sf_dir))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return m.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("passes")).alias("kept"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a passage of 50 words or more found elsewhere too, and where in them it stands."""
    found = repeats.find_repeats(documents(spark, sf_dir)).filter(F.size("spans") > 0)
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"]).cast("long").alias("n_repeat_words"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language_id.identify(docs, language_id.fit_languages(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.encode_pieces(documents(spark, sf_dir))
    return coded.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "round_trip")


def queries() -> dict:
    return {
        "op1_secret_scans": op1_secret_scans,
        "op3_simhash": op3_simhash,
        "op4_token_rollups": op4_token_rollups,
        "op5_license_scans": op5_license_scans,
        "op8_repeats": op8_repeats,
        "op9_language_id": op9_language_id,
        "op10_sentencepiece": op10_sentencepiece,
        "op2_decontamination": op2_decontamination,
        "op6_sharding": op6_sharding,
        "op7_quality_rules": op7_quality_rules,
    }
