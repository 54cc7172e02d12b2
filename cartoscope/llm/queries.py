"""The ten operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, decontam, katz, langid, lines, mixing, quality, sharding, simhash, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.fit_profiles(langid.learnable(docs))
    found = langid.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", langid.held_out(F.col("doc_id"), 4).alias("held_out"), "lang_pred", "score")


def op2_proportional_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.mixed(docs, keep_text=False).select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "sampled")


def op3_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), torn=True)


def op5_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.segments(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op6_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_table(docs)


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op9_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_held_out(table(spark, sf_dir, "documents"))


def op10_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    held = langid.held_out(F.col("doc_id"), 4).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence")


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_profiles,
        op2_proportional_mixing,
        op3_simhash_golay,
        op4_template_decontamination,
        op5_chat_round_trip,
        op6_risk_controlled_rules,
        op7_histogram_shards,
        op8_line_runs,
        op9_katz_scores,
        op10_toxic_neighbours,
    )
}
