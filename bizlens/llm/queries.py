"""The queries of this folder, each over whole tables, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm import bpe, crf, jaccard, langid, manifest, merkle, mix, rules, secret_scan, sql, substrings, suffixes, token_counts, turns
from bizlens.llm.text import WORD

#: Rows kept out of what is learned; false for a null id.
HELD_OUT = "coalesce(pmod(crc32(cast(doc_id as string)), 4) = 2, false)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_likeness(table(spark, sf_dir, "documents"))


def op3_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_strings(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = crf.fit_quality(docs, table(spark, sf_dir, "labels"), ~F.expr(HELD_OUT))
    scored = crf.score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return rules.rule_quality(docs, trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op8_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    return mix.mix_sources(docs, size).select("doc_id", "size", "source_size", "target", "taken")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, parsers = langid.fit_parsers(docs.where(~F.expr(HELD_OUT)), "text", "lang", F.xxhash64("doc_id"))
    found = langid.identify(docs, langs, parsers)
    return found.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "lang_pred", "score")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.expr("crc32(cast(doc_id as string)) % 7 = 0")
    found_chars = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    kinds = ("doc_id", "source", "lang")
    found = manifest.manifest(
        docs, "doc_id", "lang", manifest.leaf(*[F.col(c) for c in kinds], F.col("n_chars"), F.col("text")),
        manifest.leaf(*[F.col(c) for c in kinds], found_chars, F.col("text")))
    proof = F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as the contract damages them, by the remainder of a checksum of ``conv_id:turn``; nulls are one space."""
    def text(column):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), F.pmod(
        F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))), F.lit(20)).alias("way")).where("way != 0")
    changed = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("way") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"),
                       changed.alias("text"), copies.alias("copy")).drop("copy")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    edited, found = turns.repair(damaged(given))
    digests = turns.repaired_sha256(turns.repaired_turns(edited))
    convs = given.select("conv_id", turns.conversation_key(F.col("conv_id")).alias("conv")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return convs.join(found, "conv", "left").join(digests, "conv", "left").select(
        "conv_id", *[F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs)
    base = F.filter("spans", lambda s: s["kind_no"] < len(secret_scan.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(rule.kind) for rule in secret_scan.BASE]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"))


QUERIES = {f.__name__: f for f in (
    op1_near_duplicates, op2_fingerprints, op3_repeated_strings, op4_line_quality, op5_quality_rules, op6_bpe, op7_token_counts,
    op8_repeated_windows, op9_source_mix, op10_language, op11_merkle_manifest, op12_turn_repair, op13_secret_spans)}
SQL: dict[str, str] = {"op11_merkle_manifest": sql.MERKLE_MANIFEST, "op12_turn_repair": sql.TURN_REPAIR, "op13_secret_spans": sql.SECRET_SPANS}
