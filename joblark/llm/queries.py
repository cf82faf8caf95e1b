"""The registered queries of this package: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joblark.llm import (
    bpe, chat, decontaminate, divergence, language_id, merkle, packing, quality_classifier, quality_rules, simhash, substring_dedup,
    suffix_dedup, toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def covered(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def left_out(modulus: int, remainder: int) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    lexicon = toxicity.fit(docs.where(~left_out(3, 1)), labels.where(~left_out(3, 1)))
    found = toxicity.toxicity(docs, lexicon, F.coalesce(left_out(3, 1), F.lit(False)).alias("held_out"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("matches").alias("n_matches"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality_classifier.quality_scores(docs, labels, left_out(5, 0))
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.explode(F.array(*(F.struct(F.lit(t).cast("long").alias("turn"), F.lit(role).alias("role")) for t, role in enumerate(("user", "assistant"))))).alias("t"),
    ).select("conv_id", "t.turn", "t.role", F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select(*extra.columns).unionByName(extra)
    chats = chat.format_chats(rows).withColumns(
        {"turns": chat.read_back(F.col("formatted")), "learned": chat.learned(F.col("segments"))}
    )
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        sha256(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), sha256(F.col("learned")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = covered(F.col("runs"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", covered(F.col("spans")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), sha256(F.col("kept")).alias("kept_sha256"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~left_out(5, 0)))
    found = language_id.languages(docs, model, F.coalesce(left_out(5, 0), F.lit(False)).alias("held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", covered(F.col("spans")).alias("n_removed"), sha256(F.col("kept_words")).alias("kept_sha256")
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(table(spark, sf_dir, "documents"), kept={"doc_id": F.col("doc_id"), "tampered": merkle.leaf(text=changed)})
    folded = found.withColumn("folded", merkle.fold(F.col("tampered"), F.col("path")))
    return folded.select(
        "doc_id", merkle.hexadecimal(F.col("digest")).alias("leaf"), *(merkle.hexadecimal(F.col(c)).alias(c) for c in ("subroot", "root")),
        sha256(merkle.proof_text(F.col("path"))).alias("proof_sha256"), merkle.hexadecimal(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_chat": op3_chat,
        "op4_bpe": op4_bpe,
        "op5_simhash_dedup": op5_simhash_dedup,
        "op6_decontaminate": op6_decontaminate,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_quality_rules": op8_quality_rules,
        "op9_language_id": op9_language_id,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_packing": op11_packing,
        "op12_merkle": op12_merkle,
        "op13_source_divergence": op13_source_divergence,
    }
