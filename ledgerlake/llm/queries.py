"""The registered queries of this subpackage: one per operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    chat,
    decontaminate,
    embedding_dedup,
    jaccard,
    langid,
    mixing,
    packing,
    quality,
    repair,
    secrets,
    substring_dedup,
    toxicity,
    variants,
)
from ledgerlake.llm.common import table, written


def op1_rlz_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"),
        F.size("spans").cast("long").alias("n_spans"))


def op2_cap_filter_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup(table(spark, sf_dir, "embeddings"))


def op3_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "n_links", "component_id")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = packing.pieces(table(spark, sf_dir, "documents"),
                           public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.pack(items).select("doc_id", "piece", "start", "length", "ids_crc32",
                                      "sequence_id", "offset")


def fold(of: str, n: int) -> Column:
    """crc32 of the id as text, modulo n: the folds of labelled rows."""
    return F.pmod(F.crc32(F.col(of).cast("string")), F.lit(n))


def op6_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, fold("id", 5) != 0)
    df = langid.predict(docs, model, ["doc_id"])
    return df.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op9_fm_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("id", 3) != 1)
    df = toxicity.score(docs, model, ["doc_id"])
    return df.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
                     (F.col("score") >= 0.7).cast("int").alias("predicted"))


def weights_521(sources: list) -> list:
    return [(5, 2, 1)[i % 3] for i in range(len(sources))]


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = mixing.mix(table(spark, sf_dir, "documents"), weights_521)
    return df.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken",
                     F.element_at("pattern", 1).alias("source"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = secrets.scan(table(spark, sf_dir, "documents"))
    return s.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}")
                                for k in ("assign", "access", "hex")],
                    F.sha2(secrets.listed("assign", "access", "hex"), 256).alias("base_sha256"),
                    secrets.listed("assign", "access", "hex", "random").alias("spans"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(quality.measure(table(spark, sf_dir, "documents")))


def op11_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return df.select("doc_id", "n_words", "n_hit", "n_items",
                     F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                     (F.col("n_hit") > 0).alias("contaminated"))


def op12_vgram_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.vocabulary(table(spark, sf_dir, "documents"), typo=31)
    return variants.group(words).select("word", "form", "root", "n", "n_near", "form_n")


def damaged(convs: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with faults, dealt by crc32 of ``conv_id:turn``."""
    def read(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    deal = F.pmod(F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn"))), F.lit(20))
    text = read("text")
    return (convs.select("conv_id", "turn", deal.alias("deal"), read("role").alias("role"), text.alias("text"))
            .where("deal <> 0")
            .select("conv_id", "turn", F.when(F.col("deal") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("deal") == 1, "").when(F.col("deal") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("deal") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations")
    rows = damaged(convs)
    found = written(repair.repair(rows), "op13-repair")
    sha = repair.digests(repair.repaired(rows, found))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (convs.select(F.col("conv_id").alias("id")).distinct()
            .join(found, F.expr("id <=> conv_id"), "left")
            .join(sha.select(F.col("conv_id").alias("of"), "sha256"), F.expr("id <=> of"), "left")
            .select(F.col("id").alias("conv_id"),
                    *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in numbers],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))


QUERIES = {f.__name__: f for f in (
    op1_rlz_substring_dedup, op2_cap_filter_dedup, op3_perspective_rotation,
    op4_ngram_jaccard_join, op5_best_fit_packing,
    op6_crf_language_id, op7_source_mixing, op8_secret_scan, op9_fm_toxicity, op10_quality_rules,
    op11_wu_manber_decontamination, op12_vgram_spelling_variants, op13_conversation_repair)}
