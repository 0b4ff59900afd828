"""The registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from treelab.llm import bagminhash, byte_bpe, chat, decontamination, extraction, lexical, mixing, oracle, pii, quality_crf, quality_rules, repair, tokens, toxicity
from treelab.llm.shared import settle, table

#: Production parameters of the mixture: share of all tokens to draw, most passes over a leaf, weights by branch.
MIX = {"budget_share": 0.6, "max_epochs": 4, "seed": 17,
       "weights": {"domain": {"dom0": 4, "dom1": 3, "dom2": 2, "dom3": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}, "source": {"src0": 3}}}
PII_KEY = "corpus-2024"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extraction.extract(table(spark, sf_dir, "pages"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and conversation -1, whose texts are control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.examples(rows.unionByName(probe)))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds."""
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of held-out rows are not learned."""
    docs = table(spark, sf_dir, "documents")
    field = quality_crf.train(docs, table(spark, sf_dir, "labels"))
    return quality_crf.score(docs, field).select("doc_id", quality_crf.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mixture reads each document, and from which leaf."""
    return mixing.select(table(spark, sf_dir, "documents"), **MIX)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities of every document and the verdict."""
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, chain).withColumn("toxic", (F.col("p_toxic") >= 0.5).cast("int"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document."""
    return bagminhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms in place of personal data."""
    return pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from the token shards."""
    return tokens.token_table(table(spark, sf_dir, "documents"), tokens.public_path("word_bpe_49k.json"), end_id=2).drop("shard")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the verdict of every document; its host is its source."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), F.col("source")).select(
        "doc_id", *quality_rules.MEASURES, "base_failed", "kept")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text as ids of the byte-level vocabulary, and back."""
    return byte_bpe.digests(table(spark, sf_dir, "documents"), tokens.public_path("byte_bpe_50k.tiktoken"), byte_bpe.public_pattern())


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired text of every conversation after planted damage."""
    given = table(spark, sf_dir, "conversations")
    rows = repair.rows_of(repair.damaged(given))
    reports = settle(repair.report(rows), "repair-reports")
    digests = repair.text_digests(repair.repaired(rows, reports))
    ids = given.select(F.col("conv_id").alias("id")).distinct()
    found = ids.join(reports, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    found = found.join(digests, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline, one after another."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_chat_formatting, op3_decontamination, op4_quality_classifier, op5_mixing, op6_toxicity, op7_near_dedup,
    op8_pii, op9_token_shards, op10_quality_rules, op11_byte_bpe, op12_lexical_search,
    op13_structure_repair, pipeline)}
ORACLE = {"op2_chat_formatting": oracle.CHAT, "op5_mixing": oracle.mixing(**MIX), "op10_quality_rules": oracle.QUALITY_RULES,
          "op12_lexical_search": oracle.LEXICAL_SEARCH, "op13_structure_repair": oracle.STRUCTURE_REPAIR}
