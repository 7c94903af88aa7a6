"""Catalogue entries of the subpackage: ``QUERIES`` and ``ORACLES``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (decontam, divergence, html_blocks, jaccard, mixing, ngram_lm, oracles, quality, resharding, substrings, tokencount, toolcalls,
                            vectorcodes, warc)
from corpusloom.llm.common import read_table

MIX_SHARES = {"src0": 4}
#: A user turn of a plain chat as a call; its text must say something.
REPLY_TOOL = {"reply": {"type": "object", "required": ["text"], "additionalProperties": False,
                        "properties": {"text": {"type": "string", "minLength": 1}}}}


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read_table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_documents(read_table(spark, sf_dir, "documents"), order=2)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.component_report(read_table(spark, sf_dir, "documents"), shingle=3, percent=90)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.with_token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract_pages(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, shares=MIX_SHARES)


def op9_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return resharding.assignments(docs, new_shards=16, old_shards=12).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op10_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = toolcalls.link(read_table(spark, sf_dir, "conversations"), REPLY_TOOL, turn_tool="reply")
    return linked.withColumn("conv_id", F.col("conv_id").cast("long"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(read_table(spark, sf_dir, "pages"), least_bytes=0)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.encode(read_table(spark, sf_dir, "embeddings")).drop("label")


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_quality_rules": quality.quality_report,
    "op6_token_counts": op6_token_counts,
    "op7_main_text": op7_main_text,
    "op8_source_mixing": op8_source_mixing,
    "op9_resharding": op9_resharding,
    "op10_tool_call_linking": op10_tool_call_linking,
    "op11_warc": op11_warc,
    "op12_source_divergence": op12_source_divergence,
    "op13_vector_codes": op13_vector_codes,
}
#: Operators 3, 5, 6, 7 and 9 use hashes, a trained model or a library that SQL does
#: not have; tests/llm holds them against brute force, the library or their law.
ORACLES = {
    "op1_decontamination": oracles.containment(),
    "op2_substring_dedup": oracles.repeats(),
    "op4_ngram_jaccard_join": oracles.jaccard(),
    "op8_source_mixing": oracles.mixing(MIX_SHARES),
    "op10_tool_call_linking": oracles.turn_links(),
    "op11_warc": oracles.archives(),
    "op12_source_divergence": oracles.divergence(),
    "op13_vector_codes": oracles.vector_codes(),
}
