"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ebbflow.llm import chat, decontaminate, hard_negatives, html_text, katz, near_dedup, quality, quality_classifier, sentencepiece_lattice, token_count, vector_codes, warc, wavelet
from ebbflow.llm.common import table


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(table(spark, sf_dir, "conversations"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.class_report(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_lattice.encoding_report(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_shards(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_report(table(spark, sf_dir, "pages"))


def op9_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.lm_scores(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.negatives_report(table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_near_dedup": op2_near_dedup,
    "op3_html_text": op3_html_text,
    "op4_token_count": op4_token_count,
    "op5_quality_rules": op5_quality_rules,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_token_shards": op7_token_shards,
    "op8_warc": op8_warc,
    "op9_katz": op9_katz,
    "op10_decontamination": op10_decontamination,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_vector_codes": op13_vector_codes,
}
