"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. The first three are filters: they return the columns of ``documents`` unchanged. The last one encodes what
is left. A stage that is repeated gives the same rows, so a lost executor costs at most the current stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbflow.llm import decontaminate, near_dedup, quality, sentencepiece_lattice
from ebbflow.llm.common import materialize, small_batches, table
from ebbflow.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the rules reject go."""
    return quality.passing(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates: one document of each class stays, that with the smallest id."""
    return near_dedup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents in which a benchmark window occurs go."""
    with small_batches(spark):  # whole documents pass through Python: written here, while the batches are small
        return materialize(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")), "decontaminated")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every remaining document, checked by decoding: doc_id, n_pieces, ids, round_trip."""
    return sentencepiece_lattice.encoding_report(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", keep_quality),
    ("near_dedup", keep_one_of_each),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: SQL cannot align near copies or run a Viterbi search; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
