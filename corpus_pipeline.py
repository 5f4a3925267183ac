"""From raw documents to token ids: quality, near duplicates, benchmark passages, personal data, BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from musterline.llm.byte_bpe import stage_byte_bpe
from musterline.llm.decontamination import stage_decontamination
from musterline.llm.ngram_jaccard_join import stage_ngram_jaccard_join
from musterline.llm.pii import stage_pii
from musterline.llm.quality_classifier import stage_quality_classifier
from musterline.session import written

STAGES = [
    ("quality_classifier", stage_quality_classifier),
    ("ngram_jaccard_join", stage_ngram_jaccard_join),
    ("benchmark_decontamination", stage_decontamination),
    ("pii", stage_pii),
    ("byte_bpe", stage_byte_bpe),
]

#: Fitted scorers, SimHash and BPE have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is stored in the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
