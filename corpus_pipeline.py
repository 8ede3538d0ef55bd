"""The corpus pipeline: quality rules, near-duplicate join, repeated-string removal, PII masking, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.  Null and empty texts fail the first
stage's rule and go there; rows that repeat id and text are one document and one of them stays in the second; ties of a
near-duplicate group go to the least id, then text hash; an empty table stays empty; columns beside ``text`` and
``n_chars`` pass unchanged, whatever their names.  All but the last return the columns
of ``documents``.  ``run`` writes each stage's result to the shared folder and rereads it as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veridex.llm import jaccard, packing, pii, quality, suffixes
from veridex.llm.common import bounded, materialize, read_documents


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; of the others, lines above the limits."""
    bounded(spark)
    return quality.filter_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: five-word shingles, similarity of 0.8 or more."""
    bounded(spark)
    return jaccard.deduplicate(docs, width=5, percent=80)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 100-byte strings that occur earlier go."""
    bounded(spark)
    return suffixes.cut_documents(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked by its kind."""
    bounded(spark)
    return pii.mask_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    import public_tokenizers

    bounded(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("suffix_array_dedup", suffix_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Tagging and packing are not expressible in SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}", "snappy")
    return docs
