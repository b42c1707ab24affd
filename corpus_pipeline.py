"""From raw documents to packed training sequences, in stages that are each written and reread.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``documents``;
the last returns the pieces of the packed sequences. A document that leaves at one stage is not
seen by the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from larder.llm import minhash, packing, quality, secrets, toxicity
from larder.llm.common import Written, read, ready


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    ready(spark)
    return toxicity.not_toxic(docs, read(spark, sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go; the others lose the lines that fail."""
    ready(spark)
    return quality.clean_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays (shingles of five words, similarity 0.8 or more)."""
    ready(spark)
    return minhash.one_of_each(docs, words=5, percent=80)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced."""
    ready(spark)
    return secrets.redact(docs, public_tokenizers.path("word_bpe_49k.json"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are cut and packed into sequences of 2048 ids."""
    ready(spark)
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

# The first stage is learnt and the last tokenizes, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the stages make of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        after = Written(stage(spark, docs, sf_dir), name)
        if before is not None:
            before.drop()
        docs, before = after.frame, after
    return docs
