"""Training-data pipeline: quality rules, near-dedup, repeated passages, mixing to weights, tokens.

Each stage takes the documents that the one before it kept, as they were written, and all but the last return the columns
of ``documents``. ``run`` applies them to a scale-factor folder.

Defined results: a stage that is given no rows returns none; rows equal in key and text leave the near-dedup as one; further
columns pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkgrad.llm.bpe import digests, vocabulary_path
from sparkgrad.llm.mixing import mixed
from sparkgrad.llm.quality_rules import keep_good
from sparkgrad.llm.simhash import one_of_each
from sparkgrad.llm.suffix_dedup import dedup_text
from sparkgrad.llm.text import read
from sparkgrad.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id; linked are SimHash fingerprints as in ``op2_simhash``."""
    return one_of_each(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that stand earlier already are cut out."""
    return dedup_text(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and digests of the ids and of the decoded text."""
    return digests(docs, vocabulary_path())


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("passage_dedup", passage_dedup),
          ("mix_sources", mix_sources), ("encode_tokens", encode_tokens)]

# Fingerprints, repeated byte strings, random rounding and merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
