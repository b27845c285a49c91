"""From documents to packed training sequences: rules, a classifier, one of each group of near copies, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the
columns of ``docs``. Tables besides the documents are read from ``sf_dir``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quayside.llm import ngram_join, packing, quality_rules, rule_ensemble
from quayside.sources import read_table
from quayside.sources.tables import stored


def rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Columns are those of ``docs``; a null or empty text is rejected."""
    rules = quality_rules.fit_quality_rules(docs, read_table(spark, sf_dir, "labels"))
    judged = quality_rules.judge_documents(docs.select(F.struct("*").alias("row"), "text"), rules)
    return judged.filter("rules.kept").select("row.*")


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is 1. Without labels of both kinds all are kept if most are of quality 1."""
    model = rule_ensemble.fit_rule_ensemble(docs, read_table(spark, sf_dir, "labels"))
    scored = rule_ensemble.score_documents(docs.select(F.struct("*").alias("row"), "text"), model)
    return scored.filter("predicted = 1").select("row.*")


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group that links of five-word shingles, 0.8 alike, hold together."""
    return ngram_join.keep_one(docs, n=5, percent=80)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and its place there."""
    cut = packing.cut_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_pieces(stored(cut, "pieces"))


STAGES = [("quality rules", rule_stage), ("quality classifier", classifier_stage),
          ("near copies", near_copy_stage), ("packing", packing_stage)]

#: The isolation forest, the rule ensemble and the packing plan are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; what a stage returns is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
