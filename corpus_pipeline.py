"""A corpus pipeline of five stages over ``documents``.

Each stage gets all rows that the stage before it kept, is written as Parquet
to the shared folder, and is read again as the next one's input.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import mil, packing, quality_rules, secret_scan, simhash
from tidewatch.llm.common import table, written


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the rules reject; a null text is rejected (no words)."""
    return quality_rules.filtered(docs)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier scores low.

    It learns from the labelled rows of the whole table, since the rules have
    already dropped most of the poor ones from ``docs``.
    """
    model = mil.trained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mil.filtered(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each class of near copies."""
    return simhash.deduplicated(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark; no document goes."""
    return secret_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their ids."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", apply_rules),
    ("quality_classifier", classify),
    ("simhash", drop_copies),
    ("secret_scan", redact),
    ("packing", pack),
]

#: No SQL: the classifier, the fingerprints and the tokenizer are beyond it; tests compare the near-copy stage with all pairs, and run() with its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
