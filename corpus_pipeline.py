"""The corpus pipeline: documents in, packed training sequences out.

Each stage is a function of (spark, docs, sf_dir) and works on all rows that the stage
before kept. `run` writes each result to the shared folder and reads it back, so a stage is
evaluated once and a lost executor costs only its own tasks. A stage removes those of its
intermediate tables that its result does not read, and nothing else; `run` removes the others,
and the input of a stage, once the stage's result is written.

All stages take nulls in any column, texts of any length, repeated rows and extra columns, and
give no rows for an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from meterstar.llm import jaccard, packing, quality_rules, secrets, toxicity
from meterstar.llm.common import read_table
from meterstar.scratch import collecting, read_by, remove, staged

TOXIC_FROM = 0.5

def _stage(function: Callable) -> Callable:
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with collecting() as made:
            result = function(spark, docs, sf_dir)
        needed = read_by(result, made)
        remove(spark, [p for p in made if p not in needed])
        return result

    return run_stage


@_stage
def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without lines above the frequency limits.

    Null, empty and very short texts go. Repeated rows pass or go alike; a null source is a
    host of its own. Ids are not looked at.
    """
    return quality_rules.filter_documents(docs)


@_stage
def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a model of the labelled ones among them.

    Null ids have no label and are scored like others. Without labels of both kinds the score
    is their mean, 0 without any, so that all documents stay.
    """
    return toxicity.clean_documents(docs, read_table(spark, sf_dir, "labels"), TOXIC_FROM)


@_stage
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Null ids come last; of rows alike in id and text, the one whose other columns sort first
    stays. Texts without words are copies of nothing.
    """
    return jaccard.distinct_documents(docs)


@_stage
def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in them replaced by a mark of its kind; null texts stay null."""
    return secrets.redact_documents(docs)


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token sequences and their places in training sequences.

    A null or empty text is one end mark. Repeated rows are packed each.
    """
    return packing.pack_documents(docs, keep_ids=False)


STAGES = [
    ("quality_rules", rules),
    ("toxicity", not_toxic),
    ("ngram_jaccard_join", one_of_each),
    ("secret_scans", no_secrets),
    ("best_fit_packing", packed),
]

# Trained scores, secrets in encoded layers and token ids are beyond SQL; the stages are
# tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with collecting() as made:
            result = staged(stage(spark, docs, sf_dir), name)
        kept = read_by(result, made)
        remove(spark, [*(p for p in made if p not in kept), *before])
        docs, before = result, kept
    return docs
