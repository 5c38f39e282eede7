"""The corpus pipeline: documents through filters and near-duplicate removal into packed sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import packing, toxicity
from tidemark.llm.jaccard_join import JaccardParams, keep_one
from tidemark.llm.line_runs import dedup_lines
from tidemark.llm.quality_rules import reject_low_quality
from tidemark.llm.shared import read_table, stage


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models, fitted on their labelled rows, do not call toxic."""
    return toxicity.reject_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return reject_low_quality(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them hold."""
    return dedup_lines(docs, min_docs=10)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return keep_one(docs, JaccardParams(words=5, num=80, den=100))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, packing.JsonCodec(spark, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

# The language models of the first stage and the tokens of the last have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
