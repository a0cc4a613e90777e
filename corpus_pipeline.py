"""A training-data pipeline over the documents of one folder.

Toxic documents go, documents outside the quality fences go, later copies of repeated line runs are cut out of
the texts, one document of each near-duplicate group stays, and what is left is packed into sequences. Every
stage reads what its predecessor wrote; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from scriptloom.llm import line_dedup, packing, quality_rules, setsketch, toxicity
from scriptloom.session import checkpoint_root


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits the severity model to labelled rows among docs; documents at or above the cut go."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or the fences of their language and source go."""
    return quality_rules.kept_documents(docs)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs are deleted; documents that lose every line go."""
    return line_dedup.cleaned_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group stays."""
    return setsketch.kept_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("line_dedup", cut_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: No SQL: a fitted model and a learned vocabulary have no SQL form. tests/llm holds it against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over documents; what lies between is written to the shared folder."""
    root = f"{checkpoint_root(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{root}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{name}")
    return docs
