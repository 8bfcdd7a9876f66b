"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of documents;
the last one returns packed pieces. ``run`` writes each stage's rows to the shared scratch folder and reads
them back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlake.llm.common import read
from feedlake.llm.decontaminate import clean_documents
from feedlake.llm.jaccard_join import keep_one_each
from feedlake.llm.line_crf import fit_lines, keep_documents
from feedlake.llm.packing import packing_report
from feedlake.llm.secret_scan import mask_secrets
from feedlake.session import landed


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the line field; the others go."""
    return keep_documents(docs, fit_lines(docs, read(spark, sf_dir, "labels")))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return clean_documents(docs, read(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed token sequences."""
    return packing_report(docs)


STAGES = [
    ("quality_rules", quality_rules), ("jaccard_join", jaccard_join), ("decontamination", decontamination),
    ("secret_scan", secret_scan), ("packing", packing),
]
#: The line field and the tokenizer have no SQL; tests/llm/ checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
