"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedlake.llm.best_fit import best_fit_report
from feedlake.llm.common import read
from feedlake.llm.decontaminate import find_leaks
from feedlake.llm.html_extract import extract_pages
from feedlake.llm.jaccard_join import jaccard_groups
from feedlake.llm.line_crf import fit_lines, judge_documents
from feedlake.llm.packing import packing_report
from feedlake.llm.periodic_runs import run_report
from feedlake.llm.quality_qda import score_quality
from feedlake.llm.secret_scan import secret_report
from feedlake.llm.spelling import spelling_report
from feedlake.llm.token_files import token_file_report
from feedlake.llm.toxicity_fm import score_toxicity
from feedlake.llm.url_tree import judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(read(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_report(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return judge_documents(docs, fit_lines(docs, read(spark, sf_dir, "labels")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_report(read(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(read(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_report(read(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(read(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_report(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_quality_classifier, op3_secret_scan, op4_packing, op5_toxicity, op6_quality_rules,
        op7_decontamination, op8_token_files, op9_jaccard_join, op10_url_filter,
        op11_spelling_variants, op12_periodic_runs, op13_best_fit_packing,
    )
}
#: No DuckDB SQL: the methods are learnt, iterative or need a tokenizer; tests/llm/ holds brute-force versions.
ORACLE: dict[str, str] = {}
