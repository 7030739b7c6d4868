"""The registered queries: each operator over its whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import (
    bitsliced_search,
    cap_filters,
    crf_quality,
    fm_decontaminate,
    jaccard_join,
    language_id,
    license_scan,
    line_winnowing,
    page_diff,
    sentencepiece,
    substring_dedup,
    url_filters,
    vector_codes,
)
from shelfwise.llm.oracles import ORACLE
from shelfwise.llm.tasks import importable

__all__ = ["ORACLE", "QUERIES"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judge(table(spark, folder, "pages"), min_share=0, depth=None)


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece.encoded(table(spark, folder, "documents"))


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return crf_quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.predict(table(spark, folder, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.components_of(table(spark, folder, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cap_filters.near_duplicates(table(spark, folder, "embeddings"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return fm_decontaminate.contamination_report(table(spark, folder, "documents"),
                                                 table(spark, folder, "benchmark"))


def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return page_diff.main_texts(table(spark, folder, "pages"))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_winnowing.removal_report(table(spark, folder, "documents"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.removal_report(table(spark, folder, "documents"))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return bitsliced_search.ranking(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_report(table(spark, folder, "documents"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compression_report(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filters, op2_sentencepiece, op3_quality_classifier, op4_language_id,
                            op5_ngram_jaccard_join, op6_embedding_near_dedup, op7_decontamination,
                            op8_html_extraction, op9_line_dedup, op10_substring_dedup,
                            op11_ranked_search, op12_license_scan, op13_vector_codes)
}
