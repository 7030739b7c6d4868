"""Versioned reports in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.sources.storage import path_exists


def next_version(spark: SparkSession, path: str) -> int:
    """One more than the highest version written, starting at 1."""
    if not path_exists(spark, path):
        return 1
    return (spark.read.parquet(path).agg(F.max("version")).first()[0] or 0) + 1


def save_report(report: DataFrame, path: str) -> int:
    """Add the report as a new version and return its number."""
    version = next_version(report.sparkSession, path)
    (report.withColumn("version", F.lit(version)).write.mode("append")
     .partitionBy("version").parquet(path))
    return version


def latest_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("version") == next_version(spark, path) - 1)
