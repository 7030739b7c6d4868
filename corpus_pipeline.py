"""A corpus pipeline: quality, repeated lines, near duplicates, benchmark passages, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm import crf_quality, fm_decontaminate, jaccard_join, line_winnowing, sentencepiece
from shelfwise.llm.scratch import checkpoint_dir
from shelfwise.llm.tasks import importable, unused
from shelfwise.sources.storage import delete_folder


def measured(changed: DataFrame, like: DataFrame) -> DataFrame:
    """n_chars as the texts have it now; the columns of ``like``."""
    return changed.withColumn("n_chars", F.length("text").cast("long")).select(*like.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field accepts; it is fitted on all labelled folds but the held-out one."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    field = crf_quality.train(docs.where(~crf_quality.held_out()),
                              labels.where(~crf_quality.held_out()).select("doc_id", F.col("quality").alias("label")))
    name = unused("score", docs)
    return crf_quality.score(docs, field, name).where(F.col(name) >= crf_quality.PREDICT_AT).drop(name)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that occurred before, of three lines or 50 words; a document may be left empty."""
    return measured(line_winnowing.remove_repeated_lines(docs, min_words=line_winnowing.MIN_WORDS), docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates (five words, 0.8 or more)."""
    return jaccard_join.keep_one(docs, 5, (80, 100))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items."""
    return measured(fm_decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with the proof that they decode to it."""
    return sentencepiece.encoded(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("sentencepiece encoding", piece_encoding),
]

#: The classifier and the encoder cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the checkpoint folder and read again; the last one's rows.

    What a stage read is deleted once its own output is stored, so only the input of the last stage remains.
    """
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{number}")
        if number:
            delete_folder(spark, f"{base}/{number - 1}")
        docs = spark.read.parquet(f"{base}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
