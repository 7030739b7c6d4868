"""A table of processed timestamps, of which the newest counts, and the jobs that advance: in batches, and as a stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shelfwise import constants as K
from shelfwise.operators.clean import keep_valid_cart_rows, newer_than
from shelfwise.sources.storage import path_exists

SCHEMA = "last_processed_ts timestamp_ntz"


def read_bookmark(spark: SparkSession, path: str):
    """The last processed timestamp, or the default when none was written."""
    if not path_exists(spark, path):
        return datetime.fromisoformat(K.DEFAULT_BOOKMARK)
    newest = spark.read.schema(SCHEMA).parquet(path).agg(F.max("last_processed_ts"))
    return newest.first()[0] or datetime.fromisoformat(K.DEFAULT_BOOKMARK)


def write_bookmark(spark: SparkSession, path: str, stamp) -> None:
    """Append the new position: a failed write can never lose the one before."""
    spark.createDataFrame([(stamp,)], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def clean_new_cart_rows(source: DataFrame, bookmark_path: str, output_path: str,
                        batch: str) -> dict:
    """Clean the cart rows changed since the bookmark into ``batch=``, then move the bookmark.

    One scan: rows are counted and the newest timestamp is found while writing. The newest
    timestamp is that of all new rows, so that bad rows are not read again. Data first, bookmark
    second: a run that fails between them repeats its batch, overwriting the same folder.
    """
    spark = source.sparkSession
    last = read_bookmark(spark, bookmark_path)
    fresh, seen, kept = newer_than(source, F.lit(last)), Observation(), Observation()
    fresh = fresh.observe(seen, F.count(F.lit(1)).alias("rows"),
                          F.max("updated_at").alias("newest"))
    cleaned = keep_valid_cart_rows(fresh).observe(kept, F.count(F.lit(1)).alias("rows"))
    cleaned.write.mode("overwrite").parquet(f"{output_path}/batch={batch}")
    newest = seen.get["newest"]
    if newest is not None:
        write_bookmark(spark, bookmark_path, newest)
    return {"read": seen.get["rows"], "kept": kept.get["rows"], "bookmark": newest or last}


def start_cart_cleaning(spark: SparkSession, landed: str, schema: T.StructType, output: str, checkpoint: str,
                        since: str = K.DEFAULT_BOOKMARK, available_now: bool = True, interval: str = "1 minute",
                        files_per_trigger: int = 1000) -> StreamingQuery:
    """Clean cart rows as their files land; the checkpoint is the bookmark.

    What has been read is known by file, so a row counts once however late its ``updated_at`` is: a late row is
    cleaned when it lands, where the batch job would pass it over. Only rows up to ``since`` are left out. Each
    micro-batch overwrites its own folder, so a repeated one leaves no row twice.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landed)
    cleaned = keep_valid_cart_rows(newer_than(rows, F.lit(datetime.fromisoformat(since))))
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (cleaned.writeStream.trigger(**trigger).option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{output}/batch={n}")).start())
