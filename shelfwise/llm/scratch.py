"""Where operators cut lineage: the folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; only a local session without one gets a folder of its own."""
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="shelfwise-llm-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return path


def cut(frame: DataFrame) -> DataFrame:
    """The same rows, stored in the checkpoint folder."""
    checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def stored(frame: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """The same rows, written as Parquet (with the writer's ``options``) below the checkpoint folder and read again."""
    spark = frame.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    frame.write.options(**(options or {})).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
