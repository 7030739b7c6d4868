"""The shared folder for intermediate tables, and lineage cuts written to it."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_local_folders: dict[str, str] = {}
_collecting = threading.local()  # paths of the tables cut in this thread, or None where they last


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting (tests) falls back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="shelfwise-")
    return _local_folders[application]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/shelfwise/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def make_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a derived table to the shared folder and go on from there.

    The rows survive the loss of any executor, are computed once however often they are used,
    and Catalyst knows their true size.
    """
    path = new_path(df.sparkSession, "table")
    paths = getattr(_collecting, "paths", None)
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession):
    """Tables cut inside are deleted at the end: for work that stores its results before it is over."""
    before, _collecting.paths = getattr(_collecting, "paths", None), []
    try:
        yield
    finally:
        paths, _collecting.paths = _collecting.paths, before
        for path in paths:
            delete_folder(spark, path)


@contextmanager
def lasting():
    """Tables cut inside stay, also within ``temporary`` work."""
    before, _collecting.paths = getattr(_collecting, "paths", None), None
    try:
        yield
    finally:
        _collecting.paths = before


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
