"""Writers. Row counts come from the write itself (``observe``), never from a second scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, functions as F, types as T


# JSON texts keep microseconds; Spark's default keeps milliseconds.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**JSON_OPTIONS).json(path)


def write_catalog(catalog: DataFrame, path: str) -> None:
    """A catalog as files of records, each with ``pos``, the order of its entries."""
    write_json(catalog.select("id", "name", "category", "price", "description", "pos"), path)


def counted_write(df: DataFrame, path: str, fmt: str = "parquet",
                  partition_by: Sequence[str] = (), nulls: bool = False,
                  options: Mapping[str, str] = {}) -> dict:
    """Write and return ``rows`` (and ``null_{i}`` per column) counted on the way."""
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    if nulls:
        measures += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}")
                     for i, c in enumerate(df.columns) if c not in set(partition_by)]
    writer = df.observe(seen, *measures).write.mode("overwrite").options(
        **{**(JSON_OPTIONS if fmt == "json" else {}), **options})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)
    return seen.get


def write_dated(df: DataFrame, path: str, day: date, nulls: bool = True) -> dict:
    """Write one ``run_date=`` partition; other days stay as they are."""
    return counted_write(
        df.withColumn("run_date", F.lit(str(day)).cast("date")), path,
        partition_by=["run_date"], nulls=nulls, options={"partitionOverwriteMode": "dynamic"})


def write_rejects(df: DataFrame, path: str, fmt: str = "json") -> int:
    """Write failing rows in one pass and return how many there were."""
    return counted_write(df, path, fmt)["rows"]


def as_flat_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats without nesting."""
    return df.withColumns({
        f.name: F.to_json(F.col(f"`{f.name}`")) for f in df.schema.fields
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))})


def save_feed(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Save a cleaned feed as csv or json."""
    fmt = fmt.lower()
    if fmt == "csv":
        # Quotes inside JSON texts are doubled, as every CSV reader expects.
        as_flat_columns(df).write.mode("overwrite").options(header="true", escape='"').csv(path)
    elif fmt == "json":
        write_json(df, path)
    else:
        raise ValueError(f"unsupported output format: {fmt}")


def write_split(flagged: DataFrame, issues: str, path: str, fmt: str = "parquet") -> dict:
    """Valid rows below ``is_valid=true``, rows with issues below ``is_valid=false``; one scan.

    A side without rows leaves no folder. Returns both row counts.
    """
    seen, valid = Observation(), F.col(issues) == ""
    split = flagged.withColumn("is_valid", valid).observe(
        seen, F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("invalid"))
    split.write.mode("overwrite").partitionBy("is_valid").format(fmt).save(path)
    return seen.get


def write_report(report: DataFrame, path: str) -> None:
    write_json(report, path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def kafka_sink_options(servers: str, topic: str, checkpoint: str) -> dict:
    """Options of a stream writer to a topic; offsets live in the checkpoint."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Send message texts (column ``value``) of a batch to a topic."""
    (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())
