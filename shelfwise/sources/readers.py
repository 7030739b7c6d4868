"""Readers with declared schemas."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise import constants as K
from shelfwise import schemas
from shelfwise.sources.storage import is_folder, path_exists


def jdbc_options(url: str, table: str | None = None, query: str | None = None,
                 user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower_bound=None, upper_bound=None, num_partitions: int | None = None,
                 fetch_size: int = 10_000) -> dict:
    """Options of a JDBC scan of a table or of a query the database runs.

    With a partition column the scan is split into ranges and read in parallel. Credentials come
    from the caller and are never printed.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    split = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(v is not None for v in split) and any(v is None for v in split):
        raise ValueError("a partitioned scan needs column, both bounds and a partition count")
    options = {"url": url, "user": user, "password": password, "driver": driver,
               "fetchsize": fetch_size, "partitionColumn": partition_column,
               "lowerBound": lower_bound, "upperBound": upper_bound,
               "numPartitions": num_partitions}
    # Spark rejects `query` together with a partition column; a derived table allows both.
    if query is not None and partition_column is None:
        options["query"] = query
    else:
        options["dbtable"] = table if query is None else f"({query}) as t"
    return {k: str(v) for k, v in options.items() if v is not None}


def read_jdbc(spark: SparkSession, **arguments) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**arguments)).load()


def list_tables_query() -> str:
    return "SELECT table_name FROM information_schema.tables WHERE table_schema = DATABASE()"


def read_table(read: Callable[[str], DataFrame], name: str, attempts: int = 3) -> DataFrame:
    """Open a table, trying again when the source does not answer, then raise.

    Reads are lazy: this covers opening the table, and Spark retries failed tasks itself.
    """
    last = None
    for _ in range(attempts):
        try:
            return read(name)
        except Exception as error:  # sources raise many kinds
            last = error
    raise RuntimeError(f"could not load table {name} in {attempts} attempts") from last


def read_tables(read: Callable[[str], DataFrame], names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: read_table(read, name) for name in names}


def read_available(read: Callable[[str], DataFrame], names: Sequence[str],
                   ) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables that open, and the names of those that do not."""
    tables, missing = {}, []
    for name in names:
        try:
            tables[name] = read(name)
        except Exception:
            missing.append(name)
    return tables, missing


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one JSON array, or one object."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_feed(spark: SparkSession, path: str, schema: str = schemas.FEED,
              multi_line: bool = False) -> DataFrame:
    """A product feed by file extension; every field arrives as text.

    ``multi_line`` is for fields with line breaks: such a CSV file is read by one task.
    """
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension == ".csv":
        return (spark.read.schema(schema)
                .options(header="true", escape='"', multiLine=str(multi_line).lower(),
                         enforceSchema="false")
                .csv(path))
    if extension == ".json":
        return read_json_array(spark, path, schema)
    raise ValueError(f"unsupported file format: {extension}")


def default_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(*row, pos) for pos, row in enumerate(K.DEFAULT_CATALOG)], f"{schemas.CATALOG}, pos bigint")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalog with ``pos``, the order of its entries.

    A folder holds records with a stored ``pos`` (``sinks.write_catalog``), which are read in parallel. A
    file is one JSON array, whose order is its text; only one task can read that, so it suits
    catalogs that people keep by hand. A missing or unreadable catalog gives the default one.
    """
    if not path_exists(spark, path):
        return default_catalog(spark)
    try:
        if is_folder(spark, path):
            catalog = spark.read.schema(f"{schemas.CATALOG}, pos bigint").option("mode", "FAILFAST").json(path)
        else:
            element = "array<struct<" + schemas.CATALOG.replace(", ", ",").replace(" ", ":") + ">>"
            document = spark.read.text(path, wholetext=True).select(
                F.from_json("value", element, {"mode": "FAILFAST"}).alias("entries"))
            catalog = document.select(F.posexplode("entries").alias("pos", "entry")).select(
                "entry.*", F.col("pos").cast("bigint").alias("pos"))
        catalog.agg(F.max("id")).collect()  # one row: raises now if the text is no catalog
        return catalog
    except Exception as error:  # the task failure reaches Python under several classes
        if "MALFORMED_RECORD" not in str(error):
            raise
        return default_catalog(spark)


def kafka_options(servers: str, topics: Sequence[str], starting: str = "earliest",
                  starting_timestamp_ms: int | None = None,
                  max_offsets: int | None = None) -> dict:
    """Options of a topic source: from the start, the end, or a point in time."""
    options: dict[str, str] = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics)}
    if starting_timestamp_ms is not None:
        options["startingTimestamp"] = str(starting_timestamp_ms)
    else:
        options["startingOffsets"] = starting
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def stream_topics(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Message texts of a topic source as column ``value``."""
    return (spark.readStream.format("kafka").options(**options).load()
            .select(F.col("value").cast("string").alias("value")))


def stream_text_files(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """Message texts from files landing in a folder, as column ``value``."""
    return (spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger)
            .load(path))
