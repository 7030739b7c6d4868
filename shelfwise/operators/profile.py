"""Table profiles, schema exploration and rule inference, in long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from shelfwise import constants as K
from shelfwise.operators.joins import plan_bytes
from shelfwise.sources.storage import cut_lineage

TRACKED = 9_000  # items of a frequency sketch
SKETCH_ABOVE = 1 << 30


def sanitised(value: Column, dtype: T.DataType) -> Column:
    """A value as reports carry it, at any depth: NaN becomes NULL, dates and times ISO texts, bytes and intervals texts."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: sanitised(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        keys = F.transform(F.map_keys(value), lambda k: as_text(k, dtype.keyType))
        return F.map_from_arrays(keys, F.transform(F.map_values(value), lambda x: sanitised(x, dtype.valueType)))
    if isinstance(dtype, T.StructType):
        # a NULL struct stays NULL, not a struct of NULLs
        return F.when(value.isNotNull(), F.struct(*[sanitised(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]))
    if isinstance(dtype, (T.NumericType, T.BooleanType, T.StringType)):
        return value
    return value.cast("string")


def as_text(value: Column, dtype: T.DataType) -> Column:
    """A sanitised value as text; nested values are JSON that keeps its NULLs."""
    clean = sanitised(value, dtype)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(clean, {"ignoreNullFields": "false"})
    return clean.cast("string")


def sanitised_rows(df: DataFrame) -> DataFrame:
    """All columns sanitised, with their names and nesting."""
    return df.select(*[sanitised(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def column_types(df: DataFrame) -> DataFrame:
    """(column_name, data_type), from the schema alone."""
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields],
        "column_name string, data_type string")


def _unpivot(wide: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    """One-row frame with a column per name -> (column_name, value)."""
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias(value))
        for n in names])).alias("r")).select("r.*")


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, row_count, null_count) of every column in one scan."""
    wide = df.agg(*[F.struct(F.count("*").alias("row_count"),
                             F.count_if(F.col(f"`{c}`").isNull()).alias("null_count")).alias(c)
                    for c in df.columns])
    return _unpivot(wide, df.columns, "m").select("column_name", "m.*")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def column_stats(df: DataFrame) -> DataFrame:
    """count, mean, sample deviation, min and max of every numeric column in one scan."""
    names = numeric_columns(df)
    wide = df.agg(*[F.struct(
        F.count(f"`{c}`").alias("count"), F.avg(f"`{c}`").alias("mean"),
        F.stddev_samp(f"`{c}`").alias("stddev"),
        F.min(f"`{c}`").cast("double").alias("min"),
        F.max(f"`{c}`").cast("double").alias("max")).alias(c) for c in names])
    return _unpivot(wide, names, "m").select("column_name", "m.*")


def _fields(df: DataFrame, columns: Sequence[str] | None) -> list[T.StructField]:
    return [f for f in df.schema.fields if columns is None or f.name in set(columns)]


def _counted(df: DataFrame, f: T.StructField, wanted: Sequence[int] | None = None) -> DataFrame:
    """(column_name, value, frequency) of one column, counted in its own type; only then values become text.

    ``wanted`` limits it to the values with these hashes.
    """
    value = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)  # NaN counts as NULL
    elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        value = as_text(value, f.dataType)
    cells = df.select(value.alias("value"))
    if wanted is not None:
        cells = cells.filter(F.xxhash64("value").isin(list(wanted)))
    counted = cells.groupBy("value").agg(F.count("*").alias("frequency"))
    text = F.col("value") if isinstance(counted.schema["value"].dataType, T.StringType) else as_text(F.col("value"), f.dataType)
    # not a plain literal: a window over a constant would lose its groups, and with them the trimming before the shuffle
    name = F.when(F.col("frequency") > 0, F.lit(f.name))
    return counted.select(name.alias("column_name"), text.alias("value"), "frequency")


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, value, frequency) of the distinct values; NULL is a value.

    Every column is read and counted by itself, in its own type, and copies of a value combine before the
    shuffle. A frame that is costly to compute should be stored first.
    """
    return reduce(DataFrame.unionByName, [_counted(df, f) for f in _fields(df, columns)])


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column_name, distinct_count), NULL excluded."""
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(f"`{c}`").alias(c) for c in df.columns])
        return _unpivot(wide, df.columns, "distinct_count")
    return value_counts(df).groupBy("column_name").agg(F.count("value").alias("distinct_count"))


def _top(counted: DataFrame, top_n: int) -> DataFrame:
    # A rank filter lets Spark keep only the first rows per column before the shuffle, so a
    # column's values never meet in one task.
    order = Window.partitionBy("column_name").orderBy(
        F.col("frequency").desc(), F.col("value").asc_nulls_first())
    return (counted.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= top_n))


def top_values(df: DataFrame, top_n: int = 5, columns: Sequence[str] | None = None,
               sketch_above: int = SKETCH_ABOVE) -> DataFrame:
    """(column_name, value, frequency, rank): the most frequent values, ties by value.

    Columns named in ``columns`` that the table lacks are skipped. Tables estimated above ``sketch_above`` bytes are
    read twice: a sketch per column, in one scan without a shuffle of values, names candidates, and these
    alone are counted. Where their counts do not prove that nothing else can be among the first, as in a
    column of unique values, the whole column is counted.
    """
    fields = _fields(df, columns)
    if not fields:
        return _top(value_counts(df), top_n).limit(0)
    if plan_bytes(df.select(*[f"`{f.name}`" for f in fields])) <= sketch_above:
        return _top(value_counts(df, columns), top_n)
    return _top(reduce(DataFrame.unionByName, _frequent(df, fields, top_n)), top_n)


def _frequent(df: DataFrame, fields: Sequence[T.StructField], top_n: int) -> list[DataFrame]:
    """For each column the counts of its candidates, or of all its values.

    A sketch of TRACKED items is off by 3.5 / TRACKED of the rows at most. A value that occurs more than
    twice as often is among the candidates, of which TRACKED / 3 are named.
    """
    def hashed(f: T.StructField) -> Column:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = as_text(value, f.dataType)
        return F.xxhash64(value)

    sketches = df.agg(F.count("*").alias("n"), *[F.call_function(
        "approx_top_k", hashed(f), F.lit(TRACKED // 3), F.lit(TRACKED)).alias(f"c{i}") for i, f in enumerate(fields)]).first()
    rows, out = sketches["n"], []
    for i, f in enumerate(fields):
        candidates = cut_lineage(_counted(df, f, [item["item"] for item in sketches[f"c{i}"]]))  # at most TRACKED / 3 values
        best = [r[0] for r in candidates.select("frequency").orderBy(F.col("frequency").desc()).limit(top_n).collect()]
        whole = candidates.agg(F.sum("frequency")).first()[0] == rows
        proven = len(best) == top_n and best[-1] > 2 * rows * 3.5 / TRACKED
        out.append(candidates if whole or proven else _counted(df, f))
    return out


def value_sample(df: DataFrame, columns: Sequence[str], size: int = 10) -> DataFrame:
    """(column_name, value, rank): the first distinct non-NULL values in text order."""
    order = Window.partitionBy("column_name").orderBy("value")
    return (value_counts(df, columns).filter(F.col("value").isNotNull())
            .select("column_name", "value", F.row_number().over(order).alias("rank"))
            .filter(F.col("rank") <= size))


def profile_table(df: DataFrame, table: str, top_n: int = 5) -> DataFrame:
    """The whole profile as (table_name, column_name, metric, value), values as text.

    Two scans: one for all plain aggregates, one for the value counts behind distincts and
    frequencies.
    """
    numeric = set(numeric_columns(df))

    def metric(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), value.cast("string").alias("value"))

    def plain(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        out = [metric("data_type", F.lit(f.dataType.simpleString())),
               metric("null_count", F.count_if(c.isNull()))]
        if f.name in numeric:
            out += [metric("count", F.count(c)), metric("mean", F.round(F.avg(c), 4)),
                    metric("stddev", F.round(F.stddev_samp(c), 4)),
                    metric("min", F.min(c).cast("double")),
                    metric("max", F.max(c).cast("double"))]
        return F.array(*out).alias(f.name)

    wide = df.agg(*[plain(f) for f in df.schema.fields])
    plain_rows = _unpivot(wide, df.columns, "m").select("column_name", F.inline("m"))

    counted = value_counts(df)
    distinct = counted.groupBy("column_name").agg(F.count("value").alias("n")).select(
        "column_name", F.lit("distinct_count").alias("metric"), F.col("n").cast("string").alias("value"))
    top = _top(counted, top_n).select(
        "column_name", F.concat(F.lit("top_"), F.col("rank").cast("string")).alias("metric"),
        F.concat(F.coalesce("value", F.lit("null")), F.lit(" ("),
                 F.col("frequency").cast("string"), F.lit(")")).alias("value"))
    return (plain_rows.unionByName(distinct).unionByName(top)
            .select(F.lit(table).alias("table_name"), "column_name", "metric", "value"))


# ---- schema exploration over many tables ----

def explore_schema(spark: SparkSession, tables: Mapping[str, DataFrame],
                   counts: bool = False) -> DataFrame:
    """(table_name, column_name, data_type, is_timestamp, proposed_name) from schemas alone.

    With ``counts`` each table is scanned once for its row_count and each column's null_count.
    """
    rows = []
    for table, df in tables.items():
        for f in df.schema.fields:
            kind = f.dataType.simpleString()
            renamed = (f"{table}_id" if f.name == "id" and f"{table}_id" not in df.columns
                       else None)
            rows.append((table, f.name, kind, "timestamp" in kind, renamed))
    explored = spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, is_timestamp boolean, "
              "proposed_name string")
    if not counts:
        return explored
    filling = reduce(DataFrame.unionByName, [
        null_counts(df).withColumn("table_name", F.lit(n)) for n, df in tables.items()])
    return explored.join(filling, ["table_name", "column_name"])


def lowercase_names(names: DataFrame, column: str = "table_name") -> DataFrame:
    """Names without upper-case letters and with at least one letter."""
    c = F.col(column)
    return names.filter((c == F.lower(c)) & (c != F.upper(c)))


def infer_rules(df: DataFrame, table: str, declared_types: Mapping[str, str] | None = None,
                top_n: int = 5) -> DataFrame:
    """Cleaning rules suggested by the data: (table_name, column_name, rule, value).

    ``id`` becomes ``{table}_id``; a column more than half NULL gets a replacement; a column whose
    most frequent values are all boolean words becomes boolean unless its type is declared.
    """
    spark = df.sparkSession
    declared = {f.name: f.dataType.simpleString() for f in df.schema.fields
                if "timestamp" in f.dataType.simpleString()}
    declared.update(declared_types or {})
    fixed = [(table, "id", "rename_columns", f"{table}_id")] if "id" in df.columns else []
    fixed += [(table, c, "type_conversions", t) for c, t in declared.items()]
    schema = "table_name string, column_name string, rule string, value string"
    parts = [spark.createDataFrame(fixed, schema)]
    parts.append(
        null_counts(df).filter(F.col("null_count") * 2 > F.col("row_count"))
        .select(F.lit(table).alias("table_name"), "column_name",
                F.lit("null_replacements").alias("rule"),
                F.lit(K.NULL_REPLACEMENT).alias("value")))
    open_columns = [c for c in df.columns if c not in declared]
    word = F.coalesce(F.lower(F.trim("value")), F.lit("none")).isin(*K.BOOLEAN_WORDS)
    parts.append(
        top_values(df, top_n, open_columns).groupBy("column_name")
        .agg(F.bool_and(word).alias("all_words")).filter("all_words")
        .select(F.lit(table).alias("table_name"), "column_name",
                F.lit("type_conversions").alias("rule"), F.lit("boolean").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def infer_all_rules(tables: Mapping[str, DataFrame], top_n: int = 5) -> DataFrame:
    return reduce(DataFrame.unionByName,
                  [infer_rules(df, name, top_n=top_n) for name, df in tables.items()])
