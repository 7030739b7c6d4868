"""New columns computed in tasks from one column, in Arrow batches of bounded size.

All other columns pass through as they are, whatever their type, nulls and names.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

SLICE_BYTES = 4_000_000
_ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let tasks import this package where it lies on the same path for them, whatever folder the driver runs in."""
    environment = spark.sparkContext.environment
    have = environment.get("PYTHONPATH", "")
    if _ROOT not in have.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (have, _ROOT) if p)


def unused(name: str, *frames: DataFrame) -> str:
    """A column name like ``name`` that no frame has."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def add_columns(frame: DataFrame, column: str, new: dict[str, T.DataType],
                run: Callable[[pa.Array], list[pa.Array]], size: int = SLICE_BYTES) -> DataFrame:
    """The frame with the columns that ``run`` returns for slices of a column; names are replaced."""
    kept = frame.drop(*new)
    schema = T.StructType([*kept.schema.fields, *(T.StructField(n, k) for n, k in new.items())])
    place = kept.columns.index(column)

    def each(batches):
        for batch in batches:
            step = max(1, int(batch.num_rows * size / max(batch.column(place).nbytes, 1)))
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                yield pa.RecordBatch.from_arrays([*part.columns, *run(part.column(place))],
                                                 names=[*part.schema.names, *new])

    return kept.mapInArrow(each, schema)


def replace_column(frame: DataFrame, column: str, run: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """The frame with a text column replaced, all columns in their order."""
    name = unused("__new", frame)
    done = add_columns(frame, column, {name: T.StringType()}, lambda x: [run(x)])
    return done.select(*(done[name].alias(c) if c == column else done[c] for c in frame.columns))


def nulls(like: pa.Array) -> pa.Array | None:
    return pa.array(like.is_null().to_numpy(zero_copy_only=False)) if like.null_count else None
