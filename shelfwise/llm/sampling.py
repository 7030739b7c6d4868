"""Bounded samples of labelled texts to fit a model on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

_SCALE = 1_000_000


def rows_per_label(labelled: DataFrame, rows: int, label: str = "label", text: str = "text") -> DataFrame:
    """At most ``rows`` rows per label in the order of a hash of their text, with their place ``n``.

    Rows are thinned by that hash first, by the number of rows that a label has, so only some multiple of
    ``rows`` per label is shuffled; a common label may therefore get somewhat fewer rows than ``rows``. Equal rows count
    once, so copies do not fill the sample.
    """
    counts = labelled.groupBy(label).count().collect()  # one row per label
    share = F.lit(_SCALE)
    for value, count in counts:
        share = F.when(F.col(label) == value, min(_SCALE, -(-4 * rows * _SCALE // count))).otherwise(share)
    thin = labelled.where(F.pmod(F.xxhash64(F.lit(3), text), F.lit(_SCALE)) < share).distinct()
    order = Window.partitionBy(label).orderBy(F.xxhash64(text), text)
    return thin.withColumn("n", F.row_number().over(order)).where(F.col("n") <= rows)


def per_label(labelled: DataFrame, rows: int, label: str = "label", text: str = "text") -> pd.DataFrame:
    """The same rows on the driver, in order."""
    return rows_per_label(labelled, rows, label, text).toPandas().sort_values([label, "n"])
