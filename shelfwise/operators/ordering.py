"""Running totals over a total order, without gathering the order or a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.sources.storage import cut_lineage


def running_totals(df: DataFrame, order_by: Sequence[str], totals: Mapping[str, Column],
                   by: Sequence[str] = ()) -> DataFrame:
    """Add inclusive running sums named as in ``totals``, per ``by`` group in ``order_by`` order.

    ``by`` + ``order_by`` must identify a row. The rows are range-sorted, so a group of any size
    spreads over as many slices as it needs; sums run inside a slice, and each slice adds what
    the same group reached in the slices before it. Only a slice's first group can continue
    from an earlier one, so the carried sums are at most one row per slice.
    """
    by, order_by, names = list(by), list(order_by), list(totals)
    # The slice of a row must not change between the two uses below: fix it in storage.
    sliced = cut_lineage(
        df.withColumns(dict(totals)).sort(*by, *order_by)
        .withColumn("_slice", F.spark_partition_id()))

    inside = (Window.partitionBy("_slice", *by).orderBy(*order_by)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))
    before = before.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy("_slice", *by).agg(*[F.sum(n).alias(n) for n in names])
        .select("_slice", *by, *[F.sum(n).over(before).alias(f"_before_{n}") for n in names])
        .filter(F.col(f"_before_{names[0]}").isNotNull()))
    # Null-safe, because a NULL group is a group. At most one row per slice, see above.
    keys = [F.col("r._slice") == F.col("c._slice")]
    keys += [F.col(f"r.{b}").eqNullSafe(F.col(f"c.{b}")) for b in by]
    joined = sliced.withColumns({n: F.sum(n).over(inside) for n in names}).alias("r").join(
        F.broadcast(carried).alias("c"), keys, "left")
    keep = [c for c in df.columns if c not in names]
    return joined.select(
        *[F.col(f"r.`{c}`") for c in keep],
        *[(F.col(f"r.{n}") + F.coalesce(F.col(f"c._before_{n}"), F.lit(0))).alias(n)
          for n in names])
