"""Joins of a large table to a keyed table.

A keyed table is broadcast only when Catalyst's size estimate fits the session's broadcast
budget. Otherwise both sides are shuffled on the key, and keys too frequent for one task are
split over several: the frequent side's rows get a salt, and the matching rows of the other side
are repeated once per salt. Every row is joined either way.

Several tables that multiply per key are joined on a grid (``multiply``): a key's combinations are cut in
every table's direction at once, so a key that is frequent in all of them spreads as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.sources.storage import cut_lineage

# A key with more rows than this is split over several tasks.
ROWS_PER_TASK = 5_000_000
# The frequency sketch reports at most this many keys, which bounds the list the driver holds.
MAX_HOT_KEYS = 10_000
SKETCH_ITEMS = 100_000
# Combinations of one row of blocks in ``multiply_in_blocks``, as a share of what a task may have. Spark holds them as a list
# while they are unpacked; long lists cost more per row.
BLOCKS_PER_TASK = 1_024


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_budget(df: DataFrame) -> int:
    """The session's own limit for automatic broadcasts, in bytes (negative: never)."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    units = {"kb": 1 << 10, "mb": 1 << 20, "gb": 1 << 30, "k": 1 << 10, "m": 1 << 20,
             "g": 1 << 30, "b": 1}
    text = text.strip().lower()
    for suffix, size in units.items():
        if text.endswith(suffix):
            return int(text[: -len(suffix)]) * size
    return int(text)


def fits_broadcast(df: DataFrame) -> bool:
    return plan_bytes(df) <= broadcast_budget(df)


def settled(df: DataFrame) -> DataFrame:
    """A derived table that should be small, written out unless it is already known to be.

    Estimates of joined or aggregated plans are upper bounds; the written table has its real size,
    which then decides whether it may be broadcast.
    """
    return df if fits_broadcast(df) else cut_lineage(df)


def _key_hash(keys: Sequence[str]):
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(keys_frame: DataFrame, on: Sequence[str],
             rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """Hashes of the keys that need splitting, with their number of splits; None without any.

    One pass over the key columns with a mergeable frequency sketch: no shuffle of the keys. The
    sketch only chooses what to split; an approximate count changes the number of splits, never
    a result. The list is at most MAX_HOT_KEYS rows, and is fixed here once so that both
    sides of the join see the same splits.
    """
    sketch = keys_frame.select(_key_hash(on).alias("h")).agg(
        F.call_function("approx_top_k", F.col("h"), F.lit(MAX_HOT_KEYS),
                        F.lit(SKETCH_ITEMS)).alias("top"))
    rows = (sketch.select(F.inline("top"))
            .filter(F.col("count") > rows_per_task)
            .select(F.col("item"), F.ceil(F.col("count") / rows_per_task).cast("int"))
            .collect())
    if not rows:
        return None
    return keys_frame.sparkSession.createDataFrame(
        [tuple(r) for r in rows], "_hot bigint, _splits int")


def lookup_join(fact: DataFrame, keyed: DataFrame, on: str | Sequence[str], how: str = "left",
                spread: Sequence[str] = (), keys_from: DataFrame | None = None,
                rows_per_task: int | None = None, unique: bool = True) -> DataFrame:
    """Join ``fact`` to ``keyed`` on equal key columns (``how``: left or inner).

    ``spread`` names fact columns that differ between rows of one key (default: all); their hash
    is the salt. ``keys_from`` may give a cheaper frame with the same frequent keys for the
    sketch. With ``unique=False`` a key may have any number of rows in ``keyed`` too, and both sides are split.
    """
    on = [on] if isinstance(on, str) else list(on)
    limit = rows_per_task or ROWS_PER_TASK
    if fits_broadcast(keyed):
        return fact.join(F.broadcast(keyed), on, how)
    columns = [*fact.columns, *[c for c in keyed.columns if c not in on]]
    if not unique:
        return multiply(fact, [keyed], on, how, limit)
    hot = hot_keys((fact if keys_from is None else keys_from).select(*on), on, limit)
    if hot is None:
        return fact.join(keyed, on, how).select(*columns)
    return salted_join(fact, keyed, on, how, hot, spread or fact.columns).select(*columns)


def _salt(spread: Sequence[str]) -> Column:
    """A salt per row that a repeated task computes again.

    The partition number is part of it, so that exact copies of a row spread as well.
    """
    splits = F.coalesce(F.col("_splits"), F.lit(1))
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in spread]),
                  splits.cast("bigint"))


def _all_salts() -> Column:
    splits = F.coalesce(F.col("_splits"), F.lit(1)).cast("bigint")
    return F.explode(F.sequence(F.lit(0).cast("bigint"), splits - 1))


def salted_join(fact: DataFrame, keyed: DataFrame, on: Sequence[str], how: str,
                hot: DataFrame, spread: Sequence[str]) -> DataFrame:
    """Fact rows of hot keys are split; the matching rows of ``keyed`` go to every split."""
    # `hot` has at most MAX_HOT_KEYS rows, so broadcasting it is bounded.
    small = F.broadcast(hot)
    left = (fact.join(small, _key_hash(on) == F.col("_hot"), "left")
            .withColumn("_salt", _salt(spread)).drop("_hot", "_splits"))
    right = (keyed.join(small, _key_hash(on) == F.col("_hot"), "left")
             .withColumn("_salt", _all_salts()).drop("_hot", "_splits"))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def multiply(base: DataFrame, children: Sequence[DataFrame], on: str | Sequence[str], how: str = "left",
             rows_per_task: int | None = None) -> DataFrame:
    """Join every child to ``base`` on the same key columns; a key's rows multiply over all tables.

    Each table's rows per key are counted first (one aggregation, one row per key). Keys whose product is too
    large for a task are joined on a grid: a table's rows are dealt to places of its own direction and
    repeated along the others, so that a cell meets few rows of every table. The cells of all keys are dealt
    to tasks by their number, and the whole chain of these keys is one stage.
    """
    on = [on] if isinstance(on, str) else list(on)
    limit, tables, n = rows_per_task or ROWS_PER_TASK, [base, *children], len(children) + 1
    keys = reduce(DataFrame.unionByName, [t.select(*on, F.lit(i).alias("_t")) for i, t in enumerate(tables)])
    counted = keys.na.drop(subset=on).groupBy(*on).agg(
        *[F.count(F.when(F.col("_t") == i, 1)).alias(f"_n{i}") for i in range(n)])
    rows = reduce(lambda a, b: a * b, [F.greatest(F.col(f"_n{i}"), F.lit(1)).cast("double") for i in range(n)])
    sized = cut_lineage(counted.filter("_n0 > 0").withColumn("_rows", rows))
    total, most = sized.agg(F.sum("_rows"), F.max("_rows")).first()
    columns = [*base.columns, *[c for child in children for c in child.columns if c not in on]]
    if not most or most <= limit:
        return _plain_chain(base, children, on, how).select(*columns)
    tasks = max(partitions(base), int(-(-total // limit)))
    cell = max(min(limit, total // (4 * tasks)), limit // 16, 1)  # several cells to a task even out
    hot = _grid(sized.filter(F.col("_rows") > cell), on, n, cell)
    rest = [t.join(hot.select(*on), on, "left_anti") for t in tables]
    done = _on_grid(tables[0], hot, on, 0, n).repartition(tasks, *on, "_cell")
    for i, child in enumerate(children, 1):
        dealt = _on_grid(child, hot, on, i, n).drop(*[f"_has{j}" for j in range(n)]).withColumn("_met", F.lit(True))
        done = done.join(dealt.repartition(tasks, *on, "_cell"), [*on, "_cell"], "left" if how == "left" else "inner")
        # an empty cell of a child that has rows for the key elsewhere gives none
        done = done.filter(F.col("_met").isNotNull() | ~F.col(f"_has{i}")).drop("_met")
    return done.select(*columns).unionByName(_plain_chain(rest[0], rest[1:], on, how).select(*columns))


def block_size(limit: int, children: int) -> int:
    """Rows to a block, so that the blocks of one joined row stand for a small part of a task's combinations."""
    size = 1
    while size < 256 and (size + 1) ** children <= limit // BLOCKS_PER_TASK:
        size += 1
    return size


def multiply_in_blocks(base: DataFrame, children: Sequence[DataFrame], on: str | Sequence[str], how: str = "left",
                       rows_per_task: int | None = None) -> DataFrame:
    """Like ``multiply``, for children that all have many rows per key.

    A child's rows are packed into short arrays per key, a key with many rows into several; only these blocks are joined,
    and the combinations are made by unpacking them one child after the other, which costs far less per row than a join.
    """
    on, limit = [on] if isinstance(on, str) else list(on), rows_per_task or ROWS_PER_TASK
    size = block_size(limit, len(children))
    if size == 1:
        return multiply(base, children, on, how, limit)
    blocks = [_in_blocks(child.na.drop(subset=on), on, f"_block{i}", size) for i, child in enumerate(children)]
    joined = cut_lineage(multiply(base, blocks, on, how, limit // size ** len(children)))
    # few bytes make many rows, so tasks are sized by the rows that blocks really hold: most are far from full
    made = reduce(lambda a, b: a * b, [F.greatest(F.size(f"_block{i}"), F.lit(1)).cast("double") for i in range(len(children))])
    joined = joined.repartition(max(partitions(base), int(-(-(joined.agg(F.sum(made)).first()[0] or 0) // limit))))
    for i in range(len(children)):
        block = f"_block{i}"
        joined = joined.select(*[c for c in joined.columns if c != block],
                               F.inline_outer(block) if how == "left" else F.inline(block))
    return joined.select(*base.columns, *[c for child in children for c in child.columns if c not in on])


def _in_blocks(table: DataFrame, on: Sequence[str], name: str, size: int) -> DataFrame:
    """One row per key and block: about ``size`` rows of the key as an array."""
    several = table.groupBy(*on).agg(F.count("*").alias("_n")).filter(F.col("_n") > size).select(
        *on, F.ceil(F.col("_n") / size).cast("bigint").alias("_blocks"))
    dealt = lookup_join(table, several, on, "left")
    place = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in table.columns]),
                   F.coalesce("_blocks", F.lit(1).cast("bigint")))
    rows = F.struct(*[c for c in table.columns if c not in on])
    return dealt.withColumn("_place", place).groupBy(*on, "_place").agg(F.collect_list(rows).alias(name)).drop("_place")


def _plain_chain(base: DataFrame, children: Sequence[DataFrame], on: Sequence[str], how: str) -> DataFrame:
    return reduce(lambda a, b: a.join(F.broadcast(b) if fits_broadcast(b) else b, on, how), children, base)


def _grid(sized: DataFrame, on: Sequence[str], n: int, cell: float) -> DataFrame:
    """Per key the places in each table's direction (``_d0``, ...), and which tables have the key."""
    wide = reduce(lambda a, b: a + b, [(F.col(f"_n{i}") > 1).cast("int") for i in range(n)])
    side = F.greatest(F.pow(F.lit(float(cell)), F.lit(1.0) / F.greatest(wide, F.lit(1))), F.lit(1.0))
    return sized.select(*on, *[F.greatest(F.ceil(F.col(f"_n{i}") / side), F.lit(1)).cast("bigint").alias(f"_d{i}")
                              for i in range(n)], *[(F.col(f"_n{i}") > 0).alias(f"_has{i}") for i in range(n)])


def _on_grid(table: DataFrame, hot: DataFrame, on: Sequence[str], i: int, n: int) -> DataFrame:
    """The rows of hot keys, each in every cell of its place in the direction ``i``."""
    def places(which: Sequence[int]) -> Column:
        return reduce(lambda a, b: a * b, [F.col(f"_d{j}") for j in which], F.lit(1).cast("bigint"))

    stride, own = places(range(i)), F.col(f"_d{i}")
    place = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in table.columns]), own)
    # the place is fixed before rows are repeated; a repeated row differs by its cell only
    dealt = table.join(hot, on).withColumn("_place", place).withColumn(
        "_x", F.explode(F.sequence(F.lit(0).cast("bigint"), places([j for j in range(n) if j != i]) - 1)))
    cell = F.floor(F.col("_x") / stride).cast("bigint") * stride * own + F.col("_place") * stride + F.pmod(F.col("_x"), stride)
    return dealt.withColumn("_cell", cell).drop("_place", "_x", *[f"_d{j}" for j in range(n)])
