import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfwise.operators import joins as J
from shelfwise.operators.ordering import running_totals


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def fact(spark):
    """A third of the rows have one key, another third a NULL key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") % 50)
    return spark.range(6000).select("id", key.cast("bigint").alias("key"))


def keyed(spark):
    return spark.range(40).select(F.col("id").alias("key"), (F.col("id") * 10).alias("label"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, no_broadcast, how):
    left, right = fact(spark), keyed(spark)
    hot = J.hot_keys(left.select("key"), ["key"], 100)
    splits = {r["_splits"] for r in hot.collect()}
    assert hot.count() >= 2 and max(splits) >= 10
    got = J.lookup_join(left, right, "key", how, spread=["id"], rows_per_task=100)
    assert "_salt" not in got.columns
    assert rows(got, "id", "key", "label") == rows(left.join(right, "key", how),
                                                   "id", "key", "label")


def test_hot_key_spreads_over_salts(spark, no_broadcast):
    left = fact(spark)
    hot = J.hot_keys(left.select("key"), ["key"], 100)
    salted = (left.join(hot, J._key_hash(["key"]) == F.col("_hot"))
              .filter("key = 7").select(F.pmod(F.xxhash64("id"), F.col("_splits")).alias("s"))
              .groupBy("s").count())
    assert salted.agg(F.max("count")).first()[0] < 2000 / 10


def test_several_matches_per_key_multiply(spark, no_broadcast):
    left = fact(spark)
    right = keyed(spark).unionByName(keyed(spark).withColumn("label", F.col("label") + 1))
    got = J.lookup_join(left, right, "key", "left", spread=["id"], rows_per_task=100)
    assert rows(got, "id", "label") == rows(left.join(right, "key", "left"), "id", "label")


def test_without_hot_keys_no_salt(spark, no_broadcast):
    assert J.hot_keys(keyed(spark).select("key"), ["key"], 100) is None


def test_broadcast_only_within_budget(spark, no_broadcast):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan(J.lookup_join(fact(spark), keyed(spark), "key"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert "BroadcastHashJoin" in plan(J.lookup_join(fact(spark), keyed(spark), "key"))
    assert J.broadcast_budget(fact(spark)) == 10 << 20


@pytest.mark.parametrize("by", [[], ["user"]])
def test_running_totals_match_a_single_pass(spark, by):
    data = [(i, None if i % 11 == 0 else (1 if i % 3 else i % 5), (i * 37) % 101, i % 4)
            for i in range(2000)]
    df = spark.createDataFrame(data, "id bigint, user bigint, at bigint, n bigint")
    got = running_totals(df, ["at", "id"], {"total": F.col("n"), "seen": F.lit(1)}, by=by)
    expected, state = {}, {}
    for i, user, at, n in sorted(data, key=lambda r: (r[2], r[0])):
        total, seen = state.get(user if by else 0, (0, 0))
        state[user if by else 0] = (total + n, seen + 1)
        expected[i] = (total + n, seen + 1)
    assert {r["id"]: (r["total"], r["seen"]) for r in got.collect()} == expected


def test_running_totals_split_a_large_group(spark):
    from shelfwise.sources import storage
    df = spark.range(4000).select("id", F.lit(1).alias("user"))
    got = running_totals(df, ["id"], {"seen": F.lit(1)}, by=["user"])
    assert got.filter("seen != id + 1").count() == 0
    assert storage.shared_folder(spark)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_keys_frequent_on_the_keyed_side(spark, no_broadcast, how):
    """One key holds most of the keyed rows, some of them exact copies, some without key."""
    left = spark.range(60).select("id", F.when(F.col("id") > 5, F.col("id") % 30).alias("key"))
    right = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") % 50)
        .cast("bigint").alias("key"), (F.col("id") % 100).alias("label"))
    got = J.lookup_join(left, right, "key", how, rows_per_task=100, unique=False)
    assert "Union" in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.columns == ["id", "key", "label"]
    assert rows(got) == rows(left.join(right, "key", how).select("id", "key", "label"))


def test_copies_of_a_row_spread(spark):
    hot = spark.createDataFrame([(1, 8)], "key int, _splits int")
    copies = spark.range(8000, numPartitions=16).select(F.lit(1).alias("key"))
    salts = copies.join(F.broadcast(hot), "key").select(J._salt(["key"]).alias("s"))
    assert salts.distinct().count() >= 4


def many(spark, n, keys, name):
    """Key 7 in half of the rows, key 3 in a quarter, and some keys that other tables lack."""
    i = F.col("id")
    key = F.when(i % 2 == 0, 7).when(i % 4 == 1, 3).when(i % 97 == 3, F.lit(None)).otherwise(i % keys)
    return spark.range(n).select(key.cast("bigint").alias("key"), i.alias(name))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [40, 300, 10**9])
def test_tables_that_multiply_equal_the_plain_chain(spark, how, limit):
    base = many(spark, 40, 31, "a")
    children = [many(spark, 60, 11, "b"), many(spark, 24, 50, "c").filter("key != 3"), many(spark, 3, 2, "d").limit(0)]
    children = children if how == "left" else children[:2]
    want = base
    for child in children:
        want = want.join(child, "key", how)
    got = J.multiply(base, children, "key", how, limit)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_a_key_hot_in_every_table_spreads(spark):
    """One key has nearly all combinations; no task gets more than three times the median."""
    tables = [spark.range(200).select(F.lit(1).cast("bigint").alias("key"), F.col("id").alias(n)) for n in "abc"]
    tables[0] = tables[0].filter("a < 4")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        out = J.multiply(tables[0], tables[1:], "key", "left", 20_000)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sum(sizes) == 160_000 and len(sizes) >= 6
    assert max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_keys_hot_on_both_sides_of_a_lookup(spark, no_broadcast, how):
    """Two key columns; a third of the rows of each side have one key, some keys are NULL."""
    def side(n, name):
        i = F.col("id")
        return spark.range(n).select(F.when(i % 3 == 0, 7).when(i % 11 != 1, i % 20).cast("int").alias("k1"),
                                     F.when(i % 3 == 0, "x").otherwise("y").alias("k2"), i.alias(name))

    left, right = side(300, "a"), side(200, "b")
    got = J.lookup_join(left, right, ["k1", "k2"], how, rows_per_task=500, unique=False)
    want = left.join(right, ["k1", "k2"], how)
    assert got.columns == want.columns and rows(got) == rows(want)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_blocks_multiply_like_rows(spark, no_broadcast, how):
    """Keys of 0 to 40 rows in blocks of at most four: every combination once, unpacked and not joined."""
    base = spark.createDataFrame([(k, f"u{k}") for k in (1, 2, 3, 4)] + [(1, "twin"), (None, "none")], "key bigint, name string")
    one = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 1), (2, 1), (None, 5), (9, 9)], "key bigint, a bigint")
    two = spark.createDataFrame([(1, f"b{i}") for i in range(9)] + [(2, None), (3, "x"), (None, "y")], "key bigint, b string")
    plain = base.join(one, "key", how).join(two, "key", how)
    limit = J.BLOCKS_PER_TASK * 16
    assert J.block_size(limit, 2) == 4 and J.block_size(100, 2) == 1 and J.block_size(J.ROWS_PER_TASK, 4) ** 4 <= J.ROWS_PER_TASK // 64
    got = J.multiply_in_blocks(base, [one, two], "key", how, limit)
    assert got.columns == plain.columns and rows(got) == rows(plain)
    assert rows(J.multiply_in_blocks(base, [one, two], "key", how, 100)) == rows(plain)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and "Join" not in plan


def test_tasks_of_blocks_are_sized_by_their_rows(spark, no_broadcast, monkeypatch):
    """Blocks that are far from full count by their rows: 3,000 combinations at 16 a task, whatever the blocks could hold."""
    monkeypatch.setattr(J, "BLOCKS_PER_TASK", 1)
    base = spark.range(3000).select(F.col("id").alias("key"))
    one, two = (base.select("key", F.lit(1).alias(n)) for n in "ab")
    assert J.block_size(16, 2) == 4
    got = J.multiply_in_blocks(base, [one, two], "key", "left", 16)
    assert "Repartition 188, true" in got._jdf.queryExecution().optimizedPlan().toString() and got.count() == 3000
