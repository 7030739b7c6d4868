"""Round trips through files: what is written is read back whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.operators import feed as O, recommend as R, validate as V
from shelfwise.plans.adapters import Tables
from shelfwise.plans.feeds import CSV_ERRORS_SQL, RULES, _ISSUES, _TASKS
from shelfwise.plans.oracle_tables import with_tables
from shelfwise.plans.profiling import NULLS_SQL
from shelfwise.plans.registry import ORACLE, query
from shelfwise.plans.validation import PRODUCT_REJECTS_SQL
from shelfwise.sources import readers, sinks
from shelfwise.sources.storage import new_path


@query("io_json_roundtrip", with_tables("wishlist", "SELECT * FROM d_wishlist"))
def io_json_roundtrip(t: Tables) -> DataFrame:
    wishes, path = t.wishlist(), new_path(t.spark, "json")
    sinks.write_json(wishes, path)
    return t.spark.read.schema(wishes.schema).json(path)


@query("io_json_arrays", with_tables("wishlist", "SELECT * FROM d_wishlist"))
def io_json_arrays(t: Tables) -> DataFrame:
    """Rows in files that each hold one JSON array of at most a thousand entries."""
    wishes, path = t.wishlist(), new_path(t.spark, "arrays")
    entry = F.struct(*wishes.columns)
    part = wishes.groupBy(F.floor(F.col("id") / 1000).alias("part")).agg(
        F.to_json(F.collect_list(entry), sinks.JSON_OPTIONS).alias("value"))
    part.write.partitionBy("part").text(path)
    return readers.read_json_array(t.spark, path, wishes.schema).select(*wishes.columns)


@query("io_csv_roundtrip", """SELECT 'S-' || p_partkey AS product_id, p_name AS description,
    CASE WHEN p_partkey % 31 <> 0 THEN '["' || p_partkey || '.png"]' END AS images
    FROM part""")
def io_csv_roundtrip(t: Tables) -> DataFrame:
    """A raw feed through CSV; JSON texts keep their quotes."""
    path = new_path(t.spark, "feed") + ".csv"
    sinks.save_feed(t.feed(), path, "csv")
    return readers.read_feed(t.spark, path).select("product_id", "description", "images")


@query("io_feed_csv", CSV_ERRORS_SQL)
def io_feed_csv(t: Tables) -> DataFrame:
    """A feed read from CSV files and validated; an empty cell is a missing value there."""
    path = new_path(t.spark, "feed") + ".csv"
    sinks.save_feed(t.feed(), path, "csv")
    return O.error_table(O.validate_feed(readers.read_feed(t.spark, path), RULES))


@query("io_feed_json", ORACLE["feed_errors"])
def io_feed_json(t: Tables) -> DataFrame:
    """The same feed out of JSON files, each an array of at most a thousand products."""
    path = new_path(t.spark, "feed") + ".json"
    feed = t.feed()
    part = feed.groupBy(F.pmod(F.xxhash64("product_id"), F.lit(8)).alias("part"), F.floor(
        F.substring("product_id", 3, 20).cast("bigint") / 1000).alias("block")).agg(
        F.to_json(F.collect_list(F.struct(*feed.columns)), sinks.JSON_OPTIONS).alias("value"))
    part.write.partitionBy("part", "block").text(path)
    return O.error_table(O.validate_feed(readers.read_feed(t.spark, path).select(*feed.columns), RULES))


@query("io_reject_sink", PRODUCT_REJECTS_SQL)
def io_reject_sink(t: Tables) -> DataFrame:
    path = new_path(t.spark, "rejects")
    failing = V.rejects(t.product_records(), V.products_suite())
    columns = ["id", "sku", *V.flag_names(t.product_records(), V.products_suite())]
    sinks.write_rejects(failing.select(*columns), path)
    return t.spark.read.schema(failing.select(*columns).schema).json(path)


@query("io_split_sinks", f"""SELECT *, "Issues" = '' AS valid
    FROM (SELECT *, {_ISSUES} AS "Issues" FROM ({_TASKS}))""")
def io_split_sinks(t: Tables) -> DataFrame:
    """Valid and invalid rows in two places, as stored."""
    path = new_path(t.spark, "tasks")
    sinks.write_split(O.with_task_issues(t.tasks()), "Issues", path)
    stored = t.spark.read.parquet(path)
    return stored.withColumn("valid", F.col("is_valid").cast("boolean")).drop("is_valid")


@query("io_report_sink", NULLS_SQL)
def io_report_sink(t: Tables) -> DataFrame:
    from shelfwise.operators.profile import null_counts
    report, path = null_counts(t.cart_item()), new_path(t.spark, "report")
    sinks.write_report(report, path)
    return t.spark.read.schema(report.schema).json(path)


@query("io_catalog_fallback", with_tables("views", """
    SELECT event_id, CAST(r AS INTEGER) AS rank, CAST(id AS BIGINT) AS id FROM (
      SELECT event_id, id, row_number() OVER (PARTITION BY event_id ORDER BY id) AS r
      FROM d_views CROSS JOIN (VALUES (1), (2), (3), (4), (5)) AS v(id) WHERE id <> product_id)
    WHERE r <= 3"""))
def io_catalog_fallback(t: Tables) -> DataFrame:
    """Without a readable catalog file, views get the default catalog."""
    catalog = readers.read_catalog(t.spark, new_path(t.spark, "no-such-catalog") + ".json")
    recs = R.category_recommend(t.views(), catalog, 3, F.col("pos"))
    return R.exploded(recs).select("event_id", "rank", "id")


@query("io_catalog_written", with_tables("products", """
    SELECT id, name, category, price, name AS description, id AS pos FROM d_products"""))
def io_catalog_written(t: Tables) -> DataFrame:
    """The whole catalog through files of records, with the order of its entries."""
    path = new_path(t.spark, "catalog")
    sinks.write_catalog(t.catalog(), path)
    return readers.read_catalog(t.spark, path)
