"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.operators import clean as L, rules as R
from shelfwise.plans import adapters as A
from shelfwise.plans.adapters import Tables
from shelfwise.plans.oracle_tables import with_tables
from shelfwise.plans.registry import query


@query("clean_cart_incremental", with_tables("cart_item", """
    SELECT * FROM d_cart_item WHERE quantity >= 0 AND price >= 0 AND cart_id IS NOT NULL"""))
def clean_cart_incremental(t: Tables) -> DataFrame:
    """Two runs: the first half of the month, then everything that changed since."""
    from shelfwise.sources.bookmark import clean_new_cart_rows
    from shelfwise.sources.storage import new_path
    base = new_path(t.spark, "cart")
    cart = t.cart_item()
    early = cart.filter(F.col("updated_at") < F.lit("2024-01-15").cast("timestamp_ntz"))
    clean_new_cart_rows(early, f"{base}/bookmark", f"{base}/rows", "1")
    clean_new_cart_rows(cart, f"{base}/bookmark", f"{base}/rows", "2")
    return t.spark.read.parquet(f"{base}/rows").select(*cart.columns)


@query("clean_cart_stream", with_tables("cart_item", """
    SELECT * FROM d_cart_item WHERE quantity >= 0 AND price >= 0 AND cart_id IS NOT NULL
      AND updated_at > TIMESTAMP '2024-01-03 00:00:00'"""))
def clean_cart_stream(t: Tables) -> DataFrame:
    """The same job as a stream of landed files: two increments with a restart between them."""
    from shelfwise.sources.bookmark import start_cart_cleaning
    from shelfwise.sources.storage import new_path
    base = new_path(t.spark, "cart-stream")
    cart, middle = t.cart_item(), F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (cart.filter(F.col("updated_at") < middle), cart.filter(F.col("updated_at") >= middle)):
        part.write.mode("append").parquet(f"{base}/landed")
        start_cart_cleaning(t.spark, f"{base}/landed", cart.schema, f"{base}/rows", f"{base}/checkpoint",
                            since="2024-01-03T00:00:00").awaitTermination()
    return t.spark.read.parquet(f"{base}/rows").select(*cart.columns)


RULES = R.CleaningRules(
    rename_columns={"id": "products_id", "absent": "ignored"},
    type_conversions={"created_at": "TimestampType", "average_rating": "IntegerType",
                      "updated_at": "timestamp_ntz", "is_active": "StringType",
                      "sku": "UnknownType"},
    null_replacements={"brand": "UNKNOWN", "average_rating": -1},
    case_formatting={"name": "capitalize", "model": "lower", "brand": "upper"},
    standardize_units={"sku": {"from": "SKU-", "to": "sku "}})


@query("clean_rules", with_tables("product_records", """
    SELECT id AS products_id, upper(coalesce(brand, 'UNKNOWN')) AS brand,
      array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN string_split(name, ' ')], ' ')
          AS name,
      replace(regexp_replace(sku, '\\s+', '', 'g'), 'SKU-', 'sku ') AS sku, lower(model) AS model,
      coalesce(CAST(trunc(average_rating) AS INTEGER), -1) AS average_rating,
      TRY_CAST(created_at AS TIMESTAMP) AS created_at,
      TRY_CAST(updated_at AS TIMESTAMP) AS updated_at,
      CAST(is_active AS VARCHAR) AS is_active, is_featured FROM d_product_records"""))
def clean_rules(t: Tables) -> DataFrame:
    return R.apply_rules(t.product_records(), RULES).withColumn(
        "created_at", F.col("created_at").cast("timestamp_ntz"))


_RULE_FILE = """tables:
  products:
    rename_columns: {id: products_id}
    type_conversions: {is_active: BooleanType, average_rating: IntegerType}
    null_replacements: {brand: UNKNOWN}
    case_formatting: {model: lower}
  users:
    rename_columns: {id: user_id}
"""


@query("clean_rules_file", with_tables("product_records", """
    SELECT id AS products_id, coalesce(brand, 'UNKNOWN') AS brand, name, sku, lower(model) AS model,
      CAST(trunc(average_rating) AS INTEGER) AS average_rating, created_at, updated_at, is_active, is_featured
    FROM d_product_records"""))
def clean_rules_file(t: Tables) -> DataFrame:
    """The rules of one table out of a file for several, with an old name for the boolean type."""
    from shelfwise.sources.storage import new_path
    path = new_path(t.spark, "rules")
    t.spark.createDataFrame([(_RULE_FILE.rstrip(),)], "value string").coalesce(1).write.text(path)
    return R.apply_rules(t.product_records(), R.load_rules(t.spark, path, "products"))


@query("clean_cart_today", with_tables("cart_item", """
    SELECT id, updated_at, CAST(date_diff('day', CAST(last_updated AS DATE), current_date) AS INTEGER) AS cart_age_days
    FROM d_cart_item"""))
def clean_cart_today(t: Tables) -> DataFrame:
    """The age of carts as of the day it runs."""
    return L.cart_details(t.cart_item()).select("id", "updated_at", "cart_age_days")


@query("rename_map", with_tables("product_records users", """
    SELECT 'products' AS table_name, id AS product_id, NULL AS user_id, name, sku, NULL AS email, NULL AS role FROM d_product_records
    UNION ALL SELECT 'users', NULL, id, NULL, NULL, email, role FROM d_users"""))
def rename_map(t: Tables) -> DataFrame:
    """Key columns get the name of their table; all other columns stay."""
    tables = [R.rename_for_table(df, name).withColumn("table_name", F.lit(name))
              for name, df in (("products", t.product_records()), ("users", t.users()))]
    both = tables[0].unionByName(tables[1], allowMissingColumns=True)
    return both.select("table_name", "product_id", "user_id", "name", "sku", "email", "role")


@query("rename_map_file", with_tables("product_records", """
    SELECT id AS product_id, * EXCLUDE (id) FROM d_product_records"""))
def rename_map_file(t: Tables) -> DataFrame:
    """All columns, renamed by a map that is read from a file."""
    from shelfwise.sources.storage import new_path
    path = new_path(t.spark, "renames")
    t.spark.createDataFrame([("products:\n  id: product_id\n  absent: ignored\n",)], "value string").coalesce(1) \
        .write.text(path)
    return R.rename_for_table(t.product_records(), "products", R.load_renames(t.spark, path))


@query("unit_rule", with_tables("images", r"""
    SELECT product_id, image_no,
      regexp_replace(regexp_replace(product_id || ' kg  net', '\s+', '', 'g'), 'kg', 'kilogram',
                     'g') AS weight FROM d_images"""))
def unit_rule(t: Tables) -> DataFrame:
    weight = F.concat(F.col("product_id").cast("string"), F.lit(" kg  net"))
    return t.images().select("product_id", "image_no",
                             R.unit_text(weight, "kg", "kilogram").alias("weight"))


@query("linear_units", """SELECT p_partkey AS id, CAST(p_size AS DOUBLE) * CAST(1.8 AS DOUBLE)
    + CAST(32.0 AS DOUBLE) AS fahrenheit FROM part""")
def linear_units(t: Tables) -> DataFrame:
    return t.raw("part").select(
        F.col("p_partkey").alias("id"),
        R.linear_unit(F.col("p_size").cast("double"), 1.8, 32.0).alias("fahrenheit"))


@query("clean_products", with_tables("product_records", """
    SELECT id, nullif(trim(regexp_replace(brand, '\\s+', ' ', 'g')), '') AS brand,
      nullif(trim(regexp_replace(name, '\\s+', ' ', 'g')), '') AS name,
      nullif(trim(regexp_replace(model, '\\s+', ' ', 'g')), '') AS model,
      TRY_CAST(created_at AS TIMESTAMP) AS created_at,
      TRY_CAST(updated_at AS TIMESTAMP) AS updated_at FROM (
        SELECT id, brand, '  ' || replace(name, ' ', '   ') || ' ' AS name, model, created_at,
               updated_at FROM d_product_records)"""))
def clean_products(t: Tables) -> DataFrame:
    messy = t.product_records().withColumn("name", F.concat(
        F.lit("  "), F.regexp_replace("name", " ", "   "), F.lit(" ")))
    return L.clean_texts(messy, ["brand", "name", "model"], ["created_at", "updated_at"]).select(
        "id", "brand", "name", "model", "created_at", "updated_at")


@query("clean_cart_legacy", with_tables("cart_item", f"""
    SELECT id, trim(CAST(cart_id AS VARCHAR)) AS cart_id,
      trim(CAST(product_id AS VARCHAR)) AS product_id, coalesce(quantity, 0) AS quantity,
      CAST(CAST(price AS FLOAT) AS DOUBLE) AS price, updated_at,
      lower(trim(status)) AS status, last_updated,
      CASE WHEN coalesce(quantity, 0) <= 0 THEN 'invalid' WHEN quantity > 100 THEN 'too_high'
           ELSE 'ok' END AS quantity_flag,
      CAST(date_diff('day', CAST(last_updated AS DATE), DATE '{A.AS_OF}') AS INTEGER)
          AS cart_age_days
    FROM d_cart_item"""))
def clean_cart_legacy(t: Tables) -> DataFrame:
    out = L.cart_details(t.cart_item(), F.lit(A.AS_OF).cast("date"))
    return out.withColumn("price", F.col("price").cast("double"))


@query("clean_users_legacy", with_tables("legacy_users", r"""
    SELECT user_id, trim(email) AS email, trim(name) AS name, updated FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated DESC,
          trim(email) DESC, trim(name) DESC) AS r
      FROM d_legacy_users WHERE user_id IS NOT NULL
        AND regexp_full_match(email, '[\w\.-]+@[\w\.-]+\.\w+')) WHERE r = 1"""))
def clean_users_legacy(t: Tables) -> DataFrame:
    return L.clean_users(t.legacy_users(), ["updated"])
