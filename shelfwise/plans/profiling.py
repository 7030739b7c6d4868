"""Profile, schema and rule-inference queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.operators import profile as P
from shelfwise.plans.adapters import Tables
from shelfwise.plans.oracle_tables import with_tables
from shelfwise.plans.registry import query

# Columns of the profiled tables with the SQL that renders a value as report text.
CART = {"id": "CAST(id AS VARCHAR)", "cart_id": "CAST(cart_id AS VARCHAR)",
        "product_id": "CAST(product_id AS VARCHAR)", "quantity": "CAST(quantity AS VARCHAR)",
        "price": "CAST(price AS VARCHAR)",
        "updated_at": "strftime(updated_at, '%Y-%m-%dT%H:%M:%S.%f')", "status": "status",
        "last_updated": "strftime(last_updated, '%Y-%m-%dT%H:%M:%S.%f')"}
ORDERS = {"id": "CAST(id AS VARCHAR)", "user_id": "CAST(user_id AS VARCHAR)",
          "amount": "CAST(amount AS VARCHAR)", "payment_status": "payment_status",
          "created_at": "strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f')"}
RECORDS = {"id": "CAST(id AS VARCHAR)"}
RECORDS |= {c: c for c in ("brand", "name", "sku", "model", "created_at", "updated_at")}
RECORDS |= {"average_rating": "CAST(average_rating AS VARCHAR)"}
RECORDS |= {"is_active": "CAST(is_active AS VARCHAR)",
            "is_featured": "CAST(is_featured AS VARCHAR)"}


def _values(table: str, columns: dict[str, str]) -> str:
    """(column_name, value) of every cell."""
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, {v} AS value FROM {table}"
                              for c, v in columns.items())


def _nulls(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count "
        f"FROM {table}" for c in columns)


def _top(table: str, columns: dict[str, str], n: int) -> str:
    return f"""SELECT column_name, value, frequency, CAST(r AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY column_name
            ORDER BY frequency DESC, value ASC NULLS FIRST) AS r
        FROM (SELECT column_name, value, count(*) AS frequency
              FROM ({_values(table, columns)}) GROUP BY 1, 2)) WHERE r <= {n}"""


_TYPES = {"id": "bigint", "cart_id": "bigint", "product_id": "bigint", "quantity": "int",
          "price": "double", "updated_at": "timestamp_ntz", "status": "string",
          "last_updated": "timestamp_ntz"}


@query("profile_types", with_tables("cart_item", f"""
    SELECT column_name, data_type, row_count, null_count FROM ({_nulls("d_cart_item", CART)})
    JOIN (VALUES {", ".join(f"('{c}', '{k}')" for c, k in _TYPES.items())})
         AS v(column_name, data_type) USING (column_name)"""))
def profile_types(t: Tables) -> DataFrame:
    """Each column's type beside its filling."""
    cart = t.cart_item()
    return P.column_types(cart).join(P.null_counts(cart), "column_name")


NULLS_SQL = with_tables("cart_item", _nulls("d_cart_item", CART))


@query("profile_nulls", NULLS_SQL)
def profile_nulls(t: Tables) -> DataFrame:
    return P.null_counts(t.cart_item())


_STATS = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean,
    round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min,
    CAST(max({c}) AS DOUBLE) AS max FROM d_cart_item"""
    for c in ("id", "cart_id", "product_id", "quantity", "price"))


@query("profile_stats", with_tables("cart_item", _STATS))
def profile_stats(t: Tables) -> DataFrame:
    return P.column_stats(t.cart_item()).withColumns(
        {"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query("profile_distinct", with_tables("cart_item", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM d_cart_item"
    for c in CART)))
def profile_distinct(t: Tables) -> DataFrame:
    return P.distinct_counts(t.cart_item())


@query("profile_distinct_approx")
def profile_distinct_approx(t: Tables) -> DataFrame:
    return P.distinct_counts(t.cart_item(), approximate=True)


@query("profile_distinct_bound", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, true AS close, true AS repeatable" for c in CART))
def profile_distinct_bound(t: Tables) -> DataFrame:
    """The approximate counts against the exact ones: five times the promised deviation of 5 percent."""
    cart = t.cart_item()
    one, two = (P.distinct_counts(cart, approximate=True).withColumnRenamed("distinct_count", n)
                for n in ("one", "two"))
    both = P.distinct_counts(cart).join(one, "column_name").join(two, "column_name")
    return both.select("column_name", (F.abs(F.col("one") - F.col("distinct_count"))
                                       <= 0.25 * F.col("distinct_count") + 1).alias("close"),
                       (F.col("one") == F.col("two")).alias("repeatable"))


@query("profile_topn", with_tables("cart_item", _top("d_cart_item", CART, 5)))
def profile_topn(t: Tables) -> DataFrame:
    return P.top_values(t.cart_item())


@query("profile_topn_sketched", with_tables("cart_item", _top("d_cart_item", CART, 5)))
def profile_topn_sketched(t: Tables) -> DataFrame:
    """The same by the way of large tables: sketches first, and only candidates counted where that is enough."""
    return P.top_values(t.cart_item(), sketch_above=0)


@query("profile_sanitised", """
    SELECT CAST(l_orderkey AS BIGINT) AS key, l_linenumber AS line,
      '{"key":' || l_orderkey || ',"amounts":[' || CASE WHEN l_linenumber % 2 = 0 THEN 'null' ELSE CAST(CAST(l_quantity AS DOUBLE) AS VARCHAR) END
      || ',null],"dates":{"shipped":"' || strftime(l_shipdate, '%Y-%m-%d') || '"},"deep":[{"at":"' || strftime(l_shipdate, '%Y-%m-%d')
      || 'T00:00:00.000000","share":' || CASE WHEN l_linenumber % 3 = 0 THEN 'null' ELSE '0.5' END || '}],"none":null}' AS report
    FROM lineitem""")
def profile_sanitised(t: Tables) -> DataFrame:
    """Arrays, maps and structs with NaN and dates inside, as a report writes them."""
    line, day = F.col("l_linenumber"), F.col("l_shipdate").cast("date")
    nan = F.lit(float("nan"))
    rows = t.raw("lineitem").select("l_orderkey", line, F.struct(
        F.col("l_orderkey").cast("bigint").alias("key"),
        F.array(F.when(line % 2 == 0, nan).otherwise(F.col("l_quantity").cast("double")), nan).alias("amounts"),
        F.create_map(F.lit("shipped"), day).alias("dates"),
        F.array(F.struct(day.cast("timestamp_ntz").alias("at"), F.when(line % 3 == 0, nan).otherwise(F.lit(0.5)).alias("share"))).alias("deep"),
        F.lit(None).cast("struct<a: int>").alias("none")).alias("r"))
    return rows.select(F.col("l_orderkey").cast("bigint").alias("key"), line.alias("line"),
                       P.as_text(F.col("r"), rows.schema["r"].dataType).alias("report"))


@query("profile_topn_selected", with_tables("payments", _top(
    "d_payments", {"payment_status": "payment_status"}, 10)))
def profile_topn_selected(t: Tables) -> DataFrame:
    # `order_status` is not a column of the table and is skipped.
    return P.top_values(t.payments(), 10, ["payment_status", "order_status"])


def _profile(table: str, columns: dict[str, str], types: dict[str, str],
             numeric: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column_name, 'data_type' AS metric, '{k}' AS value"
             for c, k in types.items()]
    parts += [f"SELECT column_name, 'null_count', CAST(null_count AS VARCHAR) "
              f"FROM ({_nulls(table, columns)})"]
    for c in numeric:
        for metric, value in {
                "count": f"count({c})", "mean": f"round(avg({c}), 4)",
                "stddev": f"round(stddev_samp({c}), 4)", "min": f"CAST(min({c}) AS DOUBLE)",
                "max": f"CAST(max({c}) AS DOUBLE)"}.items():
            parts.append(f"SELECT '{c}', '{metric}', CAST({value} AS VARCHAR) FROM {table}")
    parts.append(f"""SELECT column_name, 'distinct_count', CAST(count(DISTINCT value) AS VARCHAR)
        FROM ({_values(table, columns)}) GROUP BY 1""")
    parts.append(f"""SELECT column_name, 'top_' || rank, coalesce(value, 'null') || ' (' ||
        frequency || ')' FROM ({_top(table, columns, 5)})""")
    return "SELECT 'payment' AS table_name, * FROM (" + " UNION ALL ".join(parts) + ")"


# The given amounts lie between a thousandth and ten million, where both engines print plain decimals.
@query("profile_table", with_tables("payments", _profile(
    "d_payments", ORDERS, {"id": "bigint", "user_id": "bigint", "amount": "double",
                           "payment_status": "string", "created_at": "timestamp_ntz"},
    ["id", "user_id", "amount"])))
def profile_table(t: Tables) -> DataFrame:
    return P.profile_table(t.payments(), "payment")


@query("profile_value_sample", with_tables("cart_item", f"""
    SELECT column_name, value, CAST(r AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY value) AS r FROM (
        SELECT DISTINCT * FROM ({_values("d_cart_item", {c: CART[c] for c in
                                 ("updated_at", "status")})}) WHERE value IS NOT NULL))
    WHERE r <= 10"""))
def profile_value_sample(t: Tables) -> DataFrame:
    return P.value_sample(t.cart_item(), ["updated_at", "status"])


def _catalogue(t: Tables) -> dict[str, DataFrame]:
    return {"cart_item": t.cart_item(), "payment": t.payments(), "products": t.product_records(),
            "users": t.users()}


def _explored() -> str:
    kinds = {
        "cart_item": ("d_cart_item", _TYPES),
        "payment": ("d_payments", {"id": "bigint", "user_id": "bigint", "amount": "double",
                                   "payment_status": "string", "created_at": "timestamp_ntz"}),
        "products": ("d_product_records", {
            "id": "bigint", "brand": "string", "name": "string", "sku": "string",
            "model": "string", "average_rating": "double", "created_at": "string",
            "updated_at": "string", "is_active": "boolean", "is_featured": "boolean"}),
        "users": ("d_users", {
            "id": "bigint", "email": "string", "username": "string", "first_name": "string",
            "last_name": "string", "password": "string", "active": "boolean", "role": "string",
            "create_time": "string", "update_time": "string"})}
    return " UNION ALL ".join(f"""SELECT '{n}' AS table_name, column_name, data_type,
        contains(data_type, 'timestamp') AS is_timestamp,
        CASE WHEN column_name = 'id' THEN '{n}_id' END AS proposed_name, row_count, null_count
        FROM ({_nulls(cte, cols)}) JOIN (VALUES
        {", ".join(f"('{c}', '{k}')" for c, k in cols.items())}) AS v(column_name, data_type)
        USING (column_name)""" for n, (cte, cols) in kinds.items())


_EXPLORED = with_tables("cart_item payments product_records users", _explored())


@query("schema_explore", _EXPLORED)
def schema_explore(t: Tables) -> DataFrame:
    """Columns, types, proposed key names and filling of the lower-case tables."""
    tables = {**_catalogue(t), "Archive": t.orders()}
    names = t.spark.createDataFrame([(n,) for n in tables], "table_name string")
    return P.explore_schema(t.spark, tables, counts=True).join(
        P.lowercase_names(names), "table_name", "left_semi")


@query("schema_report_versioned", f"SELECT *, 2 AS version FROM ({_EXPLORED})")
def schema_report_versioned(t: Tables) -> DataFrame:
    from shelfwise.sources.reports import latest_report, save_report
    from shelfwise.sources.storage import new_path
    path = new_path(t.spark, "schema-report")
    for _ in range(2):
        save_report(P.explore_schema(t.spark, _catalogue(t), counts=True), path)
    return latest_report(t.spark, path)


_RULES = []
for _table, _cte, _cols in (("cart_item", "d_cart_item", CART),
                            ("products", "d_product_records", RECORDS)):
    _stamps = [c for c in _cols if _table == "cart_item" and c in ("updated_at", "last_updated")]
    _RULES.append(f"""SELECT '{_table}' AS table_name, 'id' AS column_name,
        'rename_columns' AS rule, '{_table}_id' AS value""")
    _RULES += [f"SELECT '{_table}', '{c}', 'type_conversions', 'timestamp_ntz'" for c in _stamps]
    _RULES.append(f"""SELECT '{_table}', column_name, 'null_replacements', 'UNKNOWN'
        FROM ({_nulls(_cte, _cols)}) WHERE null_count * 2 > row_count""")
    _RULES.append(f"""SELECT '{_table}', column_name, 'type_conversions', 'boolean' FROM (
        SELECT column_name, bool_and(coalesce(lower(trim(value)), 'none') IN
            ('0', '1', 'true', 'false', 'yes', 'no')) AS words
        FROM ({_top(_cte, {c: v for c, v in _cols.items() if c not in _stamps}, 5)})
        GROUP BY 1) WHERE words""")


@query("rule_inference", with_tables("cart_item product_records", " UNION ALL ".join(_RULES)))
def rule_inference(t: Tables) -> DataFrame:
    return P.infer_all_rules({"cart_item": t.cart_item(),
                              "products": t.product_records()})
