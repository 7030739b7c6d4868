"""Validation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.functions import checks as C
from shelfwise.operators import profile as P, validate as V
from shelfwise.plans.adapters import Tables
from shelfwise.plans.oracle_tables import with_tables
from shelfwise.plans.registry import query


def _sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _not_null(c): return f"{c}_not_null", f"{c} IS NOT NULL"
def _positive(c): return f"{c}_positive", f"{c} > 0"
def _non_empty(c): return f"{c}_non_empty", f"({c} IS NOT NULL AND length({c}) > 0)"
def _range(c, low, high): return f"{c}_in_range", f"{c} BETWEEN {low} AND {high}"
def _stamp(c): return f"{c}_is_timestamp", f"TRY_CAST({c} AS TIMESTAMP) IS NOT NULL"
def _bool(c): return f"{c}_allowed", f"{c} IN (true, false)"


_PRODUCTS = dict([
    _not_null("id"), _positive("id"), _non_empty("brand"), _non_empty("name"), _non_empty("sku"),
    _non_empty("model"), _range("average_rating", 0.0, 5.0), _stamp("created_at"),
    _stamp("updated_at"), _bool("is_active"), _bool("is_featured")])
_USERS = dict([
    _not_null("id"), _positive("id"), _non_empty("email"), _non_empty("username"),
    _non_empty("first_name"), _non_empty("last_name"), _non_empty("password"), _bool("active"),
    ("role_allowed", f"role IN {_sql_list(K.USER_ROLES)}"), _stamp("create_time"),
    _stamp("update_time")])
_WISHES = dict([
    _not_null("id"), _positive("id"), _not_null("user_id"), _positive("user_id"),
    _not_null("product_id"), _positive("product_id"), _non_empty("name"), _non_empty("brand"),
    _positive("price"), _range("rating", 0.0, 5.0), _positive("review_count"),
    ("discounted_price_in_range", "discounted_price >= 0")])


def _flags(table: str, suite: dict[str, str]) -> str:
    return f"SELECT *, {', '.join(f'{v} AS {n}' for n, v in suite.items())} FROM {table}"


def _rejected(table: str, suite: dict[str, str], strict: bool = False) -> str:
    failed = " OR ".join(f"NOT coalesce({n}, false)" if strict else f"NOT {n}" for n in suite)
    return f"SELECT * FROM ({_flags(table, suite)}) WHERE {failed}"


_ALNUM = {**_PRODUCTS, "sku_alphanumeric": "regexp_full_match(sku, '[a-zA-Z0-9-]+')"}


@query("check_flags", with_tables("product_records", _flags("d_product_records", _ALNUM)))
def check_flags(t: Tables) -> DataFrame:
    return V.with_flags(t.product_records(), [*V.products_suite(), C.alphanumeric("sku")])


@query("check_rejects_reference", with_tables(
    "product_records", _rejected("d_product_records", _PRODUCTS)))
def check_rejects_reference(t: Tables) -> DataFrame:
    """NULL flags pass."""
    return V.rejects(t.product_records(), V.products_suite())


@query("check_rejects_strict", with_tables(
    "product_records", _rejected("d_product_records", _PRODUCTS, strict=True)))
def check_rejects_strict(t: Tables) -> DataFrame:
    """NULL flags fail."""
    return V.rejects(t.product_records(), V.products_suite(), strict=True)


PRODUCT_REJECTS_SQL = with_tables("product_records", f"""
    SELECT id, sku, {', '.join(_PRODUCTS)}
    FROM ({_rejected('d_product_records', _PRODUCTS)})""")


@query("suite_products", PRODUCT_REJECTS_SQL)
def suite_products(t: Tables) -> DataFrame:
    return V.rejects(t.product_records(), V.products_suite()).select("id", "sku", *_PRODUCTS)


@query("suite_users", with_tables("users", f"""
    SELECT id, email, {', '.join(_USERS)} FROM ({_rejected('d_users', _USERS)})"""))
def suite_users(t: Tables) -> DataFrame:
    return V.rejects(t.users(), V.users_suite()).select("id", "email", *_USERS)


# The suite runs on the corrected wishlist: names and brands come from the product.
_CORRECTED = """SELECT w.id, w.user_id, w.product_id, p.name, p.brand, w.price,
    w.discounted_price, w.rating, w.review_count, w.create_time
    FROM d_wishlist w LEFT JOIN d_products p ON p.id = w.product_id"""


@query("suite_wishlist", with_tables(
    "wishlist", _rejected("corrected", _WISHES), corrected=_CORRECTED))
def suite_wishlist(t: Tables) -> DataFrame:
    wishes = t.wishlist()
    fixed = V.corrected(V.with_product_reference(wishes, t.products()), wishes.columns)
    return V.rejects(fixed, V.wishlist_suite())


def _summary(name: str, table: str, suite: dict[str, str]) -> str:
    return f"""SELECT '{name}' AS table_name, (SELECT count(*) FROM {table}) AS row_count,
        count(*) AS invalid_count, count(*) > 0 AS errors_found
        FROM ({_rejected(table, suite)})"""


@query("suite_summary", with_tables("product_records users wishlist", " UNION ALL ".join([
    _summary("products", "d_product_records", _PRODUCTS), _summary("users", "d_users", _USERS),
    _summary("wishlist", "d_wishlist", _WISHES)])))
def suite_summary(t: Tables) -> DataFrame:
    return V.suite_summary({"products": (t.product_records(), V.products_suite()),
                            "users": (t.users(), V.users_suite()),
                            "wishlist": (t.wishlist(), V.wishlist_suite())})


def _null_sums(columns) -> str:
    return ", ".join(f"count(*) - count({c}) AS null_{c}" for c in columns)


def _duplicates(table: str, key: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {key} HAVING count(*) > 1))"


@query("prevalidate_cart", with_tables("cart_item", f"""
    SELECT {_null_sums(("id", "price", "quantity", "cart_id"))},
      count(*) FILTER (quantity < 0 OR price < 0) AS negative_values_count,
      {_duplicates('d_cart_item', 'id')} AS duplicate_id_count FROM d_cart_item"""))
def prevalidate_cart(t: Tables) -> DataFrame:
    return V.prevalidate_cart(t.cart_item())


@query("prevalidate_payment", with_tables("payments", f"""
    SELECT {_null_sums(("id", "amount", "user_id", "created_at"))},
      count(*) FILTER (payment_status NOT IN {_sql_list(K.PAYMENT_STATUSES)})
          AS invalid_status_count,
      count(*) FILTER (amount < 0) AS negative_amounts FROM d_payments"""))
def prevalidate_payment(t: Tables) -> DataFrame:
    return V.prevalidate_payment(t.payments())


@query("prevalidate_products", with_tables("product_records", f"""
    SELECT {_null_sums(("id", "name", "brand"))},
      {_duplicates('d_product_records', 'id')} AS duplicate_id_count FROM d_product_records"""))
def prevalidate_products(t: Tables) -> DataFrame:
    return V.prevalidate_products(t.product_records())


@query("prevalidate_users", with_tables("users", f"""
    SELECT {_null_sums(("id", "email"))}, {_duplicates('d_users', 'email')} AS duplicate_emails
    FROM d_users"""))
def prevalidate_users(t: Tables) -> DataFrame:
    return V.prevalidate_users(t.users())


_CONTRACT = " UNION ALL ".join([
    *[f"""SELECT 'products' AS table_name, '{c}' AS column_name, 'unexpected' AS status,
        false AS is_error, count({c}) AS filled_rows FROM d_product_records"""
      for c in ("sku",)],
    *[f"SELECT 'cart_item', '{c}', 'unexpected', false, count({c}) FROM d_cart_item"
      for c in ("cart_id", "updated_at")],
    *[f"SELECT 'users', '{c}', 'unexpected', false, count({c}) FROM d_users"
      for c in ("active", "create_time", "password", "role", "update_time", "username")]])


@query("schema_contract", with_tables("product_records cart_item users", _CONTRACT))
def schema_contract(t: Tables) -> DataFrame:
    """Contract findings, with the number of rows that fill the column concerned."""
    parts = None
    for name, df in (("products", t.product_records()), ("cart_item", t.cart_item()),
                     ("users", t.users())):
        filled = P.null_counts(V.require_contract(df, name)).select(
            "column_name", (F.col("row_count") - F.col("null_count")).alias("filled_rows"))
        found = V.check_contract(t.spark, df.columns, name).join(filled, "column_name", "left")
        parts = found if parts is None else parts.unionByName(found)
    return parts


@query("wishlist_mismatch", with_tables("wishlist", """
    SELECT w.id, w.product_id, 'brand' AS field, w.brand AS found, p.brand AS expected
    FROM d_wishlist w JOIN d_products p ON p.id = w.product_id WHERE w.brand <> p.brand
    UNION ALL
    SELECT w.id, w.product_id, 'name', w.name, p.name
    FROM d_wishlist w JOIN d_products p ON p.id = w.product_id WHERE w.name <> p.name"""))
def wishlist_mismatch(t: Tables) -> DataFrame:
    joined = V.with_product_reference(t.wishlist(), t.products())
    return _mismatch(joined, "brand").unionByName(_mismatch(joined, "name"))


def _mismatch(joined: DataFrame, field: str) -> DataFrame:
    return V.mismatches(joined, field, f"product_{field}").select(
        "id", "product_id", F.lit(field).alias("field"), F.col(field).alias("found"),
        F.col(f"product_{field}").alias("expected"))


@query("wishlist_corrected", with_tables("wishlist", _CORRECTED))
def wishlist_corrected(t: Tables) -> DataFrame:
    wishes = t.wishlist()
    return V.corrected(V.with_product_reference(wishes, t.products()), wishes.columns)


@query("wishlist_corrected_keep", with_tables("wishlist", """
    SELECT w.id, w.user_id, w.product_id, coalesce(p.name, w.name) AS name,
      coalesce(p.brand, w.brand) AS brand, w.price, w.discounted_price, w.rating,
      w.review_count, w.create_time
    FROM d_wishlist w LEFT JOIN d_products p ON p.id = w.product_id"""))
def wishlist_corrected_keep(t: Tables) -> DataFrame:
    wishes = t.wishlist()
    return V.corrected(V.with_product_reference(wishes, t.products()), wishes.columns, "keep")
