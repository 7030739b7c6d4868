"""Validation suites, pre-clean metrics, column contracts and cross-table checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise import constants as K
from shelfwise.functions import checks as C
from shelfwise.operators.joins import lookup_join


# ---- suites: named lists of checks ----

def products_suite() -> list[Column]:
    return [C.not_null("id"), C.positive("id"),
            C.non_empty("brand"), C.non_empty("name"), C.non_empty("sku"), C.non_empty("model"),
            C.in_range("average_rating", 0.0, 5.0),
            C.is_timestamp("created_at"), C.is_timestamp("updated_at"),
            C.allowed("is_active", (True, False)), C.allowed("is_featured", (True, False))]


def users_suite() -> list[Column]:
    return [C.not_null("id"), C.positive("id"),
            C.non_empty("email"), C.non_empty("username"), C.non_empty("first_name"),
            C.non_empty("last_name"), C.non_empty("password"),
            C.allowed("active", (True, False)), C.allowed("role", K.USER_ROLES),
            C.is_timestamp("create_time"), C.is_timestamp("update_time")]


def wishlist_suite() -> list[Column]:
    return [C.not_null("id"), C.positive("id"),
            C.not_null("user_id"), C.positive("user_id"),
            C.not_null("product_id"), C.positive("product_id"),
            C.non_empty("name"), C.non_empty("brand"),
            C.positive("price"), C.in_range("rating", 0.0, 5.0), C.positive("review_count"),
            C.in_range("discounted_price", 0.0, float("inf"))]


def with_flags(df: DataFrame, suite: Sequence[Column]) -> DataFrame:
    return df.select("*", *suite)


def flag_names(df: DataFrame, suite: Sequence[Column]) -> list[str]:
    return df.select(*suite).columns


def rejects(df: DataFrame, suite: Sequence[Column], strict: bool = False) -> DataFrame:
    """Rows failing a check, with their flags. A NULL flag fails only with ``strict``."""
    names = flag_names(df, suite)
    return with_flags(df, suite).filter(reduce(or_, [_failed(n, strict) for n in names]))


def _failed(name: str, strict: bool) -> Column:
    return ~F.coalesce(F.col(name), F.lit(False)) if strict else ~F.col(name)


def suite_summary(tables: Mapping[str, tuple[DataFrame, Sequence[Column]]],
                  strict: bool = False) -> DataFrame:
    """One row per table: (table_name, row_count, invalid_count, errors_found), one scan each."""
    parts = []
    for name, (df, suite) in tables.items():
        failed = reduce(or_, [_failed(n, strict) for n in flag_names(df, suite)])
        parts.append(with_flags(df, suite).agg(
            F.count("*").alias("row_count"), F.count_if(failed).alias("invalid_count"))
            .select(F.lit(name).alias("table_name"), "row_count", "invalid_count",
                    (F.col("invalid_count") > 0).alias("errors_found")))
    return reduce(DataFrame.unionByName, parts)


# ---- metrics before cleaning ----

def prevalidate(df: DataFrame, nulls: Sequence[str] = (), conditions: Mapping[str, Column] = {},
                unique_key: str | None = None, unique_name: str = "duplicate_id_count",
                ) -> DataFrame:
    """One row of defect counts: NULLs, rows meeting a condition, and keys that occur twice.

    With a unique key the counts are first taken per key, so that one aggregation by key serves
    both the duplicate count and the totals; NULL counts as a key.
    """
    counts = {**{f"null_{c}": F.count_if(F.col(c).isNull()) for c in nulls},
              **{name: F.count_if(cond) for name, cond in conditions.items()}}
    if unique_key is None:
        return df.agg(*[v.alias(k) for k, v in counts.items()])
    per_key = df.groupBy(unique_key).agg(
        F.count("*").alias("_rows"), *[v.alias(f"_{k}") for k, v in counts.items()])
    return per_key.agg(
        *[F.coalesce(F.sum(f"_{k}"), F.lit(0)).alias(k) for k in counts],
        F.count_if(F.col("_rows") > 1).alias(unique_name))


def prevalidate_cart(df: DataFrame) -> DataFrame:
    return prevalidate(df, ("id", "price", "quantity", "cart_id"),
                       {"negative_values_count": (F.col("quantity") < 0) | (F.col("price") < 0)},
                       unique_key="id")


def prevalidate_payment(df: DataFrame) -> DataFrame:
    return prevalidate(df, ("id", "amount", "user_id", "created_at"), {
        "invalid_status_count": ~F.col("payment_status").isin(*K.PAYMENT_STATUSES),
        "negative_amounts": F.col("amount") < 0})


def prevalidate_products(df: DataFrame) -> DataFrame:
    return prevalidate(df, ("id", "name", "brand"), unique_key="id")


def prevalidate_users(df: DataFrame) -> DataFrame:
    return prevalidate(df, ("id", "email"), unique_key="email", unique_name="duplicate_emails")


# ---- column contracts ----

def check_contract(spark: SparkSession, columns: Sequence[str], table: str,
                   contract: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Findings (table_name, column_name, status, is_error) on a table's column names."""
    contract = K.CONTRACTS[table] if contract is None else contract
    present = set(columns)
    required = contract.get("required", [])
    disallowed = contract.get("disallowed", [])
    known = {*required, *contract.get("optional", []), *disallowed}
    rows = [(table, c, "missing_required", True) for c in required if c not in present]
    rows += [(table, c, "disallowed_present", True) for c in disallowed if c in present]
    rows += [(table, c, "unexpected", False) for c in sorted(present - known)]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, status string, is_error boolean")


def require_contract(df: DataFrame, table: str,
                     contract: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``df`` itself; raises when a required column is missing or a disallowed one present."""
    contract = K.CONTRACTS[table] if contract is None else contract
    missing = [c for c in contract.get("required", []) if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing required columns {missing}")
    present = [c for c in contract.get("disallowed", []) if c in df.columns]
    if present:
        raise ValueError(f"{table}: disallowed columns present {present}")
    return df


# ---- wishlist against its product reference ----

def with_product_reference(wishlist: DataFrame, products: DataFrame,
                           spread: Sequence[str] = ("id",)) -> DataFrame:
    """Add product_name and product_brand of the referenced product (NULL for orphans)."""
    reference = products.select(F.col("id").alias("product_id"),
                                F.col("name").alias("product_name"),
                                F.col("brand").alias("product_brand"))
    return lookup_join(wishlist, reference, "product_id", "left", spread)


def mismatches(joined: DataFrame, column: str, reference: str) -> DataFrame:
    """Rows differing from the reference; NULL on either side is no mismatch."""
    return joined.filter(F.col(column) != F.col(reference))


def corrected(joined: DataFrame, columns: Sequence[str], on_orphan: str = "null") -> DataFrame:
    """Take brand and name from the reference, then restore the original columns.

    Rows without a reference get NULL, or keep their own values with ``on_orphan="keep"``.
    """
    def fixed(reference: str, own: str) -> Column:
        value = F.col(reference)
        return F.coalesce(value, F.col(own)) if on_orphan == "keep" else value
    return joined.withColumns({"brand": fixed("product_brand", "brand"),
                               "name": fixed("product_name", "name")}).select(*columns)
