"""Row cleaning: text and timestamps, carts, users, and incremental batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.functions.text import is_nan, squeeze, to_timestamp_or_null


def clean_texts(df: DataFrame, text_columns: Sequence[str] = (),
                timestamp_columns: Sequence[str] = ()) -> DataFrame:
    """Squeeze text columns (empty becomes NULL) and parse timestamp texts."""
    return df.withColumns({
        **{c: squeeze(F.col(c)) for c in text_columns},
        **{c: to_timestamp_or_null(F.col(c)) for c in timestamp_columns}})


def newer_than(df: DataFrame, bookmark: Column, column: str = "updated_at") -> DataFrame:
    """Rows changed after the bookmark: a plain comparison, which sources can evaluate."""
    return df.filter(F.col(column) > bookmark)


def keep_valid_cart_rows(df: DataFrame) -> DataFrame:
    """Non-negative quantity and price, and no NULL price, quantity or cart."""
    return (df.filter((F.col("quantity") >= 0) & (F.col("price") >= 0))
            .na.drop(subset=["price", "quantity", "cart_id"]))


def cart_details(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Trimmed keys, lower-case status, quantity bands, numeric price and cart age in days."""
    quantity = F.when(F.col("quantity").isNull() | is_nan(F.col("quantity")), F.lit(0)) \
        .otherwise(F.col("quantity"))
    return df.withColumns({
        "product_id": F.trim(F.col("product_id").cast("string")),
        "cart_id": F.trim(F.col("cart_id").cast("string")),
        "status": F.lower(F.trim("status")),
        "quantity": quantity,
        "quantity_flag": F.when(quantity <= 0, "invalid").when(quantity > 100, "too_high")
        .otherwise("ok"),
        "price": F.trim(F.col("price").cast("string")).try_cast("float"),
        "cart_age_days": F.datediff(F.current_date() if as_of is None else as_of,
                                    F.col("last_updated")),
    })


def clean_users(df: DataFrame, latest_by: Sequence[str]) -> DataFrame:
    """Users with an id and a valid e-mail; of several rows per id the latest one stays.

    Equally late rows are told apart by their other columns, so the winner never depends on the order.

    The winner is an aggregate (``max_by``), so copies combine before the shuffle and no user's
    rows are gathered.
    """
    kept = (df.filter(F.col("user_id").isNotNull() & F.col("email").rlike(K.EMAIL_PATTERN))
            .withColumns({"email": F.trim("email"), "name": F.trim("name")}))
    others = [c for c in kept.columns if c != "user_id"]
    return (kept.groupBy("user_id")
            .agg(F.max_by(F.struct(*others), F.struct(*latest_by, *others)).alias("row"))
            .select("user_id", "row.*").select(*df.columns))
