"""Products with abnormal returns in a window, against category and portfolio baselines."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.functions.text import ratio, reason_in
from shelfwise.operators.joins import lookup_join
from shelfwise.sources.storage import cut_lineage

MEASURES = ("units_sold_total", "returns_total", "ux_returns", "defect_returns",
            "logistics_returns", "other_returns")


@dataclass(frozen=True)
class Thresholds:
    min_units: int = 3
    rate_factor: float = 1.30
    rate_excess: float = 0.02
    min_returns: int = 2
    volume_factor: float = 2.0
    volume_excess: float = 1.0
    share_excess: float = 0.10
    share_floor: float = 0.50


def _day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def window_days(start: date | str, end: date | str) -> Column:
    return F.datediff(_day(end), _day(start)) + 1


def reason_counts(returns: DataFrame, keys: list[str]) -> DataFrame:
    """Returns per key: all, per reason group, and in no group (NULL reasons are in none)."""
    ux = reason_in(F.col("reason"), K.UX_REASONS)
    defect = reason_in(F.col("reason"), K.DEFECT_REASONS)
    logistics = reason_in(F.col("reason"), K.LOGISTICS_REASONS)
    return returns.groupBy(*keys).agg(
        F.count("id").alias("r_all"), F.count_if(ux).alias("r_ux"),
        F.count_if(defect).alias("r_defect"), F.count_if(logistics).alias("r_logistics"),
        F.count_if(~ux & ~defect & ~logistics).alias("r_other"), F.count("*").alias("r_rows"))


def product_returns(orders: DataFrame, items: DataFrame, returns: DataFrame,
                    start: date | str, end: date | str) -> DataFrame:
    """Sales and returns per product sold in the window.

    A return belongs to every order row of its user and product, so m sold rows and n returns
    of one (product, user) make m x n joined rows. Their sums need only the two counts: both
    sides are aggregated per (product, user) first, and the join is one to one.
    """
    in_window = F.to_date("created_at").between(_day(start), _day(end))
    sold_orders = orders.filter(in_window).select(F.col("id").alias("order_id"), "user_id")
    sold = (lookup_join(items.select("order_id", "product_id", "quantity"), sold_orders,
                        "order_id", "inner", spread=("product_id", "quantity"))
            .groupBy("product_id", "user_id")
            .agg(F.sum("quantity").alias("quantity"), F.count("*").alias("rows")))
    returned = reason_counts(returns.filter(in_window), ["product_id", "user_id"])
    joined = sold.join(returned, ["product_id", "user_id"], "left")

    def matched(name: str) -> Column:
        return F.sum(F.col("rows") * F.coalesce(F.col(name), F.lit(0)))

    # A sold row without returns still appears once; with n returns it appears n times.
    copies = F.coalesce("r_rows", F.lit(1))
    return joined.groupBy("product_id").agg(
        F.sum(F.col("quantity") * copies).alias("units_sold_total"),
        matched("r_all").alias("returns_total"), matched("r_ux").alias("ux_returns"),
        matched("r_defect").alias("defect_returns"),
        matched("r_logistics").alias("logistics_returns"),
        matched("r_other").alias("other_returns"))


def _baseline(prefix: str, days: Column) -> list[Column]:
    def total(name: str) -> Column:
        return F.sum(name)
    returns = total("returns_total")
    return [ratio(returns, total("units_sold_total")).alias(f"{prefix}_return_rate"),
            ratio(total("ux_returns"), returns).alias(f"{prefix}_ux_share"),
            ratio(total("defect_returns"), returns).alias(f"{prefix}_defect_share"),
            ratio(total("logistics_returns"), returns).alias(f"{prefix}_logistics_share"),
            ratio(returns, days).alias(f"{prefix}_returns_per_day"),
            F.count("*").alias(f"{prefix}_products")]


def category_baseline(per_product: DataFrame, products: DataFrame, start, end) -> DataFrame:
    """Baselines per category, from the additive product rows."""
    labelled = _with_product(per_product, products)
    return labelled.groupBy("category_id").agg(*_baseline("cat", window_days(start, end)))


def portfolio_baseline(per_product: DataFrame, start, end) -> DataFrame:
    """One baseline row over all products sold, also those without a product record."""
    return per_product.agg(*_baseline("port", window_days(start, end)))


def _with_product(per_product: DataFrame, products: DataFrame) -> DataFrame:
    # Both sides hold one row per product id, so no key can be hot.
    record = products.select(F.col("id").alias("product_id"), "category_id", "brand", "name")
    return per_product.join(record, "product_id", "inner")


def anomaly_report(orders: DataFrame, items: DataFrame, products: DataFrame, returns: DataFrame,
                   start: date | str, end: date | str, thresholds: Thresholds = Thresholds(),
                   volume_baseline: str = "total") -> DataFrame:
    """One row per product sold in the window that has a product record.

    ``volume_baseline="per_product_mean"`` compares daily returns with the category's mean per
    product instead of its total (which includes the product, so that no spike can exceed it).
    """
    # Used for the rows, the categories and the portfolio: the large joins run once.
    per_product = cut_lineage(product_returns(orders, items, returns, start, end))
    labelled = _with_product(per_product, products)
    categories = labelled.groupBy("category_id").agg(*_baseline("cat", window_days(start, end)))
    portfolio = portfolio_baseline(per_product, start, end)
    # The portfolio is one row: a scalar subquery, not a join.
    scored = lookup_join(labelled, categories, "category_id", "left", spread=["product_id"])
    scored = scored.withColumn(
        "portfolio", portfolio.select(F.struct("*")).scalar()).select("*", "portfolio.*")
    return score(scored, start, end, thresholds, volume_baseline)


def score(df: DataFrame, start, end, t: Thresholds, volume_baseline: str) -> DataFrame:
    def base(name: str) -> Column:
        return F.coalesce(F.col(f"cat_{name}"), F.col(f"port_{name}"), F.lit(0.0))

    def per_day_base() -> Column:
        if volume_baseline == "per_product_mean":
            return F.coalesce(ratio(F.col("cat_returns_per_day"), F.col("cat_products")),
                              ratio(F.col("port_returns_per_day"), F.col("port_products")),
                              F.lit(0.0))
        return base("returns_per_day")

    units, returns = F.col("units_sold_total"), F.col("returns_total")
    rate, per_day = ratio(returns, units), ratio(returns, window_days(start, end))
    shares = {n: ratio(F.col(f"{n}_returns"), returns) for n in ("ux", "defect", "logistics")}

    def surge(name: str) -> Column:
        share = shares[name]
        return (returns >= t.min_returns) & (
            (share - base(f"{name}_share") >= t.share_excess) | (share >= t.share_floor))

    flags = {
        "high_return_rate": (units >= t.min_units)
        & (rate >= base("return_rate") * t.rate_factor)
        & (rate - base("return_rate") >= t.rate_excess),
        "volume_spike": (returns >= t.min_returns)
        & (per_day >= per_day_base() * t.volume_factor)
        & (per_day - per_day_base() >= t.volume_excess),
        "ux_surge": surge("ux"), "defect_surge": surge("defect"),
        "logistics_surge": surge("logistics"),
    }
    return df.select(
        "product_id", "category_id", "brand", "name", *MEASURES[:2],
        F.round(rate, 3).alias("eventual_return_rate"), *MEASURES[2:],
        *[F.round(s, 3).alias(f"{n}_share") for n, s in shares.items()],
        F.round(base("return_rate"), 3).alias("base_return_rate"),
        F.round(base("returns_per_day"), 3).alias("base_returns_per_day"),
        *[F.round(base(f"{n}_share"), 3).alias(f"base_{n}_share") for n in shares],
        *[F.when(c, 1).otherwise(0).alias(f"flag_{n}") for n, c in flags.items()],
        F.concat_ws(", ", *[F.when(c, n.upper()) for n, c in flags.items()])
        .alias("anomaly_flags"))
