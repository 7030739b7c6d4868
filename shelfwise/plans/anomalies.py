"""Return-anomaly queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.operators import anomaly
from shelfwise.plans import adapters as A
from shelfwise.plans.adapters import Tables
from shelfwise.plans.oracle_tables import alternatives, with_tables
from shelfwise.plans.registry import query

START, END = A.WINDOW
_UX, _DEFECT, _LOG = (alternatives(w) for w in
                      (K.UX_REASONS, K.DEFECT_REASONS, K.LOGISTICS_REASONS))
_DAYS = f"(date_diff('day', DATE '{START}', DATE '{END}') + 1)"
_IN = f"BETWEEN DATE '{START}' AND DATE '{END}'"

# The plain fan-out join, as the report is defined.
_JOINED = f"""SELECT i.product_id, i.quantity, r.id AS return_id,
    regexp_matches(r.reason, '{_UX}') AS ux, regexp_matches(r.reason, '{_DEFECT}') AS defect,
    regexp_matches(r.reason, '{_LOG}') AS logistics
  FROM d_sales o JOIN d_order_items i ON i.order_id = o.id
  LEFT JOIN d_returns r ON r.product_id = i.product_id AND r.user_id = o.user_id
       AND CAST(r.created_at AS DATE) {_IN}
  WHERE CAST(o.created_at AS DATE) {_IN}"""
_SUMS = """CAST(sum(quantity) AS BIGINT) AS units, count(return_id) AS rets,
    count(*) FILTER (ux) AS ux, count(*) FILTER (defect) AS defect,
    count(*) FILTER (logistics) AS logistics,
    count(*) FILTER (return_id IS NOT NULL AND NOT ux AND NOT defect AND NOT logistics) AS other"""


def _baseline(prefix: str) -> str:
    return f"""CAST(rets AS DOUBLE) / nullif(units, 0) AS {prefix}_return_rate,
      CAST(ux AS DOUBLE) / nullif(rets, 0) AS {prefix}_ux_share,
      CAST(defect AS DOUBLE) / nullif(rets, 0) AS {prefix}_defect_share,
      CAST(logistics AS DOUBLE) / nullif(rets, 0) AS {prefix}_logistics_share,
      CAST(rets AS DOUBLE) / {_DAYS} AS {prefix}_returns_per_day"""


_TABLES = "sales order_items returns anomaly_products"
_CTES = {
    "joined": _JOINED,
    "per_product": f"SELECT product_id, {_SUMS} FROM joined GROUP BY 1",
    "cat": f"""SELECT category_id, products AS cat_products, {_baseline('cat')} FROM (
        SELECT category_id, count(DISTINCT product_id) AS products, {_SUMS}
        FROM joined JOIN d_anomaly_products p ON p.id = product_id GROUP BY 1)""",
    "port": f"""SELECT products AS port_products, {_baseline('port')} FROM (
        SELECT count(DISTINCT product_id) AS products, {_SUMS} FROM joined)""",
}


def _report_sql(volume_base: str) -> str:
    def base(name: str) -> str:
        return f"coalesce(cat_{name}, port_{name}, 0.0)"

    def surge(name: str) -> str:
        return (f"rets >= 2 AND ({name}_s - {base(name + '_share')} >= 0.10 OR {name}_s >= 0.50)")

    conditions = {
        "high_return_rate": f"units >= 3 AND rate >= {base('return_rate')} * CAST(1.30 AS DOUBLE)"
                            f" AND rate - {base('return_rate')} >= 0.02",
        "volume_spike": f"rets >= 2 AND per_day >= {volume_base} * 2.0"
                        f" AND per_day - {volume_base} >= 1.0",
        "ux_surge": surge("ux"), "defect_surge": surge("defect"),
        "logistics_surge": surge("logistics")}
    flags = ", ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END AS flag_{n}"
                      for n, c in conditions.items())
    names = ", ".join(f"CASE WHEN {c} THEN '{n.upper()}' END" for n, c in conditions.items())
    return with_tables(_TABLES, f"""SELECT product_id, category_id, brand, name,
        units AS units_sold_total, rets AS returns_total, round(rate, 3) AS eventual_return_rate,
        ux AS ux_returns, defect AS defect_returns, logistics AS logistics_returns,
        other AS other_returns, round(ux_s, 3) AS ux_share, round(defect_s, 3) AS defect_share,
        round(logistics_s, 3) AS logistics_share,
        round({base('return_rate')}, 3) AS base_return_rate,
        round({base('returns_per_day')}, 3) AS base_returns_per_day,
        round({base('ux_share')}, 3) AS base_ux_share,
        round({base('defect_share')}, 3) AS base_defect_share,
        round({base('logistics_share')}, 3) AS base_logistics_share,
        {flags}, concat_ws(', ', {names}) AS anomaly_flags
      FROM (SELECT a.*, p.category_id, p.brand, p.name, cat.* EXCLUDE (category_id), port.*,
              CAST(rets AS DOUBLE) / nullif(units, 0) AS rate,
              CAST(rets AS DOUBLE) / {_DAYS} AS per_day,
              CAST(ux AS DOUBLE) / nullif(rets, 0) AS ux_s,
              CAST(defect AS DOUBLE) / nullif(rets, 0) AS defect_s,
              CAST(logistics AS DOUBLE) / nullif(rets, 0) AS logistics_s
            FROM per_product a JOIN d_anomaly_products p ON p.id = a.product_id
            LEFT JOIN cat ON cat.category_id = p.category_id CROSS JOIN port)""", **_CTES)


def _inputs(t: Tables) -> tuple[DataFrame, ...]:
    return t.orders(), t.order_items(), t.anomaly_products(), t.returns()


@query("anomaly_report", _report_sql("coalesce(cat_returns_per_day, port_returns_per_day, 0.0)"))
def anomaly_report(t: Tables) -> DataFrame:
    return anomaly.anomaly_report(*_inputs(t), START, END)


@query("anomaly_report_mean_volume", _report_sql(
    "coalesce(cat_returns_per_day / cat_products, port_returns_per_day / port_products, 0.0)"))
def anomaly_report_mean_volume(t: Tables) -> DataFrame:
    return anomaly.anomaly_report(*_inputs(t), START, END, volume_baseline="per_product_mean")


def _rounded(prefix: str) -> list:
    names = ("return_rate", "ux_share", "defect_share", "logistics_share", "returns_per_day")
    return [F.round(f"{prefix}_{n}", 6).alias(n) for n in names]


def _rounded_sql(prefix: str) -> str:
    names = ("return_rate", "ux_share", "defect_share", "logistics_share", "returns_per_day")
    return ", ".join(f"round({prefix}_{n}, 6) AS {n}" for n in names)


@query("anomaly_category_baseline", with_tables(
    _TABLES, f"SELECT category_id, {_rounded_sql('cat')} FROM cat", **_CTES))
def anomaly_category_baseline(t: Tables) -> DataFrame:
    orders, items, products, returns = _inputs(t)
    per_product = anomaly.product_returns(orders, items, returns, START, END)
    return anomaly.category_baseline(per_product, products, START, END).select(
        "category_id", *_rounded("cat"))


@query("anomaly_portfolio_baseline", with_tables(
    _TABLES, f"SELECT {_rounded_sql('port')} FROM port", **_CTES))
def anomaly_portfolio_baseline(t: Tables) -> DataFrame:
    orders, items, _, returns = _inputs(t)
    per_product = anomaly.product_returns(orders, items, returns, START, END)
    return anomaly.portfolio_baseline(per_product, START, END).select(*_rounded("port"))


@query("anomaly_view", with_tables(
    _TABLES, """SELECT category_id, count(*) AS products, CAST(sum(units) AS BIGINT) AS units,
      CAST(sum(rets) AS BIGINT) AS returns_total
      FROM per_product JOIN d_anomaly_products p ON p.id = product_id GROUP BY 1""", **_CTES))
def anomaly_view(t: Tables) -> DataFrame:
    """The report registered as a view and queried by name."""
    from shelfwise.sources.sinks import register_view
    register_view(anomaly.anomaly_report(*_inputs(t), START, END), "return_anomaly_report")
    return t.spark.sql("""SELECT category_id, count(*) AS products, sum(units_sold_total) AS units,
        sum(returns_total) AS returns_total FROM return_anomaly_report GROUP BY category_id""")
