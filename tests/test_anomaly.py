import itertools
import random
import re

import pytest

from shelfwise import constants as K, schemas
from shelfwise.operators import anomaly as A

START, END = "2025-03-01", "2025-03-10"
CODES = [*K.UX_REASONS, *K.DEFECT_REASONS, *K.LOGISTICS_REASONS, "OTHER", "doa", None]


def frames(spark, orders, items, products, returns):
    from datetime import datetime
    def at(s): return datetime.fromisoformat(s)
    return (spark.createDataFrame([(i, u, at(t)) for i, u, t in orders], schemas.ORDERS),
            spark.createDataFrame(items, schemas.ORDER_ITEMS),
            spark.createDataFrame(products, schemas.PRODUCTS),
            spark.createDataFrame([(i, p, u, at(t), r) for i, p, u, t, r in returns],
                                  schemas.RETURNS))


def brute_force(orders, items, products, returns):
    """The report by nested loops over the plain join."""
    def inside(t): return START <= t[:10] <= END
    joined = []
    for (oid, user, t), (_, order, product, quantity) in itertools.product(orders, items):
        if order == oid and inside(t):
            hits = [r for r in returns if r[1] == product and r[2] == user and inside(r[3])]
            joined += [(product, quantity, r) for r in hits or [None]]

    def measure(rows):
        def hits(words):
            return sum(bool(r and r[4] and re.search("|".join(words), r[4], re.I))
                       for _, _, r in rows)
        rets = sum(r is not None for _, _, r in rows)
        groups = [hits(w) for w in (K.UX_REASONS, K.DEFECT_REASONS, K.LOGISTICS_REASONS)]
        none = sum(bool(r and r[4] and not any(
            re.search("|".join(w), r[4], re.I)
            for w in (K.UX_REASONS, K.DEFECT_REASONS, K.LOGISTICS_REASONS))) for _, _, r in rows)
        return sum(q for _, q, _ in rows), rets, *groups, none

    def rates(m):
        units, rets, *groups, _ = m
        return (rets / units if units else None, rets / 10,
                *[g / rets if rets else None for g in groups])

    known = {p[0]: p[1] for p in products}
    port = rates(measure(joined))
    out = {}
    for product in {j[0] for j in joined} & set(known):
        m = measure([j for j in joined if j[0] == product])
        category = known[product]
        cat = rates(measure([j for j in joined if j[0] in known and known[j[0]] == category])) \
            if category is not None else (None,) * 5
        base = [c if c is not None else p if p is not None else 0 for c, p in zip(cat, port)]
        rate, per_day, *shares = rates(m)
        flags = []
        if m[0] >= 3 and rate >= base[0] * 1.3 and rate - base[0] >= 0.02:
            flags.append("HIGH_RETURN_RATE")
        if m[1] >= 2 and per_day >= base[1] * 2 and per_day - base[1] >= 1:
            flags.append("VOLUME_SPIKE")
        for name, share, b in zip(("UX", "DEFECT", "LOGISTICS"), shares, base[2:]):
            if m[1] >= 2 and (share - b >= 0.1 or share >= 0.5):
                flags.append(f"{name}_SURGE")
        out[product] = (*m, ", ".join(flags), round(base[0], 3))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_report_equals_the_plain_join(spark, seed):
    rng = random.Random(seed)
    def day(): return f"2025-0{rng.choice('233334')}-{rng.randint(1, 12):02d} 23:59:59"
    orders = [(i, rng.randint(1, 5), day()) for i in range(40)]
    items = [(i, rng.randint(0, 44), rng.randint(1, 9), rng.randint(1, 3)) for i in range(90)]
    products = [(p, rng.choice([1, 2, None]), "b", f"p{p}") for p in range(1, 9)]  # 9 unknown
    returns = [(i, rng.randint(1, 9), rng.randint(1, 6), day(), rng.choice(CODES))
               for i in range(80)]
    got = A.anomaly_report(*frames(spark, orders, items, products, returns), START, END)
    found = {r["product_id"]: (*[r[m] for m in A.MEASURES], r["anomaly_flags"],
                               r["base_return_rate"]) for r in got.collect()}
    assert found == brute_force(orders, items, products, returns)


def small(spark, returns, quantity=3):
    return frames(spark, [(1, 1, START), (2, 2, f"{END} 23:59:59"), (3, 1, "2025-03-11")],
                  [(1, 1, 10, quantity), (2, 2, 10, 1), (3, 1, 11, 2), (4, 3, 10, 9)],
                  [(10, None, "b", "x"), (11, 5, "b", "y")], returns)


def test_window_edges_null_category_and_fan_out(spark):
    day = "2025-03-05"
    report = A.anomaly_report(*small(spark, [(1, 10, 1, day, "DOA"), (2, 10, 1, day, None)]),
                              START, END)
    row = {r["product_id"]: r for r in report.collect()}[10]
    # The order of user 1 counts once per return; order 3 lies outside.
    assert (row["units_sold_total"], row["returns_total"]) == (7, 2)
    assert (row["defect_returns"], row["other_returns"]) == (1, 0)
    # No category: the portfolio (9 units, 2 returns) is the baseline.
    assert row["base_return_rate"] == round(2 / 9, 3)


def test_no_returns_give_null_shares(spark):
    row = A.anomaly_report(*small(spark, []), START, END).filter("product_id = 10").first()
    assert row["ux_share"] is None and row["anomaly_flags"] == ""
    assert row["eventual_return_rate"] == 0.0


def test_volume_spike_needs_the_mean_baseline(spark):
    day = "2025-03-05"
    tables = small(spark, [(i, 10, 1, day, "DOA") for i in range(40)])
    assert "VOLUME" not in A.anomaly_report(*tables, START, END).filter(
        "product_id = 10").first()["anomaly_flags"]
    mean = A.anomaly_report(*tables, START, END, volume_baseline="per_product_mean")
    assert "VOLUME_SPIKE" in mean.filter("product_id = 10").first()["anomaly_flags"]
