import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfwise import constants as K
from shelfwise.operators import history as H, recommend as R

CATEGORIES = ["A", "B", "C", None]
WORDS = ["alpha", "beta", "gam", "ma", "x", "delta ray"]


def catalog(spark, products):
    return spark.createDataFrame(
        products, "id bigint, name string, category string, price double, description string, "
                  "pos bigint")


def random_case(seed):
    rng = random.Random(seed)
    products = [(100 + i, f"p{i}", rng.choice(CATEGORIES), 1.0,
                 rng.choice([None, "", " ".join(rng.sample(WORDS, 3)).title()]), i)
                for i in range(rng.choice([1, 4, 12, 30]))]
    profiles = {u: (rng.sample(CATEGORIES, rng.randint(0, 2)),
                    [f.upper() for f in rng.sample(WORDS + ["", "no such", "amma"],
                                                   rng.randint(0, 3))])
                for u in range(4)}
    events = [(e, e, rng.randint(0, 5), rng.choice(products)[0]) for e in range(25)]
    return products, profiles, events


def likes(profile, product):
    categories, features = profile
    text = (product[4] or "").lower()
    return product[2] in [c for c in categories if c is not None], any(
        f.lower() in text for f in features)


def expected(products, profile, viewed, k):
    """Tiers one after the other over the whole catalog."""
    others = [p for p in products if p[0] != viewed]
    category = next(p[2] for p in products if p[0] == viewed)
    out = []
    if profile is not None:
        for choose in (lambda p: likes(profile, p)[0], lambda p: likes(profile, p)[1]):
            out += [p for p in others if choose(p) and p not in out]
    out += [p for p in others if category is not None and p[2] == category and p not in out]
    fill = sorted((p for p in others if p not in out), key=lambda p: (p[5] * 7 % 11, p[5]))
    return [p[0] for p in (out + fill)[:k]]


def views_of(spark, products, profiles, events):
    category = {p[0]: p[2] for p in products}
    data = [(e, ts, u, p, category[p], u in profiles, *(profiles.get(u) or (None, None)))
            for e, ts, u, p in events]
    df = spark.createDataFrame(
        data, "event_id bigint, ts bigint, user_id bigint, product_id bigint, category string, "
              "has_user_profile boolean, cats array<string>, feats array<string>")
    sets = R.preference_columns(F.col("cats"), F.col("feats"))
    return df.withColumns(sets).drop("cats", "feats")


@pytest.mark.parametrize("few", [0, 200])
def test_feature_matches_by_scan_and_by_pieces(spark, monkeypatch, few):
    monkeypatch.setattr(R, "FEW_FEATURES", few)
    products, _, _ = random_case(5)
    features = ["", "x", "ma", "alpha", "delta ray", "amma", "no such", "a r"]
    frame = spark.createDataFrame([(f,) for f in features], "feature string")
    got = R.feature_matches(catalog(spark, products), frame)
    assert rows(got, "feature", "id") == sorted(
        ((f, p[0]) for f in features for p in products if f in (p[4] or "").lower()), key=repr)
    shelf = R.Shelf.of(catalog(spark, products), 3)
    marks = {r["id"]: r["matched"] for r in shelf.marks(frame).collect()}
    assert marks == {p[0]: sorted(f for f in features if f in (p[4] or "").lower()) for p in products}
    assert (shelf.pieces is None) == (few > 0)
    before = shelf.marked
    if few:  # known features need no further scan, new ones do
        assert shelf.marks(frame.limit(3)) is before
        assert shelf.marks(spark.createDataFrame([("beta",)], "feature string")) is not before
        assert {"beta", "amma"} <= shelf.known


@pytest.mark.parametrize("seed", range(3))
def test_short_lists_give_the_brute_force_result(spark, seed):
    products, profiles, events = random_case(seed)
    k = 1 + seed % 5
    shelf = catalog(spark, products)
    views = views_of(spark, products, profiles, events)
    preferences = R.Preferences.of(views, shelf)
    recs = R.recommend(views, shelf, k, F.col("pos") * 7 % 11, preferences)
    got = {r["event_id"]: [x["id"] for x in r["recommendations"]] for r in recs.collect()}
    assert got == {e: expected(products, profiles.get(u), p, k) for e, _, u, p in events}

    prepared = R.Shelf.of(shelf, k, F.col("pos") * 7 % 11)
    again = R.recommend(views, shelf, k, shelf=prepared)
    assert rows(again.select("event_id", "recommendations")) == rows(
        recs.select("event_id", "recommendations"))

    # Scoring, by its definition: over all products, once per user, at the first non-zero event.
    total = {u: sum(any(likes(pr, p)) for p in products) for u, pr in profiles.items()}
    by_id = {p[0]: p for p in products}
    users = {}
    for e, _, u, p in events:
        if u in profiles:
            chosen = expected(products, profiles[u], p, k)
            hits = sum(any(likes(profiles[u], by_id[c])) for c in chosen)
            seen = users.setdefault(u, [0, 0, total[u], 0])
            seen[0] += len(chosen)
            seen[1] += hits
            seen[3] += hits
    counters = R.event_counters(recs, R.relevant_totals(preferences, shelf))
    scored = {r["user_id"]: [r[c] for c in R.COUNTERS] for r in R.user_metrics(counters).collect()}
    assert scored == users
    overall = R.global_metrics(counters).first()
    sums = [sum(v[i] for v in users.values()) for i in range(4)]
    assert [overall[c] for c in R.COUNTERS] == sums
    assert overall["precision"] == pytest.approx(sums[1] / sums[0] if sums[0] else 0.0)
    assert overall["recall"] == pytest.approx(sums[3] / sums[2] if sums[2] else 0.0)


def test_recall_can_exceed_one_and_distinct_cannot(spark):
    products = [(i, "p", "A" if i < 4 else "B", 1.0, "", i) for i in range(8)]
    profiles = {1: (["A"], [])}
    events = [(e, e, 1, 7) for e in range(3)]
    views, shelf = views_of(spark, products, profiles, events), catalog(spark, products)
    preferences = R.Preferences.of(views, shelf)
    recs = R.recommend(views, shelf, 3, preferences=preferences)
    totals = R.relevant_totals(preferences, shelf)
    assert R.global_metrics(R.event_counters(recs, totals)).first()["recall"] == 9 / 4
    assert rows(R.distinct_recall(recs, totals), "distinct_relevant", "recall") == [(3, 0.75)]


def test_default_catalog_tiers(spark):
    from shelfwise.sources.readers import default_catalog
    shelf = default_catalog(spark)
    products = [(*p, i) for i, p in enumerate(K.DEFAULT_CATALOG)]
    views = views_of(spark, products, {1: (["Hardware"], ["VOICE"])}, [(0, 0, 1, 4), (1, 1, 2, 4)])
    recs = {r["event_id"]: r["recommendations"] for r in R.recommend(views, shelf, 3).collect()}
    assert [(x["id"], x["tier"]) for x in recs[0]][:2] == [(5, 1), (2, 2)]
    assert recs[0][2]["tier"] == 4
    assert (recs[1][0]["id"], recs[1][0]["tier"]) == (5, 3)


def test_seeds_change_the_fill_only(spark):
    products = [(i, "p", "A" if i < 2 else "B", 1.0, "", i) for i in range(30)]
    views = views_of(spark, products, {}, [(0, 0, 9, 0)])
    shelf = catalog(spark, products)
    found = [[x["id"] for x in R.category_recommend(views, shelf, 6, R.seeded_fill(s))
              .first()["recommendations"]] for s in (1, 1, 2)]
    assert found[0] == found[1] != found[2]
    assert all(ids[0] == 1 and 0 not in ids and len(set(ids)) == 6 for ids in found)


def test_histories_of_users_of_any_size(spark):
    rng = random.Random(5)
    kinds = [K.VIEW_EVENT, K.PURCHASE_EVENT, "click"]
    events = [(i, i // 2, rng.choice([1, 1, 2, 3, None]), rng.choice(kinds), i + 1000)
              for i in range(400)]
    df = spark.createDataFrame(
        events, "event_id bigint, ts bigint, user_id bigint, event_type string, product_id bigint")
    positioned = H.positions(df)
    out = {r["event_id"]: r for r in H.with_histories(positioned, 4).collect()}
    lists = {}
    for i, _, u, kind, p in events:
        if u is None:
            assert i not in out
            continue
        viewed, bought = lists.setdefault(u, ([], []))
        row = out[i]
        assert (row["views_before"], row["purchases_before"]) == (len(viewed), len(bought))
        assert row["viewing_history"] == viewed
        assert row["purchase_history"] == bought
        {K.VIEW_EVENT: viewed, K.PURCHASE_EVENT: bought}.get(kind, []).append(p)
    entries = rows(H.entries(positioned), "user_id", "event_type", "seq", "product_id")
    assert entries == sorted(
        [(u, kind, n + 1, p) for u, (v, b) in lists.items()
         for kind, items in ((K.VIEW_EVENT, v), (K.PURCHASE_EVENT, b))
         for n, p in enumerate(items)], key=repr)


def test_a_user_with_thousands_of_events_keeps_full_histories(spark):
    n = 2500
    events = [(i, i, 7, K.VIEW_EVENT if i % 3 else K.PURCHASE_EVENT, i + 1000) for i in range(n)]
    df = spark.createDataFrame(
        events, "event_id bigint, ts bigint, user_id bigint, event_type string, product_id bigint")
    out = H.with_histories(H.positions(df)).selectExpr(
        "event_id", "size(viewing_history) AS v", "size(purchase_history) AS p",
        "try_element_at(viewing_history, 1) AS first", "try_element_at(viewing_history, -1) AS last").collect()
    for r in out:
        seen = [e[4] for e in events[:r["event_id"]] if e[3] == K.VIEW_EVENT]
        assert (r["v"], r["p"]) == (len(seen), r["event_id"] - len(seen))
        if seen:
            assert (r["first"], r["last"]) == (seen[0], seen[-1])
    assert len(out) == n


def test_short_histories_need_no_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(i, i, i % 3, K.VIEW_EVENT if i % 2 else K.PURCHASE_EVENT, i + 1000) for i in range(30)],
                               "event_id bigint, ts bigint, user_id bigint, event_type string, product_id bigint")
    positioned = H.positions(df)
    want = rows(H.with_histories(positioned, 2))  # most of them from blocks
    monkeypatch.setattr(H, "entry_blocks", None)
    assert rows(H.with_histories(positioned, 5)) == want


def test_a_shelf_ranks_its_marked_products_once(spark, monkeypatch):
    products, profiles, events = random_case(1)
    views, shelf = views_of(spark, products, profiles, events), catalog(spark, products)
    prepared = R.Shelf.of(shelf, 3, F.col("pos") * 7 % 11)
    plain, ranked = R.first_per_group, []
    monkeypatch.setattr(R, "first_per_group", lambda df, group, *more: ranked.append(group) or plain(df, group, *more))

    def batch():
        preferences = R.Preferences.of(views, shelf, prepared)
        recs = R.recommend(views, shelf, 3, None, preferences, prepared)
        return rows(R.event_counters(recs.withColumn("ts", F.lit(0)), R.relevant_totals(preferences, shelf, prepared)))

    assert batch() == batch()
    assert ranked.count(["feature"]) == 1
