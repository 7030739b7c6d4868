"""Recommendation and scoring queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.operators import history as H, recommend as R
from shelfwise.plans.adapters import Tables
from shelfwise.plans.oracle_tables import F1, SCORES, scored, with_tables
from shelfwise.plans.registry import query

K_RECS = 5


def prepared(t: Tables) -> tuple[DataFrame, DataFrame, R.Preferences]:
    """Views, catalog, and the distinct preferences with their feature matches."""
    views, catalog = t.views(), t.catalog()
    return views, catalog, R.Preferences.of(views, catalog)


def recommended(t: Tables) -> DataFrame:
    views, catalog, preferences = prepared(t)
    return R.recommend(views, catalog, K_RECS, t.fill_key(), preferences)


def counters(t: Tables) -> DataFrame:
    views, catalog, preferences = prepared(t)
    recs = R.recommend(views, catalog, K_RECS, t.fill_key(), preferences)
    return R.event_counters(recs, R.relevant_totals(preferences, catalog))


@query("recommend_category", with_tables("views products", """
    SELECT event_id, CAST(r AS INTEGER) AS rank, id, name, category, price, name AS description,
           CAST(tier AS INTEGER) AS tier FROM (
      SELECT v.event_id, p.*, CASE WHEN p.category = v.category THEN 3 ELSE 4 END AS tier,
        row_number() OVER (PARTITION BY v.event_id
          ORDER BY CASE WHEN p.category = v.category THEN 3 ELSE 4 END,
            CASE WHEN p.category = v.category THEN p.id ELSE (p.id * 7919 + 17) % 1000003 END)
          AS r
      FROM d_views v JOIN d_products p ON p.id <> v.product_id) WHERE r <= 3"""))
def recommend_category(t: Tables) -> DataFrame:
    return R.exploded(R.category_recommend(t.views(), t.catalog(), 3, t.fill_key()))


@query("recommend_profile", with_tables("view_recs", """
    SELECT event_id, rank, id, name, rec_category AS category, price, name AS description,
           CAST(tier AS INTEGER) AS tier FROM d_view_recs"""))
def recommend_profile(t: Tables) -> DataFrame:
    return R.exploded(recommended(t))


@query("recommend_seeded")
def recommend_seeded(t: Tables) -> DataFrame:
    """With the library's own fill order, which SQL engines do not share."""
    views, catalog, preferences = prepared(t)
    return R.exploded(R.recommend(views, catalog, 3, R.seeded_fill(7), preferences))


@query("recommend_seeded_holds", with_tables("views", """
    SELECT event_id, true AS complete, true AS others, true AS by_tier, true AS repeatable
    FROM d_views"""))
def recommend_seeded_holds(t: Tables) -> DataFrame:
    """What holds for any fill order: three distinct other products in the order of their tiers."""
    views, catalog, preferences = prepared(t)
    one, two = (R.recommend(views, catalog, 3, R.seeded_fill(7), preferences) for _ in range(2))
    again = two.select("event_id", F.col("recommendations").alias("again"))
    ids = F.transform("recommendations", lambda r: r["id"])
    tiers = F.transform("recommendations", lambda r: r["tier"])
    viewed = views.select("event_id", F.col("product_id").alias("viewed"))
    return one.join(again, "event_id").join(viewed, "event_id").select(
        "event_id", (F.size(F.array_distinct(ids)) == 3).alias("complete"),
        (~F.array_contains(ids, F.col("viewed"))).alias("others"),
        (tiers == F.array_sort(tiers)).alias("by_tier"),
        (F.col("recommendations") == F.col("again")).alias("repeatable"))


@query("feature_matches", with_tables("profiles products", """
    SELECT DISTINCT lower(f) AS feature, p.id FROM (SELECT unnest(feats) AS f FROM d_profiles)
    JOIN d_products p ON contains(p.name, lower(f))"""))
def feature_matches(t: Tables) -> DataFrame:
    features = t.profiles().select(
        F.explode("preferred_features").alias("f")).select(F.lower("f").alias("feature"))
    return R.feature_matches(t.catalog(), features.distinct()).select("feature", "id")


@query("rec_relevance", with_tables("views profiles relevant", """
    SELECT DISTINCT cats[1] || '+' || cats[2] AS shown, feats[1] || '+' || lower(feats[2])
      AS features, relevant_products
    FROM (SELECT user_id, list_sort(cats) AS cats, feats FROM d_profiles)
    JOIN d_relevant USING (user_id)
    WHERE user_id IN (SELECT user_id FROM d_views)"""))
def rec_relevance(t: Tables) -> DataFrame:
    """Relevant products per distinct set of preferences."""
    views, catalog, preferences = prepared(t)
    # Features are sorted in a set; the first words are told apart from word parts by length or
    # membership, so the rendering restores (word, part).
    from shelfwise.plans.adapters import FIRST_WORDS
    word = F.filter("features", lambda f: f.isin(*FIRST_WORDS))[0]
    part = F.filter("features", lambda f: ~f.isin(*FIRST_WORDS))[0]
    return R.relevant_totals(preferences, catalog).select(
        F.array_join("categories", "+").alias("shown"),
        F.concat(word, F.lit("+"), part).alias("features"), "relevant_products")


@query("rec_event_counters", with_tables("counters", """
    SELECT event_id, user_id, n_recs, n_relevant, n_relevant AS n_relevant_products,
           relevant_products FROM d_counters"""))
def rec_event_counters(t: Tables) -> DataFrame:
    return counters(t).drop("ts")


@query("rec_metrics_user", with_tables("user_counters", scored("SELECT * FROM d_user_counters")))
def rec_metrics_user(t: Tables) -> DataFrame:
    return R.user_metrics(counters(t))


_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in R.COUNTERS)


@query("rec_metrics_global", with_tables(
    "user_counters", scored(f"SELECT {_SUMS} FROM d_user_counters")))
def rec_metrics_global(t: Tables) -> DataFrame:
    return R.global_metrics(counters(t))


@query("rec_recall_distinct", with_tables("view_recs relevant", """
    SELECT user_id, any_value(relevant_products) AS relevant,
      count(DISTINCT id) FILTER (tier <= 2) AS distinct_relevant,
      CASE WHEN any_value(relevant_products) > 0 THEN
        CAST(count(DISTINCT id) FILTER (tier <= 2) AS DOUBLE) / any_value(relevant_products)
        ELSE 0.0 END AS recall
    FROM d_view_recs JOIN d_relevant USING (user_id) WHERE has_user_profile GROUP BY 1"""))
def rec_recall_distinct(t: Tables) -> DataFrame:
    views, catalog, preferences = prepared(t)
    recs = R.recommend(views, catalog, K_RECS, t.fill_key(), preferences)
    return R.distinct_recall(recs, R.relevant_totals(preferences, catalog))


@query("ab_split_metrics", with_tables("user_counters", f"""
    SELECT *, {F1} FROM (SELECT *, {SCORES} FROM (
      SELECT CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS variant, {_SUMS}
      FROM d_user_counters GROUP BY 1))"""))
def ab_split_metrics(t: Tables) -> DataFrame:
    variant = F.when(F.col("user_id") % 2 == 0, "A").otherwise("B")
    return R.global_metrics(counters(t).withColumn("variant", variant), ["variant"])


@query("ab_split_hashed")
def ab_split_hashed(t: Tables) -> DataFrame:
    """The same with the library's own hashed split."""
    from shelfwise.streaming.replay import with_variant
    return R.global_metrics(with_variant(counters(t), "round 1"), ["variant"])


@query("ab_split_holds", with_tables("user_counters", f"""
    SELECT {_SUMS}, true AS both_variants, true AS share_near_half FROM d_user_counters"""))
def ab_split_holds(t: Tables) -> DataFrame:
    """The hashed split loses nobody: its variants add up to the whole, and each has its share."""
    from shelfwise.streaming.replay import with_variant
    counted = counters(t)
    split = with_variant(counted, "round 1")
    users = split.select("user_id", "variant").distinct().agg(
        F.countDistinct("user_id").alias("users"), F.count("*").alias("places"),
        F.count_if(F.col("variant") == "A").alias("a"))
    sums = R.global_metrics(split, ["variant"]).agg(
        *[F.sum(c).alias(c) for c in R.COUNTERS], F.countDistinct("variant").alias("variants"))
    return sums.join(users).select(  # one row each
        *R.COUNTERS, ((F.col("variants") == 2) & (F.col("users") == F.col("places"))).alias("both_variants"),
        (F.abs(F.col("a") / F.col("users") - 0.5) < 0.25).alias("share_near_half"))


@query("user_history_asof", with_tables("engine_events", """
    SELECT event_id, user_id, event_type, product_id,
      count(*) FILTER (event_type = 'product_view') OVER w AS views_before,
      count(*) FILTER (event_type = 'product_purchase') OVER w AS purchases_before
    FROM d_engine_events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""))
def user_history_asof(t: Tables) -> DataFrame:
    return H.positions(t.engine_events()).drop("ts")


@query("user_history_entries", with_tables("engine_events", """
    SELECT user_id, event_type, product_id, row_number() OVER (
      PARTITION BY user_id, event_type ORDER BY ts, event_id) AS seq
    FROM d_engine_events WHERE event_type IN ('product_view', 'product_purchase')"""))
def user_history_entries(t: Tables) -> DataFrame:
    return H.entries(H.positions(t.engine_events()))


def _listed(kind: str) -> str:
    return f"""coalesce(array_to_string(list(product_id) FILTER (event_type = '{kind}')
        OVER w, ','), '')"""


_HISTORIES = f"""SELECT event_id, user_id, {_listed('product_view')} AS viewed,
      {_listed('product_purchase')} AS bought
    FROM d_engine_events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@query("user_history_embedded", with_tables("engine_events", _HISTORIES))
def user_history_embedded(t: Tables) -> DataFrame:
    return H.with_histories(H.positions(t.engine_events())).select(
        "event_id", "user_id", F.array_join("viewing_history", ",").alias("viewed"),
        F.array_join("purchase_history", ",").alias("bought"))
