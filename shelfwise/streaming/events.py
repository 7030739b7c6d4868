"""Event messages: building, parsing, routing, and the messages they lead to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise import schemas
from shelfwise.operators.history import positions, with_histories
from shelfwise.operators.joins import lookup_join
from shelfwise.operators.recommend import preference_columns


def epoch_seconds(ts: Column) -> Column:
    """A timestamp as the messages carry it: seconds since 1970 as a double."""
    return F.unix_micros(ts.cast("timestamp")).cast("double") / F.lit(1e6)


def event_time(seconds: Column) -> Column:
    """The timestamp of a message, to the microsecond."""
    return F.timestamp_micros(F.round(seconds * 1e6).cast("bigint"))


def build_events(events: DataFrame, catalog: DataFrame, profiles: DataFrame) -> DataFrame:
    """Events with their product and the user's profile and history as of the event.

    ``events``: event_id, ts, user_id, event_type, product_id. Users without a profile (or NULL)
    get a NULL profile. The result has the columns of the event message.
    """
    product = catalog.select(F.col("id").alias("product_id"), F.struct(
        "id", "name", "category", "price", "description").alias("product"))
    anonymous = events.filter(F.col("user_id").isNull()).withColumns({
        "views_before": F.lit(0).cast("bigint"), "purchases_before": F.lit(0).cast("bigint"),
        "viewing_history": F.lit(None).cast("array<bigint>"),
        "purchase_history": F.lit(None).cast("array<bigint>")})
    known = with_histories(positions(events)).unionByName(anonymous)
    joined = lookup_join(known, product, "product_id", "inner", spread=["event_id"],
                         keys_from=events)
    joined = lookup_join(joined, profiles.withColumn("_known", F.lit(True)), "user_id", "left",
                         spread=["event_id"], keys_from=events)
    profile = F.struct("preferred_categories", "preferred_features", "price_sensitivity",
                       "viewing_history", "purchase_history", "views_before",
                       "purchases_before")
    return joined.select("event_id", "event_type", epoch_seconds(F.col("ts")).alias("timestamp"),
                         "user_id", "product_id", "product",
                         F.when(F.col("_known"), profile).alias("user_profile"))


def to_messages(df: DataFrame) -> DataFrame:
    """Rows as JSON texts in a single column ``value``."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def parse(messages: DataFrame, schema: str = schemas.EVENT) -> DataFrame:
    """Message texts parsed; ``rejected`` holds the text of a message that is no JSON object."""
    parsed = messages.select("value", F.from_json(
        "value", f"{schema}, _corrupt string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("e"))
    bad = F.col("e").isNull() | F.col("e._corrupt").isNotNull()
    return parsed.select("e.*", F.when(bad, F.col("value")).alias("rejected")).drop("_corrupt")


def accepted(parsed: DataFrame) -> DataFrame:
    return (parsed.filter(F.col("rejected").isNull()).drop("rejected")
            .withColumn("ts", event_time(F.col("timestamp"))))


def views(events: DataFrame) -> DataFrame:
    """View events as the recommender takes them; a profile counts when the user is known."""
    profile = F.col("user_profile")
    return (events.filter(F.col("event_type") == K.VIEW_EVENT)
            .withColumn("has_user_profile", profile.isNotNull() & F.col("user_id").isNotNull())
            .select("event_id", "ts", "user_id", F.col("product.id").alias("product_id"),
                    F.col("product.name").alias("product_name"),
                    F.col("product.category").alias("category"), "has_user_profile",
                    *[c.alias(n) for n, c in preference_columns(
                        profile["preferred_categories"], profile["preferred_features"]).items()]))


def profile_with_defaults(profile: Column) -> Column:
    """A profile with empty lists and medium price sensitivity where fields are absent."""
    none = F.array()
    return F.when(profile.isNotNull(), F.struct(
        F.coalesce(profile["preferred_categories"], none.cast("array<string>"))
        .alias("preferred_categories"),
        F.coalesce(profile["preferred_features"], none.cast("array<string>"))
        .alias("preferred_features"),
        F.coalesce(profile["price_sensitivity"], F.lit(0.5)).alias("price_sensitivity"),
        F.coalesce(profile["viewing_history"], none.cast("array<bigint>"))
        .alias("viewing_history"),
        F.coalesce(profile["purchase_history"], none.cast("array<bigint>"))
        .alias("purchase_history"),
        F.coalesce(profile["views_before"], F.lit(0).cast("bigint")).alias("views_before"),
        F.coalesce(profile["purchases_before"], F.lit(0).cast("bigint"))
        .alias("purchases_before")))


def recommendation_messages(recommended: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    return recommended.select(
        "event_id", F.lit(K.RECOMMENDATION_MESSAGE).alias("event_type"),
        epoch_seconds(F.col("ts")).alias("timestamp"), "user_id",
        F.col("product_id").alias("viewed_product_id"),
        F.col("product_name").alias("viewed_product_name"), "recommendations",
        F.size("recommendations").alias("recommendation_count"), "has_user_profile", *more)


def purchase_messages(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == K.PURCHASE_EVENT).select(
        "event_id", F.lit(K.PURCHASE_MESSAGE).alias("event_type"), "timestamp", "user_id",
        F.col("product.id").alias("product_id"), F.col("product.name").alias("product_name"),
        F.coalesce(F.col("product.price"), F.lit(0.0)).alias("price"))


def metrics_messages(metrics: DataFrame) -> DataFrame:
    """Metrics rows as messages; runtime fields stay NULL unless the rows carry them."""
    fields = ("precision double, recall double, f1 double, total_recommendations bigint, "
              "relevant_recommendations bigint, total_relevant_products bigint, "
              "runtime_seconds double, events_processed bigint, events_per_second double, "
              "active_user_sessions bigint")
    columns = []
    for field in fields.split(", "):
        name, kind = field.split()
        value = F.col(name) if name in metrics.columns else F.lit(None)
        columns.append(value.cast(kind).alias(name))
    stamp = (epoch_seconds(F.col("ts")) if "ts" in metrics.columns
             else F.lit(None).cast("double"))
    keep = ["event_id"] if "event_id" in metrics.columns else []
    return metrics.select(*keep, F.lit(K.METRICS_MESSAGE).alias("event_type"),
                          stamp.alias("timestamp"), F.struct(*columns).alias("metrics"))


def normalise_web_events(raw: DataFrame, catalog: DataFrame, profiles: DataFrame) -> DataFrame:
    """Web events (eventId, userId, eventType, productId, timestamp text, metadata) as engine events.

    ``metadata``, a map of texts, is carried as it came; events without one get an empty map.
    """
    kinds = {"product_view": K.VIEW_EVENT, "purchase": K.PURCHASE_EVENT}
    kind = F.col("eventType")
    for web, ours in kinds.items():
        kind = F.when(F.col("eventType") == web, F.lit(ours)).otherwise(kind)
    events = raw.select(
        F.col("eventId").alias("event_id"), F.col("timestamp").try_cast("timestamp").alias("ts"),
        F.col("userId").alias("user_id"), kind.alias("event_type"),
        F.col("productId").alias("product_id"))
    built = build_events(events, catalog, profiles)
    if "metadata" not in raw.columns:
        return built
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    more = raw.select(F.col("eventId").alias("event_id"), F.coalesce("metadata", none).alias("metadata"))
    return built.join(more, "event_id")  # ids of events are unique: no key can be hot
