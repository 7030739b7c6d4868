"""Flat tables of the output topics and the event topic, for display."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise import constants as K
from shelfwise import schemas
from shelfwise.streaming.events import event_time, parse


def output_messages(values: DataFrame) -> DataFrame:
    """Messages of the recommendation and metrics topics in one wide schema."""
    return parse(values, schemas.MESSAGE).filter(F.col("rejected").isNull()).drop("rejected")


def flatten_recommendations(messages: DataFrame) -> DataFrame:
    """One row per recommended product, absent fields filled in."""
    rec = F.col("rec")
    return (messages.filter(F.col("event_type") == K.RECOMMENDATION_MESSAGE)
            .select("*", F.posexplode("recommendations").alias("pos", "rec"))
            .select("event_id", _clock(), _user("Unknown"),
                    F.coalesce("viewed_product_name", F.lit("Unknown Product"))
                    .alias("viewed_product_name"),
                    F.coalesce("processing_time_ms", F.lit(0.0)).alias("processing_time_ms"),
                    F.coalesce("has_user_profile", F.lit(False)).alias("has_user_profile"),
                    F.coalesce("recommendation_count", F.lit(0)).alias("recommendation_count"),
                    (F.col("pos") + 1).alias("rank"),
                    F.coalesce(rec["name"], F.lit("Unknown")).alias("name"),
                    F.coalesce(rec["price"], F.lit(0.0)).alias("price"),
                    F.coalesce(rec["category"], F.lit("Unknown")).alias("category")))


def flatten_purchases(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("event_type") == K.PURCHASE_MESSAGE).select(
        "event_id", _clock(), _user("Unknown"),
        F.coalesce("product_name", F.lit("Unknown")).alias("product_name"),
        F.coalesce("price", F.lit(0.0)).alias("price"))


def flatten_metrics(messages: DataFrame) -> DataFrame:
    metrics = F.col("metrics")
    zero = {"precision": 0.0, "recall": 0.0, "f1": 0.0, "events_processed": 0,
            "events_per_second": 0.0, "active_user_sessions": 0}
    return messages.filter(F.col("event_type") == K.METRICS_MESSAGE).select(
        "event_id", _clock(), *[F.coalesce(metrics[n], F.lit(z)).alias(n) for n, z in zero.items()])


def flatten_events(events: DataFrame) -> DataFrame:
    """View and purchase events with their product, absent fields filled in."""
    product = F.col("product")
    return (events.filter(F.col("event_type").isin(K.VIEW_EVENT, K.PURCHASE_EVENT))
            .select("event_id", "event_type", _clock(), _user("Anonymous"),
                    F.coalesce(product["name"], F.lit("Unknown Product")).alias("product_name"),
                    F.coalesce(product["category"], F.lit("Unknown")).alias("category"),
                    F.coalesce(product["price"], F.lit(0.0)).alias("price")))


def message_rates(messages: DataFrame, seconds: float | None = None) -> DataFrame:
    """Messages per type, and per second when the runtime is given."""
    counted = messages.groupBy("event_type").agg(F.count("*").alias("messages"))
    if seconds is None:
        return counted
    return counted.withColumn("per_second", F.col("messages") / F.lit(float(seconds)))


def _clock():
    return F.date_format(event_time(F.col("timestamp")), "HH:mm:ss").alias("time")


def _user(default: str):
    return F.coalesce(F.col("user_id").cast("string"), F.lit(default)).alias("user")
