"""The recommender over a stream of messages, with restart-safe sinks.

Every micro-batch runs the same batch functions as a stored table would and writes each output
below ``batch_id=N``, replacing it when a batch is repeated: outputs stay exactly-once.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from shelfwise import constants as K
from shelfwise.operators import recommend as R
from shelfwise.operators.ordering import running_totals
from shelfwise.sources import readers, sinks
from shelfwise.sources.storage import lasting, make_folder, path_exists, temporary
from shelfwise.streaming import events as E, state as S


def write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def read_batches(spark: SparkSession, folder: str, schema, before: int | None = None):
    """All written batches, or those before one; an empty frame when there are none."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(folder)
    return df if before is None else df.filter(F.col("batch_id") < before)


@dataclass
class Recommender:
    """Routes message batches to recommendations, purchases, counters and rejects.

    A batch is scored once; messages and counters are read back from what it stored. It leaves one
    row per user and one per purchase for the second query, which keeps the state of the users and the
    running totals. So a batch costs what its own events cost, however many went before.
    """

    catalog: DataFrame
    out: str
    k: int = 5
    fill_key: Column | None = None
    # Called with message texts and a topic name after a batch is stored. A repeated batch calls
    # again: topics receive at least once, the stored tables hold exactly once.
    publish: Callable[[DataFrame, str], None] | None = None
    shelf: R.Shelf | None = None
    # Metrics messages at views whose zero-based position it divides; None: one per micro-batch.
    every: int | None = None
    ttl_ms: int | None = None
    accounts: bool = True  # run the second query
    recommend: bool = True  # without it only sessions and their purchases are kept
    mark: float = field(default_factory=time.monotonic)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One batch on its own: both steps, one after the other."""
        self.score(batch, batch_id)
        self.account_for_all()

    # ---- first query: score the events ----

    def score(self, batch: DataFrame, batch_id: int) -> None:
        with temporary(batch.sparkSession):
            self._score(batch, batch_id)

    def _score(self, batch: DataFrame, batch_id: int) -> None:
        parsed = E.parse(batch).persist()
        try:
            events = E.accepted(parsed)
            if not self.recommend:
                self._write(profiles_of(events), "profiles", batch_id)
                self._write(activity(events, batch.sparkSession.createDataFrame([], COUNTERS)), "activity", batch_id)
                return
            views = E.views(events)
            shelf, spark = self._shelf(), batch.sparkSession
            began, seen = time.perf_counter(), Observation()
            preferences = R.Preferences.of(views, self.catalog, shelf)
            recommended = R.recommend(views, self.catalog, self.k, self.fill_key, preferences,
                                      shelf)
            self._write(E.recommendation_messages(recommended, R.PREFERENCE).observe(
                seen, F.count("*").alias("n")), "recommendations", batch_id)
            spent = 1000 * (time.perf_counter() - began) / max(seen.get["n"], 1)
            self._write(one_row(spark, {"processing_time_ms": spent, "views": seen.get["n"]}, TIMINGS), "timings", batch_id)
            stored = self._batch(spark, "recommendations", batch_id).withColumn(
                "ts", E.event_time(F.col("timestamp")))
            totals = R.relevant_totals(preferences, self.catalog, shelf)
            self._write(R.event_counters(stored, totals), "counters", batch_id)
            self._write(E.purchase_messages(events), "purchases", batch_id)
            self._write(parsed.filter(F.col("rejected").isNotNull()).select("rejected"),
                        "rejects", batch_id)
            counters = self._batch(spark, "counters", batch_id)
            if self.every:
                self._write(events.select("event_id", "ts", "event_type").join(
                    counters.drop("user_id", "ts"), "event_id", "left"), "events", batch_id)
            if self.accounts:
                self._write(profiles_of(events), "profiles", batch_id)
                self._write(activity(events, counters), "activity", batch_id)
            if self.publish:
                texts = stored.drop("ts", *R.PREFERENCE).withColumn("processing_time_ms", F.lit(spent))
                self.publish(E.to_messages(texts), K.TOPIC_RECOMMENDATIONS)
                self.publish(E.to_messages(self._batch(spark, "purchases", batch_id)),
                             K.TOPIC_RECOMMENDATIONS)
        finally:
            parsed.unpersist()

    def _shelf(self) -> R.Shelf:
        """The static catalog's lists, made at the first batch."""
        if self.shelf is None:
            with lasting():
                self.shelf = R.Shelf.of(self.catalog, self.k, self.fill_key)
        return self.shelf

    def _write(self, df: DataFrame, table: str, batch_id: int) -> None:
        write_batch(df, f"{self.out}/{table}", batch_id)

    def _batch(self, spark: SparkSession, table: str, batch_id: int) -> DataFrame:
        return spark.read.parquet(f"{self.out}/{table}/batch_id={batch_id}")

    # ---- second query: state of the users and running totals ----

    def start_accounts(self, available_now: bool = False, interval: str = "10 seconds") -> StreamingQuery:
        spark = self.catalog.sparkSession
        make_folder(spark, f"{self.out}/activity")
        source = spark.readStream.schema(S.ACTIVITY).parquet(f"{self.out}/activity")
        trigger = {"availableNow": True} if available_now else {"processingTime": interval}
        with S.keyed_state(spark):
            return (S.session_changes(source, self.ttl_ms).writeStream.outputMode("update")
                    .foreachBatch(self.account).trigger(**trigger)
                    .option("checkpointLocation", f"{self.out}/_accounts").start())

    def account_for_all(self) -> None:
        """Bring totals and sessions up to date with all batches that are stored."""
        self.start_accounts(available_now=True).awaitTermination()

    def account(self, changes: DataFrame, batch_id: int) -> None:
        with temporary(changes.sparkSession):
            self._account(changes, batch_id)

    def _account(self, changes: DataFrame, batch_id: int) -> None:
        """Store what a step of the second query changes, and add it to the totals of the step before."""
        spark = changes.sparkSession
        self._write(changes.withColumnRenamed("batch_id", "stored_in"), "changes", batch_id)
        changes = self._batch(spark, "changes", batch_id)
        sums = changes.filter("kind = 'sums'")
        row = sums.agg(*[F.coalesce(s, F.lit(0)).cast("bigint").alias(n) for n, s in {
            "total_recommendations": F.sum("n_recs"), "relevant_recommendations": F.sum("n_relevant"),
            "relevant_products_recommended": F.sum("n_relevant_products"),
            "total_relevant_products": F.sum("total"), "events_processed": F.sum("n_events"),
            "active_user_sessions": F.count("session_start")}.items()]).first()
        self._write(one_row(spark, row.asDict()).select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("metric"), F.col(n).cast("bigint").alias("amount")) for n in row.asDict()])).alias("m"))
            .select("m.*"), "metrics", batch_id)
        before = self._totals(spark, batch_id - 1)
        now = time.monotonic()
        totals = {n: row[n] + before.get(n, 0) for n in METRIC_COLUMNS}
        totals["runtime_seconds"] = before.get("runtime_seconds", 0.0) + now - self.mark
        self.mark = now
        self._write(one_row(spark, totals, TOTALS), "totals", batch_id)
        self._write(changes.filter("kind = 'session'").select(
            "user_id", F.timestamp_micros("ts").alias("ts"), "event_id", F.col("session_batch").alias("stored_in")),
            "sessions", batch_id)
        self._write(changes.filter("kind = 'purchase'").select(
            "user_id", "session_event", "event_id", F.timestamp_micros("ts").alias("ts"), "product_id"),
            "session_purchases", batch_id)
        if self.every:
            self._write(self._updates(spark, sums, before, totals["runtime_seconds"]), "updates", batch_id)
        if self.publish:
            self.publish(E.to_messages(E.metrics_messages(
                self._batch(spark, "updates", batch_id) if self.every else totals_with_scores(
                    self._batch(spark, "totals", batch_id)))), K.TOPIC_METRICS)

    def _totals(self, spark: SparkSession, batch_id: int) -> dict:
        if batch_id < 0:
            return {}
        return self._batch(spark, "totals", batch_id).first().asDict()

    def _updates(self, spark: SparkSession, sums: DataFrame, before: dict, runtime: float) -> DataFrame:
        """The metrics messages due among the events of this step, in the order of batch, time and event."""
        batches = [r[0] for r in sums.select("stored_in").distinct().collect()]  # the batches of this step
        if not batches:
            return spark.createDataFrame([], UPDATES)
        events = spark.read.schema(EVENT_STEPS).parquet(f"{self.out}/events").filter(F.col("batch_id").isin(batches))
        starts = sums.filter("session_start IS NOT NULL").select(
            F.col("session_start").alias("event_id"), F.lit(1).cast("bigint").alias("_first_session"))
        firsts = sums.filter("total_start IS NOT NULL").select(F.col("total_start").alias("event_id"), "total")
        due = due_updates(events.join(starts, "event_id", "left").join(firsts, "event_id", "left"),
                          ["batch_id", "ts", "event_id"], self.every, before)
        per_second = F.col("events_processed") / F.lit(runtime)
        return due.withColumns({"runtime_seconds": F.lit(runtime), "events_per_second": per_second})

    def close(self) -> DataFrame:
        """The closing message: the totals after the last step. It is stored and published."""
        spark = self.catalog.sparkSession
        last = spark.read.schema(f"{TOTALS}, batch_id int").parquet(f"{self.out}/totals")
        row = last.orderBy(F.col("batch_id").desc()).limit(1)
        message = E.metrics_messages(totals_with_scores(row).withColumn("ts", F.current_timestamp()))
        message.write.mode("overwrite").parquet(f"{self.out}/closing")
        message = spark.read.parquet(f"{self.out}/closing")
        if self.publish:
            self.publish(E.to_messages(message), K.TOPIC_METRICS)
        return message

    def start(self, messages: DataFrame, checkpoint: str, available_now: bool = False,
              interval: str = "10 seconds") -> Running:
        trigger = {"availableNow": True} if available_now else {"processingTime": interval}
        self.mark = time.monotonic()
        progress = Progress()
        messages.sparkSession.streams.addListener(progress)
        observed = messages.observe("arrived", F.count("*").alias("messages"))
        scoring = (observed.writeStream.foreachBatch(self.score).trigger(**trigger)
                   .option("checkpointLocation", checkpoint).start())
        progress.query_id = str(scoring.id)
        live = self.accounts and not available_now
        return Running(self, scoring, self.start_accounts(interval=interval) if live else None, progress)


def timed_recommendations(spark: SparkSession, out: str) -> DataFrame:
    """The stored recommendation messages with the time their batch took per view."""
    times = spark.read.schema(f"{TIMINGS}, batch_id int").parquet(f"{out}/timings")
    recs = spark.read.parquet(f"{out}/recommendations").drop(*R.PREFERENCE)
    return recs.join(times.drop("views"), "batch_id").drop("batch_id")


def run_on_topics(engine: Recommender, servers: str, checkpoint: str, interval: str = "10 seconds",
                  max_offsets: int | None = None) -> Running:
    """Run a recommender between topics: events come from one, recommendations, purchases and metrics go to two others."""
    spark = engine.catalog.sparkSession
    engine.publish = lambda messages, topic: sinks.write_topic(messages, servers, topic)
    messages = readers.stream_topics(spark, readers.kafka_options(servers, [K.TOPIC_EVENTS], max_offsets=max_offsets))
    return engine.start(messages, checkpoint, interval=interval)


class Progress(StreamingQueryListener):
    """What the stream itself reports per batch: messages, rows per second and time."""

    def __init__(self) -> None:
        self.query_id: str | None = None
        self.rows: list[tuple] = []
        self.over = threading.Event()  # reports arrive after the batches they are about

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        arrived = p.observedMetrics.get("arrived")
        if arrived is not None and self.query_id in (None, str(p.id)):
            self.rows.append((int(p.batchId), int(arrived["messages"]), float(p.processedRowsPerSecond),
                              float(p.durationMs.get("triggerExecution", 0))))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.query_id == str(event.id):
            self.over.set()


@dataclass
class Running:
    """Both queries of a started recommender."""

    engine: Recommender
    scoring: StreamingQuery
    accounts: StreamingQuery | None
    progress: Progress

    def awaitTermination(self, timeout: float | None = None) -> None:
        """Until the stream ends; then the accounts are brought up to date and the closing message is sent."""
        self.scoring.awaitTermination(timeout)
        if timeout is None or not self.scoring.isActive:
            self._finish()

    def stop(self) -> None:
        self.scoring.stop()
        self._finish()

    def _finish(self) -> None:
        if self.accounts is not None:
            self.accounts.processAllAvailable()
            self.accounts.stop()
            self.accounts = None
        if self.engine.accounts:
            self.engine.account_for_all()
        if self.engine.accounts and path_exists(self.engine.catalog.sparkSession, f"{self.engine.out}/totals"):
            self.engine.close()
        self.progress.over.wait(60)
        self.engine.catalog.sparkSession.streams.removeListener(self.progress)

    def progress_rows(self) -> DataFrame:
        """batch_id, messages, rows_per_second, milliseconds: one row per batch of this run."""
        return self.engine.catalog.sparkSession.createDataFrame(
            list(self.progress.rows), "batch_id bigint, messages bigint, rows_per_second double, milliseconds double")


def activity(events: DataFrame, counters: DataFrame) -> DataFrame:
    """What a batch says about its users: one row per user, however many events it has, and its purchases.

    Purchases up to the user's last view in the batch are left out, since they are behind no session.
    """
    micros = F.unix_micros("ts")
    views = events.filter((F.col("event_type") == K.VIEW_EVENT) & F.col("user_id").isNotNull()
                          & F.col("user_profile").isNotNull())
    at = F.struct(micros.alias("ts"), "event_id")
    seen = views.groupBy("user_id").agg(F.min(at).alias("first"), F.max(at).alias("last"))
    counted = counters.withColumn("at", at).groupBy("user_id").agg(
        *[F.sum(n).alias(n) for n in ("n_recs", "n_relevant", "n_relevant_products")],
        F.min_by(F.struct("at", "relevant_products"), F.when(F.col("relevant_products") > 0, F.col("at"))).alias("t"))
    per_user = events.groupBy("user_id").agg(F.count("*").alias("n_events"))
    known = per_user.join(seen, "user_id", "left").join(counted, "user_id", "left")  # a NULL user joins nothing
    none = F.lit(None).cast("bigint")
    sums = known.select(
        F.lit("sums").alias("kind"), "user_id", "n_events", "n_recs", "n_relevant", "n_relevant_products",
        F.col("first.ts").alias("first_ts"), F.col("first.event_id").alias("first_event"),
        F.col("last.ts").alias("last_ts"), F.col("last.event_id").alias("last_event"),
        F.col("t.at.ts").alias("total_ts"), F.col("t.at.event_id").alias("total_event"),
        F.col("t.relevant_products").alias("total"),
        *[none.alias(n) for n in ("ts", "event_id", "product_id")])
    bought = events.filter((F.col("event_type") == K.PURCHASE_EVENT) & F.col("user_id").isNotNull()
                           & F.col("product.id").isNotNull()).select(
        F.lit("purchase").alias("kind"), "user_id",
        *[none.alias(n) for n in sums.columns[2:-3]], micros.alias("ts"), "event_id",
        F.col("product.id").alias("product_id"))
    zero = F.lit(0).cast("bigint")
    ahead = F.struct(F.coalesce("ts", zero), F.coalesce("event_id", zero)) > F.struct(
        F.coalesce("last.ts", zero), F.col("last.event_id"))  # as the state compares them
    # Spark itself splits the purchases of a hot user, whom the other side has once
    bought = bought.join(seen, "user_id", "left").filter(F.col("last.event_id").isNull() | ahead).select(*sums.columns)
    return sums.unionByName(bought)


def profiles_of(events: DataFrame) -> DataFrame:
    """(user_id, event_id, ts, profile) of each user's last view with a profile in a batch."""
    views = events.filter((F.col("event_type") == K.VIEW_EVENT) & F.col("user_id").isNotNull()
                          & F.col("user_profile").isNotNull())
    last = views.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("l"))
    return views.join(last, "user_id").where(F.struct("ts", "event_id") == F.col("l")).select(
        "user_id", "event_id", "ts", E.profile_with_defaults(F.col("user_profile")).alias("profile"))


def stored_sessions(spark: SparkSession, out: str) -> DataFrame:
    """(user_id, ts, event_id, profile): the sessions as the state of a recommender has them.

    The state names the batch and event of a session; the profile is read where that batch stored it.
    """
    changes = spark.read.schema("user_id bigint, ts timestamp, event_id bigint, stored_in bigint, batch_id int").parquet(
        f"{out}/sessions")
    newest = changes.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "stored_in")).alias("s")).select("user_id", "s.*")
    profiles = spark.read.parquet(f"{out}/profiles").select(
        "user_id", "event_id", F.col("batch_id").cast("bigint").alias("stored_in"), "profile")
    return newest.join(profiles, ["user_id", "event_id", "stored_in"]).select("user_id", "ts", "event_id", "profile")


def stored_session_purchases(spark: SparkSession, out: str) -> DataFrame:
    """(user_id, event_id, ts, product_id) of the purchases in each user's session."""
    changes = spark.read.parquet(f"{out}/sessions").groupBy("user_id").agg(
        F.max(F.struct("ts", "event_id")).alias("s")).select("user_id", F.col("s.event_id").alias("session_event"))
    bought = spark.read.parquet(f"{out}/session_purchases").drop("batch_id").distinct()
    return bought.join(changes, ["user_id", "session_event"], "left_semi").drop("session_event")


METRIC_COLUMNS = [*R.COUNTERS, "events_processed", "active_user_sessions"]
TOTALS = ", ".join(f"{c} bigint" for c in METRIC_COLUMNS) + ", runtime_seconds double"
COUNTERS = ("event_id bigint, user_id bigint, ts timestamp, n_recs bigint, n_relevant bigint, "
            "n_relevant_products bigint, relevant_products bigint")
EVENT_STEPS = ("event_id bigint, ts timestamp, event_type string, n_recs bigint, n_relevant bigint, "
               "n_relevant_products bigint, relevant_products bigint, batch_id int")
UPDATES = ("event_id bigint, ts timestamp, " + ", ".join(f"{c} bigint" for c in METRIC_COLUMNS)
           + ", precision double, recall double, f1 double, runtime_seconds double, events_per_second double")


TIMINGS = "processing_time_ms double, views bigint"


def one_row(spark: SparkSession, values: dict, schema: str = "") -> DataFrame:
    """A single row of plain values; ``schema`` gives their types."""
    kinds = dict(part.split() for part in schema.split(", ")) if schema else {}
    return spark.range(1).select(*[F.lit(v).cast(kinds[n]).alias(n) if n in kinds else F.lit(v).alias(n)
                                   for n, v in values.items()])


def totals_with_scores(totals: DataFrame) -> DataFrame:
    """Totals with precision, recall, F1 and the events per second of the run time."""
    return R.with_scores(totals).withColumn("events_per_second", F.when(
        F.col("runtime_seconds") > 0, F.col("events_processed") / F.col("runtime_seconds")).otherwise(0.0))


def cumulative_metrics(steps: DataFrame) -> DataFrame:
    """Metrics after all batches, from the steps written per batch."""
    return R.with_scores(steps.agg(*[
        F.coalesce(F.sum(F.when(F.col("metric") == c, F.col("amount"))), F.lit(0))
        .cast("bigint").alias(c) for c in METRIC_COLUMNS]))


def with_runtime(metrics: DataFrame, seconds: float) -> DataFrame:
    """Add runtime_seconds and events_per_second, as the closing metrics message carries them."""
    per_second = F.col("events_processed") / F.lit(float(seconds)) if seconds > 0 else F.lit(0.0)
    return metrics.withColumns({"runtime_seconds": F.lit(float(seconds)),
                                "events_per_second": per_second})


def every_tenth(events: DataFrame, counters: DataFrame, every: int = 10) -> DataFrame:
    """The metrics messages of a replay in (ts, event_id) order.

    A message follows each view at a zero-based position divisible by ``every``. It includes that
    view's recommendations, and reports the position as events processed. ``events`` has event_id,
    ts, user_id, event_type and has_user_profile; ``counters`` one row per scored view.
    """
    first_total = counters.filter(F.col("relevant_products") > 0).groupBy("user_id").agg(
        F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id")).select(
        "event_id", F.lit(1).alias("_first_total"))
    sessions = (events.filter((F.col("event_type") == K.VIEW_EVENT) & F.col("has_user_profile"))
                .groupBy("user_id").agg(F.min_by("event_id", F.struct("ts", "event_id"))
                                        .alias("event_id"))
                .select("event_id", F.lit(1).cast("bigint").alias("_first_session")))
    # Joins on the unique event id: no key can be hot.
    marked = (events.select("event_id", "ts", "event_type")
              .join(counters.drop("user_id", "ts"), "event_id", "left")
              .join(first_total, "event_id", "left").join(sessions, "event_id", "left"))

    return due_updates(marked.withColumn("total", F.when(F.col("_first_total") == 1, F.col("relevant_products"))),
                       ["ts", "event_id"], every, {})


def due_updates(marked: DataFrame, order: list[str], every: int, before: dict) -> DataFrame:
    """The updates due among events in an order, after the totals of ``before``.

    ``marked`` has event_id, ts, event_type, the counters of scored views, and at a user's first event of the
    kind ``_first_session`` and the ``total`` of relevant products.
    """
    def or_zero(column: Column) -> Column:
        return F.coalesce(column, F.lit(0).cast("bigint"))

    running = running_totals(marked.select(
        *dict.fromkeys([*order, "event_id", "ts"]), "event_type", "n_recs", "n_relevant", "n_relevant_products",
        "total", "_first_session"), order, {
            "total_recommendations": or_zero(F.col("n_recs")),
            "relevant_recommendations": or_zero(F.col("n_relevant")),
            "total_relevant_products": or_zero(F.col("total")),
            "relevant_products_recommended": or_zero(F.col("n_relevant_products")),
            "active_user_sessions": or_zero(F.col("_first_session")),
            "events_processed": F.lit(1).cast("bigint")})
    running = running.withColumns({c: F.col(c) + F.lit(int(before.get(c, 0))) for c in METRIC_COLUMNS})
    position = F.col("events_processed") - 1
    due = running.filter((F.col("event_type") == K.VIEW_EVENT) & (F.pmod(position, F.lit(every))
                                                                  == 0))
    return R.with_scores(due.withColumn("events_processed", position)).select(
        "event_id", "ts", *METRIC_COLUMNS, "precision", "recall", "f1")


# ---- views on stored recommendations ----

def start_newest(recommended: DataFrame, out: str, checkpoint: str, max_age_minutes: float = 5,
                 available_now: bool = False) -> StreamingQuery:
    """Keep each user's newest recommendations; a row goes stale by the time of other users' events.

    ``recommended`` is a stream of stored recommendation messages. Each batch writes the users it changed.
    """
    rows = recommended.select("event_id", E.event_time(F.col("timestamp")).alias("ts"), "user_id", F.array_join(
        F.transform("recommendations", lambda r: r["id"].cast("string")), ",").alias("ids"))
    trigger = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    with S.keyed_state(recommended.sparkSession):
        return (S.newest_changes(rows, max_age_minutes).writeStream.outputMode("update").trigger(**trigger)
                .option("checkpointLocation", checkpoint)
                .foreachBatch(lambda df, n: write_batch(df, out, n)).start())


def newest_of(changes: DataFrame) -> DataFrame:
    """(user_id, event_id, ts, ids, is_stale): each user's last change."""
    last = changes.groupBy("user_id").agg(F.max(F.struct("at", "event_id", "is_stale", "ids")).alias("c"))
    return last.select("user_id", "c.event_id", F.timestamp_micros("c.at").alias("ts"), "c.ids", "c.is_stale")


def latest_recommendations(recommended: DataFrame, as_of: Column,
                           max_age: str = "5 minutes") -> DataFrame:
    """Each user's newest recommendations, marked stale when older than ``max_age``."""
    newest = recommended.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.max_by(F.struct("event_id", "ts", "recommendations"), F.struct("ts", "event_id"))
        .alias("r")).select("user_id", "r.*")
    return newest.withColumn("is_stale", as_of - F.col("ts") > F.expr(f"INTERVAL {max_age}"))


def since(events: DataFrame, start: Column) -> DataFrame:
    """Stored events from a point in time on, for replay."""
    return events.filter(F.col("ts") >= start)


def with_variant(df: DataFrame, salt: str = "", share: int = 50) -> DataFrame:
    """Split users between two recommenders: ``share`` percent get variant A."""
    bucket = F.pmod(F.xxhash64(F.lit(salt), F.col("user_id")), F.lit(100))
    return df.withColumn("variant", F.when(bucket < share, "A").otherwise("B"))
