"""Event-stream queries: messages are written as files and replayed to the end."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.operators import recommend as R
from shelfwise.operators.joins import partitions
from shelfwise.plans import recommending
from shelfwise.plans.adapters import Tables
from shelfwise.plans.oracle_tables import F1, SCORES, scored, with_tables
from shelfwise.plans.registry import query
from shelfwise.sources import readers
from shelfwise.sources.storage import cut_lineage, new_path
from shelfwise.streaming import events as E, monitor as M, replay as S

K_RECS = 5
LANDED_FILES = 24
PRODUCTS_PER_FILE = 50_000
REPLAY_START = "2024-01-15 00:00:00"
AS_OF = "2024-01-28 00:00:00"


def built(t: Tables) -> DataFrame:
    return E.build_events(t.engine_events(), t.catalog(), t.profiles())


def messages(t: Tables) -> DataFrame:
    """The event messages, and one broken message per error event."""
    broken = t.raw("events").filter(F.col("event_type") == "error").select(F.concat(
        F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "event_type": "pro'))
        .alias("value"))
    return E.to_messages(built(t)).unionByName(broken)


def message_files(t: Tables) -> str:
    """The messages in no order. More of them make larger files and not more, so that a trigger takes its share of them."""
    path = new_path(t.spark, "messages")
    messages(t).coalesce(LANDED_FILES).write.text(path)
    return path


def catalog(t: Tables) -> DataFrame:
    """The catalog, written in as many files as its rows are worth tasks; the bytes of a given file make few."""
    products = t.catalog()
    files = min(partitions(products), -(-t.products_count() // PRODUCTS_PER_FILE))
    return cut_lineage(products.repartition(files, "id") if files > 1 else products)


def replayed(t: Tables, files_per_trigger: int = 16, accounts: bool = False, every: int | None = None,
             source: str | None = None, recommend: bool = True) -> str:
    """Run the recommender over all messages; returns the folder of its outputs."""
    base = new_path(t.spark, "replay")
    stream = readers.stream_text_files(t.spark, source or message_files(t), files_per_trigger)
    S.Recommender(catalog(t), f"{base}/out", K_RECS, t.fill_key(), every=every, accounts=accounts,
                  recommend=recommend).start(
        stream, f"{base}/checkpoint", available_now=True).awaitTermination()
    return f"{base}/out"


SLICES, SLICE_FILES = 4, 4


def ordered_files(t: Tables) -> str:
    """The event messages landed in the order of their time: SLICES batches of SLICE_FILES files each."""
    path = new_path(t.spark, "ordered")
    for part in slices(t):  # files are read in the order of their writing
        land(part, path)
    return path


def output(t: Tables, folder: str, table: str) -> DataFrame:
    return t.spark.read.parquet(f"{folder}/{table}")


def slices(t: Tables) -> list[DataFrame]:
    rows = cut_lineage(built(t))
    low, high = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    place = F.least(F.floor((F.col("timestamp") - low) / F.lit((high - low) / SLICES)), F.lit(SLICES - 1))
    return [rows.filter(place == n) for n in range(SLICES)]


def land(part: DataFrame, path: str) -> None:
    E.to_messages(part).repartition(SLICE_FILES).write.mode("append").text(path)


_SECONDS = "CAST(epoch_us({c}) AS DOUBLE) / CAST(1000000 AS DOUBLE)"


def _history(kind: str) -> str:
    return f"""coalesce(array_to_string(list(product_id) FILTER (event_type = '{kind}')
        OVER w, ','), '')"""


_BUILT = f"""SELECT e.event_id, e.event_type, e.ts, {_SECONDS.format(c='e.ts')} AS timestamp,
    e.user_id, e.product_id, p.name AS product_name, p.category AS product_category, p.price,
    f.user_id IS NOT NULL AS has_profile, array_to_string(f.cats, ',') AS categories,
    array_to_string(f.feats, ',') AS features, CASE WHEN f.user_id IS NOT NULL THEN viewed END
    AS viewed, CASE WHEN f.user_id IS NOT NULL THEN bought END AS bought
  FROM (SELECT *, {_history('product_view')} AS viewed, {_history('product_purchase')} AS bought
        FROM d_engine_events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) e
  JOIN d_products p ON p.id = e.product_id LEFT JOIN d_profiles f USING (user_id)"""


@query("stream_events_build", with_tables(
    "engine_events products profiles", f"SELECT * EXCLUDE (ts) FROM ({_BUILT})"))
def stream_events_build(t: Tables) -> DataFrame:
    """Events built, written as JSON texts and parsed again."""
    parsed = E.accepted(E.parse(E.to_messages(built(t))))
    profile = F.col("user_profile")
    return parsed.select(
        "event_id", "event_type", "timestamp", "user_id", "product_id",
        F.col("product.name").alias("product_name"),
        F.col("product.category").alias("product_category"), F.col("product.price").alias("price"),
        profile.isNotNull().alias("has_profile"),
        F.array_join(profile["preferred_categories"], ",").alias("categories"),
        F.array_join(profile["preferred_features"], ",").alias("features"),
        F.array_join(profile["viewing_history"], ",").alias("viewed"),
        F.array_join(profile["purchase_history"], ",").alias("bought"))


@query("stream_parse_route", with_tables("engine_events", """
    SELECT CASE event_type WHEN 'product_view' THEN 'view' WHEN 'product_purchase'
      THEN 'purchase' ELSE 'unknown' END AS route, count(*) AS messages
    FROM d_engine_events GROUP BY 1
    UNION ALL SELECT 'rejected', count(*) FROM events WHERE event_type = 'error'"""))
def stream_parse_route(t: Tables) -> DataFrame:
    parsed = E.parse(t.spark.read.text(message_files(t)))
    route = (F.when(F.col("rejected").isNotNull(), "rejected")
             .when(F.col("event_type") == K.VIEW_EVENT, "view")
             .when(F.col("event_type") == K.PURCHASE_EVENT, "purchase").otherwise("unknown"))
    return parsed.groupBy(route.alias("route")).agg(F.count("*").alias("messages"))


@query("stream_recommendations", with_tables("view_recs", f"""
    SELECT event_id, 'recommendations_generated' AS event_type,
      {_SECONDS.format(c='ts')} AS timestamp, user_id, product_id AS viewed_product_id,
      viewed_product_name, CAST(5 AS INTEGER) AS recommendation_count, has_user_profile, rank, id,
      CAST(tier AS INTEGER) AS tier FROM d_view_recs"""))
def stream_recommendations(t: Tables) -> DataFrame:
    recs = output(t, replayed(t), "recommendations")
    return recs.select(
        "event_id", "event_type", "timestamp", "user_id", "viewed_product_id",
        "viewed_product_name", "recommendation_count", "has_user_profile",
        F.posexplode("recommendations").alias("pos", "rec")).select(
        "*", (F.col("pos") + 1).alias("rank"), "rec.id", "rec.tier").drop("pos", "rec")


@query("stream_restart", with_tables("view_recs", """
    SELECT event_id, user_id, rank, id, CAST(tier AS INTEGER) AS tier, event_id % 2 >= 0 AS once FROM d_view_recs"""))
def stream_restart(t: Tables) -> DataFrame:
    """Two runs from one checkpoint: the second takes only what landed since, so nothing comes twice."""
    base, parts = new_path(t.spark, "restart"), slices(t)
    engine = S.Recommender(catalog(t), f"{base}/out", K_RECS, t.fill_key(), accounts=False)
    batches = []
    for some in (parts[:2], parts[2:]):
        for part in some:
            land(part, f"{base}/in")
        stream = readers.stream_text_files(t.spark, f"{base}/in", 1_000)
        engine.start(stream, f"{base}/checkpoint", available_now=True).awaitTermination()
        batches.append(output(t, f"{base}/out", "recommendations").agg(F.max("batch_id")).first()[0])
    recs = output(t, f"{base}/out", "recommendations")
    return recs.select("event_id", "user_id", F.posexplode("recommendations").alias("pos", "rec"),
                       F.lit(batches[0] < batches[1]).alias("once")).select(
        "event_id", "user_id", (F.col("pos") + 1).alias("rank"), "rec.id", "rec.tier", "once")


@query("stream_purchases", with_tables("engine_events products", f"""
    SELECT event_id, 'purchase_confirmed' AS event_type, {_SECONDS.format(c='ts')} AS timestamp,
      user_id, product_id, p.name AS product_name, p.price
    FROM d_engine_events e JOIN d_products p ON p.id = e.product_id
    WHERE event_type = 'product_purchase'"""))
def stream_purchases(t: Tables) -> DataFrame:
    return output(t, replayed(t), "purchases").drop("batch_id")


@query("stream_rejects", """SELECT '{"event_id": ' || event_id || ', "event_type": "pro'
    AS rejected FROM events WHERE event_type = 'error'""")
def stream_rejects(t: Tables) -> DataFrame:
    return output(t, replayed(t), "rejects").drop("batch_id")


_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in R.COUNTERS)


@query("stream_metrics_final", with_tables("user_counters", scored(f"""
    SELECT {_SUMS}, (SELECT count(*) FROM events) AS events_processed,
      count(*) AS active_user_sessions FROM d_user_counters""")))
def stream_metrics_final(t: Tables) -> DataFrame:
    """Cumulative metrics after all micro-batches, four files at a time."""
    return S.cumulative_metrics(output(t, replayed(t, 4, accounts=True), "metrics"))


_EVERY10 = f"""SELECT * FROM (SELECT event_id, ts, event_type, n - 1 AS events_processed,
      total_recommendations, relevant_recommendations, total_relevant_products,
      relevant_products_recommended, active_user_sessions FROM (
    SELECT e.event_id, e.ts, e.event_type, row_number() OVER w AS n,
      CAST(sum(coalesce(c.n_recs, 0)) OVER w AS BIGINT) AS total_recommendations,
      CAST(sum(coalesce(c.n_relevant, 0)) OVER w AS BIGINT) AS relevant_recommendations,
      CAST(sum(coalesce(c.first_total, 0)) OVER w AS BIGINT) AS total_relevant_products,
      CAST(sum(coalesce(c.n_relevant, 0)) OVER w AS BIGINT) AS relevant_products_recommended,
      CAST(sum(coalesce(c.first_view, 0)) OVER w AS BIGINT) AS active_user_sessions
    FROM d_engine_events e LEFT JOIN (
      SELECT *, CASE WHEN row_number() OVER u = 1 THEN 1 ELSE 0 END AS first_view,
        CASE WHEN relevant_products > 0 AND row_number() OVER
          (PARTITION BY user_id, relevant_products > 0 ORDER BY ts, event_id) = 1
          THEN relevant_products ELSE 0 END AS first_total
      FROM d_counters WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)) c
    ON c.event_id = e.event_id WINDOW w AS (ORDER BY e.ts, e.event_id))
  ) WHERE event_type = 'product_view' AND events_processed % 10 = 0"""


def every_tenth(t: Tables) -> DataFrame:
    known = t.engine_events().withColumn("has_user_profile", ~t.anonymous())
    return S.every_tenth(known, cut_lineage(recommending.counters(t)))


_UPDATES = with_tables("engine_events counters", scored(f"SELECT * EXCLUDE (ts, event_type) FROM ({_EVERY10})"))


@query("stream_metrics_every10", _UPDATES)
def stream_metrics_every10(t: Tables) -> DataFrame:
    """The messages due at every tenth event, from stored tables."""
    return every_tenth(t).drop("ts")


@query("stream_metrics_live", _UPDATES)
def stream_metrics_live(t: Tables) -> DataFrame:
    """The same messages as the running stream sends them, over several batches of ordered events."""
    out = replayed(t, SLICE_FILES, accounts=True, every=10, source=ordered_files(t))
    return output(t, out, "updates").drop("ts", "batch_id", "runtime_seconds", "events_per_second")


@query("stream_closing", with_tables("engine_events user_counters", """
    SELECT 'metrics_update' AS event_type, (SELECT count(*) FROM d_engine_events) AS events_processed,
      count(*) AS active_user_sessions, TRUE AS has_time, TRUE AS has_runtime, TRUE AS has_rate
    FROM d_user_counters"""))
def stream_closing(t: Tables) -> DataFrame:
    """The message a stream ends with; its run time and rate are measured, so only their presence is stated."""
    out = replayed(t, SLICE_FILES, accounts=True, source=ordered_files(t))
    m = F.col("metrics")
    return output(t, out, "closing").select(
        "event_type", m["events_processed"].alias("events_processed"), m["active_user_sessions"].alias("active_user_sessions"),
        (F.col("timestamp") > 0).alias("has_time"), (m["runtime_seconds"] > 0).alias("has_runtime"),
        (F.abs(m["events_per_second"] * m["runtime_seconds"] - m["events_processed"]) < 0.01).alias("has_rate"))


@query("stream_progress", with_tables("engine_events", f"""
    SELECT CAST({SLICES} AS BIGINT) AS batches, count(*) AS messages, TRUE AS timed FROM d_engine_events"""))
def stream_progress(t: Tables) -> DataFrame:
    """What the listener saw: batches, their messages, and that each took time."""
    base = new_path(t.spark, "progress")
    stream = readers.stream_text_files(t.spark, ordered_files(t), SLICE_FILES)
    running = S.Recommender(catalog(t), f"{base}/out", K_RECS, t.fill_key(), accounts=False).start(
        stream, f"{base}/checkpoint", available_now=True)
    running.awaitTermination()
    # a batch is reported again when the stream ends without further messages
    seen = running.progress_rows().filter("messages > 0").groupBy("batch_id").agg(
        F.max("messages").alias("messages"), F.max("milliseconds").alias("ms"), F.max("rows_per_second").alias("rate"))
    return seen.agg(F.count("*").alias("batches"), F.sum("messages").alias("messages"),
                    F.bool_and((F.col("ms") > 0) & (F.col("rate") > 0)).alias("timed"))


_LAST_VIEW = f"""SELECT * FROM ({_BUILT}) WHERE event_type = 'product_view' AND has_profile
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


@query("stream_sessions", with_tables("engine_events products profiles", f"""
    SELECT user_id, event_id, categories, features, viewed, bought FROM ({_LAST_VIEW})"""))
def stream_sessions(t: Tables) -> DataFrame:
    """The sessions that the running stream keeps, after several batches in no order."""
    profile = F.col("profile")
    return S.stored_sessions(t.spark, replayed(t, 4, accounts=True, recommend=False)).select(
        "user_id", "event_id",
        F.array_join(profile["preferred_categories"], ",").alias("categories"),
        F.array_join(profile["preferred_features"], ",").alias("features"),
        F.array_join(profile["viewing_history"], ",").alias("viewed"),
        F.array_join(profile["purchase_history"], ",").alias("bought"))


@query("stream_session_purchases", with_tables("engine_events products profiles", f"""
    SELECT e.user_id, e.event_id, e.product_id FROM d_engine_events e JOIN last_view l
      ON l.user_id = e.user_id AND (e.ts > l.ts OR (e.ts = l.ts AND e.event_id > l.event_id))
    WHERE e.event_type = 'product_purchase'""", last_view=_LAST_VIEW))
def stream_session_purchases(t: Tables) -> DataFrame:
    return S.stored_session_purchases(t.spark, replayed(t, 4, accounts=True, recommend=False)).drop("ts")


@query("stream_latest_recs", with_tables("view_recs", """
    SELECT user_id, event_id, ts, epoch_ms(ts) + 300001 <= (SELECT max(epoch_ms(ts)) FROM d_view_recs) AS is_stale,
      array_to_string(list(id ORDER BY rank), ',') AS ids FROM d_view_recs
    GROUP BY 1, 2, 3
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""))
def stream_latest_recs(t: Tables) -> DataFrame:
    """The newest recommendations as a stream keeps them: rows go stale as other users' events pass by."""
    folder = f"{replayed(t, SLICE_FILES, source=ordered_files(t))}/recommendations"
    base = new_path(t.spark, "newest")
    stored = t.spark.read.parquet(folder)
    stream = t.spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 4).parquet(folder)
    S.start_newest(stream, f"{base}/out", f"{base}/checkpoint", available_now=True).awaitTermination()
    newest = S.newest_of(t.spark.read.parquet(f"{base}/out"))
    return newest.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("latest_recs_stale", with_tables("view_recs", f"""
    SELECT user_id, event_id, ts, TIMESTAMP '{AS_OF}' - ts > INTERVAL 5 MINUTE AS is_stale,
      array_to_string(list(id ORDER BY rank), ',') AS ids FROM d_view_recs
    GROUP BY 1, 2, 3
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""))
def latest_recs_stale(t: Tables) -> DataFrame:
    newest = S.latest_recommendations(recommending.recommended(t),
                                      F.lit(AS_OF).cast("timestamp_ntz"))
    return newest.select("user_id", "event_id", "ts", "is_stale", F.array_join(
        F.transform("recommendations", lambda r: r["id"].cast("string")), ",").alias("ids"))


@query("replay_from", with_tables("counters", scored(f"""
    SELECT user_id, CAST(sum(n_recs) AS BIGINT) AS total_recommendations,
      CAST(sum(n_relevant) AS BIGINT) AS relevant_recommendations,
      any_value(relevant_products) AS total_relevant_products,
      CAST(sum(n_relevant) AS BIGINT) AS relevant_products_recommended
    FROM d_counters WHERE ts >= TIMESTAMP '{REPLAY_START}' GROUP BY 1""")))
def replay_from(t: Tables) -> DataFrame:
    """Views from a point in time on, recommended and scored again."""
    views = S.since(t.views(), F.lit(REPLAY_START).cast("timestamp_ntz"))
    catalog = t.catalog()
    preferences = R.Preferences.of(views, catalog)
    recs = R.recommend(views, catalog, K_RECS, t.fill_key(), preferences)
    return R.user_metrics(R.event_counters(recs, R.relevant_totals(preferences, catalog)))


@query("web_event_normalise", with_tables("engine_events products profiles", f"""
    SELECT event_id, CASE event_type WHEN 'click' THEN 'add_to_cart' ELSE event_type END
      AS event_type, timestamp, user_id, product_id, product_name, has_profile, bought,
      CASE WHEN event_id % 5 = 0 THEN '' ELSE coalesce(json_extract_string(props, '$.k'), '') END AS k, CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 END AS fields
    FROM ({_BUILT}) JOIN (SELECT event_id, props FROM events) USING (event_id)"""))
def web_event_normalise(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    web = t.raw("events").select(
        F.col("event_id").alias("eventId"), F.col("user_id").alias("userId"),
        F.when(kind == "view", "product_view").when(kind == "click", "add_to_cart")
        .otherwise(kind).alias("eventType"), t.any_product().alias("productId"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.when(F.col("event_id") % 5 != 0, F.from_json("props", "map<string, string>")).alias("metadata"))
    events = E.normalise_web_events(web, t.catalog(), t.profiles())
    return events.select(
        "event_id", "event_type", "timestamp", "user_id", "product_id",
        F.col("product.name").alias("product_name"),
        F.col("user_profile").isNotNull().alias("has_profile"),
        F.array_join("user_profile.purchase_history", ",").alias("bought"),
        F.coalesce(F.try_element_at("metadata", F.lit("k")), F.lit("")).alias("k"), F.size("metadata").alias("fields"))


@query("stream_flatten_recs", with_tables("view_recs", """
    SELECT event_id, strftime(ts, '%H:%M:%S') AS time, CAST(user_id AS VARCHAR) AS "user",
      viewed_product_name, TRUE AS timed, has_user_profile,
      CAST(5 AS INTEGER) AS recommendation_count, rank, name, price, rec_category AS category
    FROM d_view_recs"""))
def stream_flatten_recs(t: Tables) -> DataFrame:
    """Display rows of the stream's messages; the time per event is measured, so only its presence is stated."""
    texts = E.to_messages(S.timed_recommendations(t.spark, replayed(t)))
    return M.flatten_recommendations(M.output_messages(texts)).withColumn(
        "timed", F.col("processing_time_ms") > 0).drop("processing_time_ms")


@query("stream_flatten_purchases", with_tables("engine_events products", """
    SELECT event_id, strftime(ts, '%H:%M:%S') AS time, CAST(user_id AS VARCHAR) AS "user",
      p.name AS product_name, p.price
    FROM d_engine_events e JOIN d_products p ON p.id = e.product_id
    WHERE event_type = 'product_purchase'"""))
def stream_flatten_purchases(t: Tables) -> DataFrame:
    """Display rows of the purchase messages, built straight from the events."""
    texts = E.to_messages(E.purchase_messages(E.accepted(E.parse(E.to_messages(built(t))))))
    return M.flatten_purchases(M.output_messages(texts))


@query("stream_flatten_events", with_tables("engine_events products", """
    SELECT event_id, event_type, strftime(ts, '%H:%M:%S') AS time,
      CASE WHEN user_id % 7 = 0 THEN 'Anonymous' ELSE CAST(user_id AS VARCHAR) END AS "user",
      p.name AS product_name, p.category, p.price
    FROM d_engine_events e JOIN d_products p ON p.id = e.product_id
    WHERE event_type IN ('product_view', 'product_purchase')"""))
def stream_flatten_events(t: Tables) -> DataFrame:
    """Event display rows; here one user in seven is not signed in."""
    known = F.when(F.col("user_id") % 7 != 0, F.col("user_id"))
    texts = E.to_messages(E.build_events(t.engine_events().withColumn("user_id", known),
                                         t.catalog(), t.profiles()))
    return M.flatten_events(E.accepted(E.parse(texts)))


@query("stream_flatten_metrics", with_tables("engine_events counters", f"""
    SELECT event_id, strftime(ts, '%H:%M:%S') AS time, precision, recall, {F1},
      events_processed, events_processed > 0 AS has_rate, active_user_sessions
    FROM (SELECT *, {SCORES} FROM ({_EVERY10}))"""))
def stream_flatten_metrics(t: Tables) -> DataFrame:
    """Display rows of the metrics messages that the running stream sent."""
    out = replayed(t, SLICE_FILES, accounts=True, every=10, source=ordered_files(t))
    texts = E.to_messages(E.metrics_messages(output(t, out, "updates")))
    return M.flatten_metrics(M.output_messages(texts)).withColumn(
        "has_rate", F.col("events_per_second") > 0).drop("events_per_second")


@query("stream_message_rates", with_tables("engine_events", """
    SELECT event_type, count(*) AS messages, TRUE AS has_rate FROM d_engine_events GROUP BY 1"""))
def stream_message_rates(t: Tables) -> DataFrame:
    """Messages per type, and per second of the measured run time of the stream that took them."""
    source = ordered_files(t)
    out = replayed(t, SLICE_FILES, accounts=True, source=source)
    seconds = output(t, out, "closing").first()["metrics"]["runtime_seconds"]
    rates = M.message_rates(E.accepted(E.parse(t.spark.read.text(source))), seconds)
    return rates.withColumn("has_rate", F.col("per_second") > 0).drop("per_second")
