"""Keyed state of the running stream: one session per user, and the newest recommendations per user.

The processors are made by functions, so that they travel to the workers by value. They take and give rows, which cross
in batches of many users; a user costs few calls to the store, since every call is a message of its own.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

KINDS = ("sums", "session", "purchase")
CHANGES_PER_ROW = 1_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

#: What one batch of events says about a user ("sums"), and each purchase ("purchase"). Times in microseconds.
ACTIVITY = ("kind string, user_id bigint, n_events bigint, n_recs bigint, n_relevant bigint, "
            "n_relevant_products bigint, first_ts bigint, first_event bigint, last_ts bigint, last_event bigint, "
            "total_ts bigint, total_event bigint, total bigint, ts bigint, event_id bigint, product_id bigint, "
            "batch_id bigint")
#: "sums" with what is new to the user, "session" when it changed, "purchase" in a session.
CHANGES = ("kind string, batch_id bigint, user_id bigint, n_events bigint, n_recs bigint, n_relevant bigint, "
           "n_relevant_products bigint, session_start bigint, total_start bigint, total bigint, ts bigint, "
           "event_id bigint, product_id bigint, session_event bigint, session_batch bigint")


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which holds more than memory."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def user_state(ttl_ms: int | None = None) -> StatefulProcessor:
    """The session of a user: its last view with a profile, and the purchases behind it.

    State rows hold positions: the batch and event that the profile is stored under, never the profile's
    arrays, and three numbers per purchase. Purchases stay until a later view replaces the session; those that
    came without a session stay too, since an earlier view may arrive late. A batch that is read
    twice is recognised by its number. Without ``ttl_ms`` state never expires.
    """
    columns = [c.split()[0] for c in CHANGES.split(", ")]
    change = Row(*columns)

    class UserState(StatefulProcessor):
        def init(self, handle):
            more = {} if ttl_ms is None else {"ttlDurationMs": ttl_ms}
            self.user = handle.getValueState(
                "user", "last_batch bigint, counted boolean, ts bigint, event_id bigint, batch bigint", **more)
            self.bought = handle.getListState("bought", "ts bigint, event_id bigint, product_id bigint", **more)

        def handleInputRows(self, key, rows, timerValues):
            known = self.user.get()
            last, counted, *session = (-1, False, None, None, None) if known is None else known
            user = key[1] if key[0] else None
            sums, bought = [], []  # of this trigger: a few rows, and three numbers per purchase
            for r in rows:
                if r["batch_id"] > last:
                    (sums if r["kind"] == "sums" else bought).append(r)
            if not sums and not bought:
                return
            out, old = [], session
            for r in sorted(sums, key=lambda x: x["batch_id"]):
                row = {c: r[c] for c in ("kind", "batch_id", "n_events", "n_recs", "n_relevant", "n_relevant_products")}
                row["user_id"] = user
                if r["has_view"]:
                    if session[0] is None:
                        row["session_start"] = r["first_event"]
                    here = [r["last_ts"], r["last_event"], r["batch_id"]]
                    if session[0] is None or here[:2] > list(session[:2]):
                        session = here
                if r["has_total"] and not counted:
                    counted = True
                    row.update(total_start=r["total_event"], total=r["total"])
                out.append(row)
            new = [(int(r["ts"]), int(r["event_id"]), int(r["product_id"])) for r in bought]
            if user is not None:
                self._purchases(user, known is not None, list(old), list(session), new, out)
            done = max(r["batch_id"] for r in (*sums, *bought))
            self.user.update((int(done), bool(counted), *(None if x is None else int(x) for x in session)))
            for row in out:
                yield change(*map(row.get, columns))

        def _purchases(self, user, known, old, session, new, out):
            behind = [p for p in new if session[0] is None or [p[0], p[1]] > session[:2]]
            if session != old:
                had = [tuple(p) for p in self.bought.get()] if known else []
                behind = [p for p in had if [p[0], p[1]] > session[:2]] + behind
                if behind:
                    self.bought.put(behind)
                elif had:
                    self.bought.clear()
                out.append({"kind": "session", "user_id": user, "ts": session[0], "event_id": session[1],
                            "batch_id": session[2], "session_batch": session[2]})
            elif behind:
                self.bought.appendList(behind)
            if session[0] is not None:
                out += [{"kind": "purchase", "user_id": user, "ts": p[0], "event_id": p[1], "product_id": p[2],
                         "session_event": session[1], "session_batch": session[2]} for p in behind]

        def close(self):
            pass

    return UserState()


def session_changes(activity: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """The stream of CHANGES for a stream of ACTIVITY; users are keyed, all events without one count as one."""
    zero = F.lit(0).cast("bigint")
    numbers = [n for n, kind in activity.dtypes if kind == "bigint" and n != "user_id"]
    told = {"kind": F.when(F.col("kind") == "sums", KINDS.index("sums")).otherwise(KINDS.index("purchase")),
            "has_view": F.col("last_event").isNotNull(), "has_total": F.col("total_event").isNotNull(),
            **{n: F.coalesce(n, zero) for n in numbers}}
    keyed = activity.select(
        F.col("user_id").isNotNull().alias("_known"), F.coalesce("user_id", zero).alias("_user"),
        F.array(*[c.cast("bigint") for c in told.values()]).alias("told"))
    changed = keyed.groupBy("_known", "_user").transformWithState(
        in_arrays(user_state(ttl_ms), list(told)), "changes array<array<bigint>>", "Update",
        "None" if ttl_ms is None else "ProcessingTime").select(F.explode("changes").alias("c"))
    kind, *others = [c.split()[0] for c in CHANGES.split(", ")]
    return changed.select(
        F.element_at(F.array(*map(F.lit, KINDS)), (F.col("c")[0] + 1).cast("int")).alias(kind),
        *[F.col("c")[i].alias(n) for i, n in enumerate(others, 1)])


def in_arrays(inner: StatefulProcessor, names: list[str]) -> StatefulProcessor:
    """A processor whose rows cross as arrays of numbers named ``names``, and its changes as a few arrays per user.

    A row costs by its columns on the way to the workers, and a user by its columns on the way back.
    """
    class InArrays(StatefulProcessor):
        def init(self, handle):
            inner.init(handle)

        def handleInputRows(self, key, rows, timerValues):
            some = []
            for change in inner.handleInputRows(key, map(named, rows), timerValues):
                some.append([KINDS.index(change[0]), *change[1:]])
                if len(some) == CHANGES_PER_ROW:
                    yield row(some)
                    some = []
            if some:
                yield row(some)

        def close(self):
            inner.close()

    def named(r):
        told = dict(zip(names, r["told"], strict=True))
        told["kind"] = KINDS[told["kind"]]
        return told

    row = Row("changes")
    return InArrays()


def newest_state(max_age_ms: int) -> StatefulProcessor:
    """A user's newest recommendations; a timer in event time marks them stale when nothing newer came."""

    change = Row("user_id", "event_id", "at", "ids", "is_stale")

    def due_at(newest):
        return newest[0] // 1000 + max_age_ms + 1

    class Newest(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.newest = handle.getValueState("newest", "ts bigint, event_id bigint, ids string")

        def handleInputRows(self, key, rows, timerValues):
            had = self.newest.get()
            best = had = None if had is None else tuple(had)
            for r in rows:
                if best is None or (r["at"], r["event_id"]) > best[:2]:
                    best = (r["at"], r["event_id"], r["ids"])
            if best == had:
                return
            self.newest.update(best)
            due = due_at(best)  # a timer of an older row finds a newer one when it expires
            late = due <= timerValues.getCurrentWatermarkInMs()
            if not late:
                self.handle.registerTimer(due)
            yield self._row(key, best, late)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            newest = tuple(self.newest.get())
            if due_at(newest) == expiredTimerInfo.getExpiryTimeInMs():
                yield self._row(key, newest, True)

        def _row(self, key, state, stale):
            return change(key[0], state[1], state[0], state[2], stale)

        def close(self):
            pass

    return Newest()


def newest_changes(recommended: DataFrame, max_age_minutes: float = 5, late: str = "0 seconds") -> DataFrame:
    """(user_id, event_id, at, ids, is_stale) whenever a user's newest recommendations change or go stale.

    ``recommended`` is a stream of event_id, ts (timestamp), user_id and ids. Event time decides:
    a user's row goes stale once events of any user are ``max_age_minutes`` later.
    """
    rows = (recommended.filter(F.col("user_id").isNotNull()).withWatermark("ts", late)
            .select("user_id", "event_id", "ts", F.unix_micros("ts").alias("at"), "ids"))
    return rows.groupBy("user_id").transformWithState(
        newest_state(int(max_age_minutes * 60_000)), "user_id bigint, event_id bigint, at bigint, ids string, is_stale boolean",
        "Update", "EventTime")
