import json
from datetime import date, datetime

import pytest

from conftest import rows
from shelfwise import constants as K, schemas
from shelfwise.operators import enrich as N, profile as P
from shelfwise.sources import bookmark as B, readers, reports, sinks


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", table="cart", user="u", password="p")
    assert plain["dbtable"] == "cart" and "partitionColumn" not in plain
    assert readers.jdbc_options("jdbc:x", query="SELECT 1")["query"] == "SELECT 1"
    split = readers.jdbc_options("jdbc:x", query="SELECT 1", partition_column="id",
                                 lower_bound=0, upper_bound=100, num_partitions=8)
    assert split["dbtable"] == "(SELECT 1) as t" and split["numPartitions"] == "8"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", table="t", partition_column="id")
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x")
    assert "table_schema" in readers.list_tables_query()


def test_kafka_options():
    assert readers.kafka_options("h:1", [K.TOPIC_EVENTS]) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "user-events",
        "startingOffsets": "earliest"}
    tail = readers.kafka_options("h:1", [K.TOPIC_RECOMMENDATIONS, K.TOPIC_METRICS], "latest")
    assert tail["subscribe"] == "recommendations,metrics" and tail["startingOffsets"] == "latest"
    replay = readers.kafka_options("h:1", ["t"], starting_timestamp_ms=5, max_offsets=10)
    assert replay["startingTimestamp"] == "5" and "startingOffsets" not in replay
    sink = sinks.kafka_sink_options("h:1", K.TOPIC_METRICS, "/c")
    assert sink["topic"] == "metrics" and sink["checkpointLocation"] == "/c"


def test_table_reads_retry_and_report_missing():
    calls = []

    def flaky(name):
        calls.append(name)
        if name == "bad" or len(calls) < 3:
            raise OSError(name)
        return name.upper()
    assert readers.read_table(flaky, "cart") == "CART" and len(calls) == 3
    with pytest.raises(RuntimeError, match="3 attempts"):
        readers.read_table(flaky, "bad")
    assert readers.read_available(flaky, ["a", "bad"]) == ({"a": "A"}, ["bad"])
    assert readers.read_tables(flaky, ["a", "b"]) == {"a": "A", "b": "B"}


def test_catalog_file_order_and_fallback(spark, tmp_path):
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps([{"id": 9, "name": "z"}, {"id": 3, "name": "a", "price": 1.5}],
                               indent=2))
    assert rows(readers.read_catalog(spark, str(path)), "pos", "id", "price") == [
        (0, 9, None), (1, 3, 1.5)]
    default = rows(readers.default_catalog(spark), "id", "pos")
    assert len(default) == 5
    path.write_text("[{broken")
    assert rows(readers.read_catalog(spark, str(path)), "id", "pos") == default
    assert rows(readers.read_catalog(spark, str(tmp_path / "none.json")), "id", "pos") == default


def test_json_arrays_and_feed_extensions(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n {"id": 1},\n {"id": 2}\n]')
    assert rows(readers.read_json_array(spark, str(tmp_path / "a.json"), "id int")) == [(1,), (2,)]
    (tmp_path / "f.csv").write_text('product_id,name\nABC-1,"a ""b"""\n')
    feed = readers.read_feed(spark, str(tmp_path / "f.csv"), "product_id string, name string")
    assert rows(feed) == [("ABC-1", 'a "b"')]
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_feed(spark, "feed.xml")
    with pytest.raises(ValueError, match="unsupported"):
        sinks.save_feed(feed, str(tmp_path / "o"), "xml")


def test_saved_feed_keeps_nested_columns(spark, tmp_path):
    df = spark.sql("SELECT 'ABC-123' AS product_id, map('memory', '1 \"x\" GB') AS specifications, "
                   "array('a', 'b') AS images")
    sinks.save_feed(df, str(tmp_path / "f.csv"), "csv")
    back = readers.read_feed(spark, str(tmp_path / "f.csv"),
                             "product_id string, specifications string, images string").first()
    assert json.loads(back["specifications"]) == {"memory": '1 "x" GB'}
    sinks.save_feed(df, str(tmp_path / "f.json"), "json")
    assert spark.read.json(str(tmp_path / "f.json")).first()["images"] == ["a", "b"]


def cart(spark, data):
    return spark.createDataFrame(
        [(i, c, q, p, datetime.fromisoformat(t)) for i, c, q, p, t in data],
        "id int, cart_id int, quantity int, price double, updated_at timestamp_ntz")


def test_bookmark_moves_past_bad_rows(spark, tmp_path):
    base = str(tmp_path)
    first = cart(spark, [(1, 1, 1, 1.0, "2024-01-01T00:00:00.000001"),
                         (2, 1, -1, 1.0, "2024-01-02T00:00:00.500000")])
    args = (f"{base}/mark", f"{base}/rows")
    assert B.read_bookmark(spark, args[0]) == datetime(2000, 1, 1)
    done = B.clean_new_cart_rows(first, *args, "1")
    assert done == {"read": 2, "kept": 1, "bookmark": datetime(2024, 1, 2, 0, 0, 0, 500000)}
    assert B.clean_new_cart_rows(first, *args, "2")["read"] == 0
    more = first.unionByName(cart(spark, [(3, None, 1, 1.0, "2024-01-03"),
                                          (4, 2, 0, 0.0, "2024-01-03")]))
    assert B.clean_new_cart_rows(more, *args, "3")["kept"] == 1
    assert rows(spark.read.parquet(args[1]), "id") == [(1,), (4,)]
    assert B.read_bookmark(spark, args[0]) == datetime(2024, 1, 3)


def test_cart_stream_takes_late_rows_once(spark, tmp_path):
    """Two increments and a restart; a row that lands late with an old time is cleaned when it lands."""
    def land(rows_):
        cart(spark, rows_).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        schema = cart(spark, []).schema
        B.start_cart_cleaning(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "c"),
                              since="2024-01-02T00:00:00").awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")), "id")

    land([(1, 1, 1, 1.0, "2024-01-05"), (2, 1, -1, 1.0, "2024-01-06"), (3, 1, 1, 1.0, "2024-01-02")])
    assert run() == [(1,)] and run() == [(1,)]
    land([(4, 1, 1, 1.0, "2024-01-03"), (5, None, 1, 1.0, "2024-01-09")])
    assert run() == [(1,), (4,)]


def job(path, transform, **more):
    return N.TemplateJob("j", ["t"], transform, str(path), **more)


def test_template_job_writes_its_day_only(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "c")],
                               "product_id int, note string")
    for day in (date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 2)):
        summary = job(tmp_path, lambda t: t["t"], run_date=day).run(lambda n: df).first()
    assert summary["record_count"] == 2
    assert summary["null_counts"] == {"product_id": 0, "note": 1}
    assert summary["columns"] == ["product_id", "note"]
    stored = spark.read.parquet(str(tmp_path))
    assert stored.count() == 4 and stored.select("run_date").distinct().count() == 2


def test_template_job_reports_and_raises(tmp_path):
    alerts = []

    def broken(tables):
        raise KeyError("no column")
    with pytest.raises(KeyError):
        job(tmp_path, broken, on_failure=lambda n, e: alerts.append(n)).run(lambda n: None)
    assert alerts == ["j"]


def test_rejects_are_counted_while_written(spark, tmp_path):
    assert sinks.write_rejects(spark.range(7), str(tmp_path / "r")) == 7
    assert sinks.write_rejects(spark.range(0), str(tmp_path / "e")) == 0


def test_report_versions(spark, tmp_path):
    path = str(tmp_path / "report")
    explored = P.explore_schema(spark, {"t": spark.range(1)})
    assert [reports.save_report(explored, path) for _ in range(3)] == [1, 2, 3]
    latest = reports.latest_report(spark, path)
    assert latest.count() == 1 and latest.first()["proposed_name"] == "t_id"


def test_lowercase_tables(spark):
    names = spark.createDataFrame([("cart",), ("Cart",), ("123",), ("a_1",)], "table_name string")
    assert rows(P.lowercase_names(names)) == [("a_1",), ("cart",)]


def test_fan_out_multiplies_and_aggregate_does_not(spark):
    users = spark.createDataFrame([(1,), (2,), (None,)], "user_id int")
    child = spark.createDataFrame([(1, 10, 5), (1, 11, 6)], "user_id int, id int, at int")
    fan = N.user_activity_fanout(users, {"a": child, "b": child, "c": child.limit(0)})
    assert fan.filter("user_id = 1").count() == 4 and fan.count() == 5
    assert len(set(fan.columns)) == len(fan.columns)
    agg = {r["user_id"]: r for r in N.user_activity(users, {"a": child, "b": child}).collect()}
    assert (agg[1]["a_count"], agg[1]["fanout_rows"], agg[1]["a_last"]) == (2, 4, 6)
    assert (agg[2]["a_count"], agg[2]["fanout_rows"]) == (0, 1)


def test_user_name_from_parts(spark):
    wishes = spark.createDataFrame([(1, 1, 1, "w", "b", 1.0, 1.0, 1.0, 1)],
                                   "id int, user_id int, product_id int, name string, "
                                   "brand string, price double, discounted_price double, "
                                   "rating double, review_count int")
    products = spark.createDataFrame([(2, "p", "q")], "id int, name string, brand string")
    users = spark.createDataFrame([(1, "A", None, "e")],
                                  "id int, first_name string, last_name string, email string")
    row = N.wishlist_output(N.wishlist_resolved(wishes, products, users)).first()
    assert (row["user_name"], row["final_name"], row["user_email"]) == ("A", "w", "e")
    assert schemas.FEED.count("string") == 10
