import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfwise import constants as K, schemas
from shelfwise.operators import feed as O

GOOD = {"product_id": "ABC-1234", "name": "n", "category": "GPUs", "brand": "b",
        "description": "d", "price": "9.5", "currency": "USD", "in_stock": "yes",
        "specifications": json.dumps({"memory": "24 GB"}), "images": '["a.png"]'}


def validated(spark, changes, rules=O.FeedRules()):
    rows_ = [{**GOOD, **c} for c in changes]
    order = [n for n, _ in K.FEED_FIELDS]
    df = spark.createDataFrame([tuple(r[n] for n in order) for r in rows_], schemas.FEED)
    return O.validate_feed(df, rules)


def errors(spark, *changes):
    return [r["errors"] for r in validated(spark, changes).select("errors").collect()]


def test_good_row(spark):
    row = validated(spark, [{}]).first()
    assert row["errors"] == [] and row["in_stock"] is True and row["price"] == 9.5
    assert row["specifications"] == {"memory": "24.00 GB"} and row["images"] == ["a.png"]


def test_all_faults_in_order(spark):
    found = errors(spark, {"product_id": "bad id!", "category": "Toys", "price": "-100.0",
                           "currency": "BTC", "in_stock": "maybe", "images": None})[0]
    assert found == [
        "Field 'in_stock' must be of type bool", "Missing required field: images",
        "Invalid product_id format: bad id!",
        "Invalid category: Toys. Must be one of: " + ", ".join(K.FEED_CATEGORIES),
        "Price out of valid range (0-1000000): -100.0",
        "Invalid currency: BTC. Must be one of: USD, EUR, GBP, JPY, CNY"]


@pytest.mark.parametrize("price,bad", [("0", False), ("1000000", False), ("1000000.01", True),
                                       ("NaN", True)])
def test_price_bounds(spark, price, bad):
    assert bool(errors(spark, {"price": price})[0]) == bad


def test_texts_of_the_wrong_kind(spark):
    row = validated(spark, [{"price": "cheap", "specifications": "none", "images": "{}"}]).first()
    assert row["errors"] == [f"Field '{f}' must be of type {k}" for f, k in
                             (("price", "float"), ("specifications", "dict"), ("images", "list"))]
    assert row["price"] is None and row["specifications"] is None


SPECS = {
    "memory": ("128 MB", "0.12 GB"), "storage": ("2TB", "2048.00 GB"),
    "clock_speed": ("1800 MHz", "1.80 GHz"), "power_consumption": ("350 W", "350.00 W"),
    "watts": ("1.5 kW", "1500.00 W"), "tdp": ("350 W", "350 W"), "cores": ("10240", "10240"),
    "memory_kind": ("16 gb", "16 gb"), "storage_x": ("1.2.3 GB", "1.2.3 GB"),
    "bandwidth": ("900 GB/s", "900 GB/s"), "performance": ("500 TFLOPS", "500 TFLOPS"),
    "memory_speed": ("3200 MHz", "3.20 GB"), "power_null": (None, None)}


def test_specifications(spark):
    raw = json.dumps({k: v for k, (v, _) in SPECS.items()})
    got = validated(spark, [{"specifications": raw}]).first()["specifications"]
    assert got == {k: v for k, (_, v) in SPECS.items()}
    strict = validated(spark, [{"specifications": raw}], O.FeedRules(strict_units=True)).first()
    assert strict["specifications"] == {**got, "memory_speed": "3200 MHz"}


def test_overrides_replace_and_merge():
    rules = O.FeedRules().override({"valid_categories": ["A"],
                                    "validation_rules": {"currency": ["CHF"]}})
    assert rules.categories == ("A",) and rules.currencies == ("CHF",)
    assert rules.price_range == K.PRICE_RANGE


def test_missing_column_and_duplicates(spark):
    df = validated(spark, [{"currency": "X"}, {"currency": "Y"}]).select(
        *[c for c, _ in K.FEED_FIELDS])
    texts = df.select(*[F.col(c).cast("string") if c in ("price", "in_stock") else
                        F.to_json(c).alias(c) if c in ("specifications", "images") else F.col(c)
                        for c in df.columns if c != "brand"])
    out = O.validate_feed(texts)
    assert out.first()["errors"][0] == "Missing required field: brand"
    table = O.error_table(out)
    assert table.filter(F.col("error").startswith("Invalid currency")).count() == 2
    kinds = {r["error_kind"]: (r["error_count"], r["product_count"])
             for r in O.error_summary(out).collect()}
    assert kinds["Invalid currency"] == (2, 1)


def test_tasks_split_keeps_every_row(spark):
    times = ["2h", "3 h", " 4H ", "2 hours", "", "nan", None]
    tasks = spark.createDataFrame([(str(i), "n", "d", "o", t) for i, t in enumerate(times)],
                                  schemas.TASKS)
    valid, invalid = O.split_tasks(tasks)
    assert rows(valid, "Task ID") == [("0",), ("1",), ("2",)]
    wrong = "Invalid Estimated Time format (expected e.g., '2h')"
    both = f"Missing Estimated Time; {wrong}"
    assert rows(invalid, "Task ID", "Issues") == [("3", wrong), ("4", both), ("5", both),
                                                  ("6", both)]
    assert valid.count() + invalid.count() == len(times)
