import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfwise import constants as K
from shelfwise.functions import checks as C
from shelfwise.operators import clean as L, profile as P, rules as R, validate as V


def flags(spark, schema, data, check):
    df = spark.createDataFrame([(v,) for v in data], schema)
    return [r[0] for r in df.select(check).collect()]


def test_checks_keep_null_unknown(spark):
    assert flags(spark, "c int", [1, 0, -1, None], C.positive("c")) == [True, False, False, None]
    assert flags(spark, "c int", [1, None], C.not_null("c")) == [True, False]
    assert flags(spark, "c string", ["a", "b", None], C.allowed("c", ["a"])) == [True, False, None]
    assert flags(spark, "c string", ["x", " ", "", None], C.non_empty("c")) == [
        True, True, False, False]
    assert flags(spark, "c string", ["a-1", "a b", None], C.alphanumeric("c")) == [
        True, False, None]
    assert flags(spark, "c string", ["2024-01-01", "soon", None], C.is_timestamp("c")) == [
        True, False, False]


def test_open_range_fails_on_nan(spark):
    check = C.in_range("c", 0.0, float("inf"))
    assert flags(spark, "c double", [0.0, 1e300, -0.1, float("nan"), None], check) == [
        True, True, False, False, None]


def test_reject_policies_differ_on_null_only(spark):
    df = spark.createDataFrame([(1, 5), (2, -5), (3, None)], "id int, n int")
    suite = [C.positive("n")]
    assert rows(V.rejects(df, suite), "id") == [(2,)]
    assert rows(V.rejects(df, suite, strict=True), "id") == [(2,), (3,)]
    summary = V.suite_summary({"t": (df, suite)}).first()
    assert (summary["row_count"], summary["invalid_count"], summary["errors_found"]) == (3, 1, True)


@pytest.mark.parametrize("suite,names", [
    (V.products_suite, 11), (V.users_suite, 11), (V.wishlist_suite, 12)])
def test_suites_have_all_checks(spark, suite, names):
    assert len(suite()) == names


def test_duplicate_keys_count_null_as_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, None)],
                               "id int, name string")
    out = V.prevalidate(df, ["id", "name"], unique_key="id").first()
    assert (out["null_id"], out["null_name"], out["duplicate_id_count"]) == (2, 1, 2)


def test_contract(spark):
    found = rows(V.check_contract(spark, ["id", "name", "sku", "temp_flag"], "products"))
    assert found == [("products", "brand", "missing_required", True),
                     ("products", "sku", "unexpected", False),
                     ("products", "temp_flag", "disallowed_present", True)]
    with pytest.raises(ValueError, match="missing required"):
        V.require_contract(spark.range(1), "products")
    bad = spark.range(1).select("id", F.lit("x").alias("name"), F.lit("y").alias("brand"),
                                F.lit(1).alias("temp_flag"))
    with pytest.raises(ValueError, match="disallowed"):
        V.require_contract(bad, "products")


def test_mismatch_ignores_null_and_correction_of_orphans(spark):
    wishes = spark.createDataFrame(
        [(1, 10, "a", "x"), (2, 10, "b", None), (3, 99, "c", "z")],
        "id int, product_id int, name string, brand string")
    products = spark.createDataFrame([(10, "a", "X")], "id int, name string, brand string")
    joined = V.with_product_reference(wishes, products)
    assert rows(V.mismatches(joined, "brand", "product_brand"), "id") == [(1,)]
    assert rows(V.corrected(joined, wishes.columns), "id", "name", "brand") == [
        (1, "a", "X"), (2, "a", "X"), (3, None, None)]
    assert rows(V.corrected(joined, wishes.columns, "keep"), "id", "name") == [
        (1, "a"), (2, "a"), (3, "c")]


def test_rules_in_order_and_again(spark):
    df = spark.createDataFrame([(1, " 5 kg", None, "aB"), (2, "x", 3.7, None)],
                               "id int, weight string, score double, name string")
    rules = R.CleaningRules.from_dict({
        "rename_columns": {"id": "key", "nothing": "x"}, "type_conversions": {"score": "int"},
        "null_replacements": {"name": "unknown", "score": 0}, "case_formatting": {"name": "upper"},
        "standardize_units": {"weight": {"from": "kg", "to": "kilogram"}}})
    once = R.apply_rules(df, rules)
    assert rows(once) == [(1, "5kilogram", 0, "AB"), (2, "x", 3, "UNKNOWN")]
    assert rows(R.apply_rules(df, R.CleaningRules())) == rows(df)
    again = R.apply_rules(once, R.CleaningRules.from_dict({
        "type_conversions": {"score": "int"}, "case_formatting": {"name": "upper"}}))
    assert rows(again) == rows(once)


def test_rule_files_and_type_names(tmp_path):
    path = tmp_path / "rules.yaml"
    path.write_text("tables:\n  cart:\n    rename_columns: {id: cart_id}\n"
                    "    type_conversions: {ok: BooleanType}\n")
    assert R.rules_for("cart", str(path)).rename_columns == {"id": "cart_id"}
    assert R.rules_for("other", str(path)) == R.CleaningRules()
    assert R.spark_type("TimestampType()") == R.spark_type("timestamp") == "timestamp"
    assert R.spark_type("Elsewhere") is None
    fixed = R.repair_type_names({"tables": {"cart": {"type_conversions": {"ok": "BooleanType"}}}})
    assert fixed["tables"]["cart"]["type_conversions"] == {"ok": "boolean"}
    assert K.KEY_RENAMES["products"] == {"id": "product_id"}


def test_bad_values_become_null_not_errors(spark):
    df = spark.createDataFrame([("x", "never")], "n string, at string")
    out = R.apply_rules(df, R.CleaningRules(type_conversions={"n": "int", "at": "timestamp"}))
    assert rows(out) == [(None, None)]
    assert rows(L.clean_texts(df.withColumn("n", F.lit(" \t ")), ["n"], ["at"])) == [(None, None)]


def test_latest_user_row_wins(spark):
    df = spark.createDataFrame(
        [(1, "a@b.co", " old ", 1), (1, "a@b.co", " new ", 2), (1, "bad", "x", 3),
         (None, "c@d.ee", "y", 1)], "user_id int, email string, name string, updated int")
    assert rows(L.clean_users(df, ["updated"])) == [(1, "a@b.co", "new", 2)]


def test_profile_of_a_small_table(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.5, None), (2, "a", float("nan"), None), (3, None, 3.0, None)],
        "id int, tag string, score double, note string")
    assert rows(P.null_counts(df)) == [("id", 3, 0), ("note", 3, 3), ("score", 3, 0),
                                       ("tag", 3, 1)]
    assert rows(P.distinct_counts(df)) == [("id", 3), ("note", 0), ("score", 2), ("tag", 1)]
    assert rows(P.top_values(df, 1)) == [("id", "1", 1, 1), ("note", None, 3, 1),
                                         ("score", None, 1, 1), ("tag", "a", 2, 1)]
    stats = {r["column_name"]: r for r in P.column_stats(df.drop("score")).collect()}
    assert (stats["id"]["mean"], stats["id"]["stddev"], stats["id"]["max"]) == (2.0, 1.0, 3.0)
    metrics = {(r["column_name"], r["metric"]): r["value"]
               for r in P.profile_table(df, "t").collect()}
    assert metrics["tag", "top_1"] == "a (2)" and metrics["note", "null_count"] == "3"
    inferred = rows(P.infer_rules(df.withColumn("flag", F.lit("Yes")), "t"))
    assert ("t", "note", "null_replacements", "UNKNOWN") in inferred
    assert ("t", "flag", "type_conversions", "boolean") in inferred
    assert ("t", "id", "rename_columns", "t_id") in inferred


def test_top_values_trim_groups_before_the_shuffle(spark):
    plan = P.top_values(spark.range(10))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_values_by_sketch_equal_the_full_count(spark, monkeypatch):
    """Frequent values are proven by their counts, few values by their sum; unique ones are counted whole."""
    i = F.col("id")
    df = spark.range(30_000).select(
        i.alias("unique"), F.when(i % 3 == 0, "often").when(i % 3 == 1, F.concat(F.lit("x"), (i % 50).cast("string"))).otherwise(
            F.concat(F.lit("rare"), i.cast("string"))).alias("mixed"),
        F.when(i % 7 != 0, F.when(i % 2 == 0, float("nan")).otherwise((i % 4).cast("double"))).alias("number"),
        F.array(i % 3).alias("nested"), F.lit(None).cast("int").alias("none"))
    want = rows(P.top_values(df, 4))
    counted = []
    whole = P._counted
    monkeypatch.setattr(P, "_counted", lambda d, f, wanted=None: counted.append((f.name, wanted is not None)) or whole(d, f, wanted))
    assert rows(P.top_values(df, 4, sketch_above=0)) == want
    assert [n for n, few in counted if not few] == ["unique"]
    assert rows(P.top_values(df, 4, ["mixed", "absent"], sketch_above=0)) == [r for r in want if r[0] == "mixed"]


def test_report_values_at_any_depth(spark):
    df = spark.sql("""SELECT named_struct('a', array(double('NaN'), 1.5D, NULL), 'm', map(date'2024-02-03', float('NaN')),
        'deep', array(named_struct('t', timestamp_ntz'2024-01-02 03:04:05.6', 'b', X'4142', 'd', 1.50BD)),
        'gone', CAST(NULL AS struct<x: double>)) AS r, double('NaN') AS n, date'2024-05-06' AS d""")
    text = df.select(P.as_text(F.col("r"), df.schema["r"].dataType)).first()[0]
    assert json.loads(text) == {"a": [None, 1.5, None], "m": {"2024-02-03": None}, "gone": None,
                                "deep": [{"t": "2024-01-02T03:04:05.600000", "b": "AB", "d": 1.5}]}
    row = P.sanitised_rows(df).first()
    assert row["n"] is None and row["d"] == "2024-05-06" and row["r"]["a"] == [None, 1.5, None] and row["r"]["gone"] is None
