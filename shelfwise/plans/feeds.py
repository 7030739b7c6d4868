"""Product-feed and task-list queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.operators import feed as O
from shelfwise.plans import adapters as A
from shelfwise.plans.adapters import Tables
from shelfwise.plans.oracle_tables import pick
from shelfwise.plans.registry import query

RULES = O.FeedRules().override({"valid_categories": list(A.FEED_TYPES)})

_K = "p_partkey"
_SPECS = {
    "memory": pick(("128 MB", "16 GB", "2 TB", "16 gb", "1.2.3 GB"), f"{_K} % 5"),
    "storage": f"({_K} % 9) || 'TB'",
    "clock_speed": f"({_K} % 7 * 400) || ' MHz'",
    "memory_speed": f"({_K} % 3 * 1600) || ' MHz'",
    "power_draw": f"({_K} % 11 * 125) || ' mW'",
    "tdp": "'350 W'", "performance": "'500 TFLOPS'", "bandwidth": "'900 GB/s'",
    "cores": f"CAST({_K} AS VARCHAR)"}
# Expected texts, worked out per key.
_STANDARD = {
    **_SPECS,
    "memory": pick(("0.12 GB", "16.00 GB", "2048.00 GB", "16 gb", "1.2.3 GB"), f"{_K} % 5"),
    "storage": f"printf('%.2f GB', CAST({_K} % 9 * 1024 AS DOUBLE))",
    "clock_speed": f"printf('%.2f GHz', {_K} % 7 * 0.4::DOUBLE)",
    "memory_speed": f"printf('%.2f GB', {_K} % 3 * 1.6::DOUBLE)",
    # 0.125 W steps: ties go to the even digit.
    "power_draw": pick(("0.00 W", "0.12 W", "0.25 W", "0.38 W", "0.50 W", "0.62 W", "0.75 W",
                        "0.88 W", "1.00 W", "1.12 W", "1.25 W"), f"{_K} % 11")}
_STRICT = {**_STANDARD, "memory_speed": _SPECS["memory_speed"]}
_PRICE = f"""CASE WHEN {_K} % 11 = 0 THEN NULL WHEN {_K} % 13 = 0 THEN 'NaN'::DOUBLE
    WHEN {_K} % 17 = 0 THEN -100.0 ELSE CAST(p_size AS DOUBLE) END"""
_CURRENCY = pick(("USD", "EUR", "GBP", "JPY", "CNY", "BTC"), f"{_K} % 6")
_STOCK = f"[true, false, true, NULL, false][CAST({_K} % 5 AS INTEGER) + 1]"
_ID = f"'S-' || {_K}"
_CATEGORY = f"CASE WHEN {_K} % 23 = 0 THEN '' ELSE p_type END"

_CATEGORY_LIST = ", ".join(A.FEED_TYPES)
_CURRENCY_LIST = ", ".join(K.CURRENCIES)
_ERRORS = f"""[x FOR x IN [
    CASE WHEN {_K} % 19 = 0 THEN 'Missing required field: name' END,
    CASE WHEN {_K} % 11 = 0 THEN 'Field ''price'' must be of type float' END,
    CASE WHEN {_K} % 5 = 3 THEN 'Field ''in_stock'' must be of type bool' END,
    CASE WHEN {_K} % 29 = 0 THEN 'Field ''specifications'' must be of type dict' END,
    CASE WHEN {_K} % 31 = 0 THEN 'Missing required field: images' END,
    CASE WHEN length({_ID}) < 6 THEN 'Invalid product_id format: ' || {_ID} END,
    CASE WHEN {_K} % 23 <> 0 AND p_type NOT IN ({", ".join(f"'{c}'" for c in A.FEED_TYPES)})
         THEN 'Invalid category: ' || p_type || '. Must be one of: {_CATEGORY_LIST}' END,
    CASE WHEN {_K} % 11 <> 0 AND {_K} % 13 = 0
         THEN 'Price out of valid range (0-1000000): NaN'
         WHEN {_K} % 11 <> 0 AND {_K} % 17 = 0
         THEN 'Price out of valid range (0-1000000): -100.0' END,
    CASE WHEN {_K} % 6 = 5 THEN 'Invalid currency: BTC. Must be one of: {_CURRENCY_LIST}' END
    ] IF x IS NOT NULL]"""


def _text(specs: dict[str, str]) -> str:
    """A specification map as text, keys in order."""
    items = " || '; ' || ".join(f"'{k}=' || {v}" for k, v in sorted(specs.items()))
    return f"CASE WHEN {_K} % 29 <> 0 THEN {items} END"


def _map_text(specs):
    entries = F.array_sort(F.map_entries(specs))
    return F.array_join(F.transform(entries, lambda e: F.concat(
        e["key"], F.lit("="), e["value"])), "; ")


_FLAGGED = f"SELECT {_ID} AS product_id, {_ERRORS} AS errors FROM part"


ERRORS_SQL = f"""SELECT product_id, CAST(pos - 1 AS INTEGER) AS pos, errors[pos] AS error
    FROM (SELECT *, unnest(range(1, len(errors) + 1)) AS pos FROM ({_FLAGGED}))"""


_NO_CATEGORY = f"CASE WHEN {_K} % 23 = 0 THEN 'Missing required field: category' END,"
CSV_ERRORS_SQL = ERRORS_SQL.replace(
    f"CASE WHEN {_K} % 11 = 0 THEN 'Field", f"{_NO_CATEGORY} CASE WHEN {_K} % 11 = 0 THEN 'Field")


@query("feed_errors", ERRORS_SQL)
def feed_errors(t: Tables) -> DataFrame:
    return O.error_table(O.validate_feed(t.feed(), RULES))


@query("feed_clean", f"""SELECT {_ID} AS product_id,
    CASE WHEN {_K} % 19 <> 0 THEN p_name END AS name, {_CATEGORY} AS category, p_brand AS brand,
    p_name AS description, {_PRICE} AS price, {_CURRENCY} AS currency, {_STOCK} AS in_stock,
    {_text(_STANDARD)} AS specifications,
    CASE WHEN {_K} % 31 <> 0 THEN {_K} || '.png' END AS images,
    len({_ERRORS}) AS error_count FROM part""")
def feed_clean(t: Tables) -> DataFrame:
    cleaned = O.validate_feed(t.feed(), RULES)
    return cleaned.select(
        "product_id", "name", "category", "brand", "description", "price", "currency",
        "in_stock", _map_text(F.col("specifications")).alias("specifications"),
        F.array_join("images", ",").alias("images"),
        F.size("errors").cast("bigint").alias("error_count"))


@query("feed_specs", f"SELECT {_ID} AS product_id, {_text(_STANDARD)} AS specifications FROM part")
def feed_specs(t: Tables) -> DataFrame:
    """The factor of the written unit with the label the key asks for."""
    return O.validate_feed(t.feed(), RULES).select(
        "product_id", _map_text(F.col("specifications")).alias("specifications"))


@query("feed_specs_strict",
       f"SELECT {_ID} AS product_id, {_text(_STRICT)} AS specifications FROM part")
def feed_specs_strict(t: Tables) -> DataFrame:
    """Converted only where unit and key are of one family."""
    rules = O.FeedRules(categories=A.FEED_TYPES, strict_units=True)
    return O.validate_feed(t.feed(), rules).select(
        "product_id", _map_text(F.col("specifications")).alias("specifications"))


_KIND = """CASE WHEN error LIKE 'Invalid product_id%' THEN 'Invalid product_id format'
    WHEN error LIKE 'Invalid category%' THEN 'Invalid category'
    WHEN error LIKE 'Price out%' THEN 'Price out of valid range'
    WHEN error LIKE 'Invalid currency%' THEN 'Invalid currency' ELSE error END"""


@query("feed_error_summary", f"""SELECT {_KIND} AS error_kind, count(*) AS error_count,
    count(DISTINCT product_id) AS product_count
    FROM (SELECT product_id, unnest(errors) AS error FROM ({_FLAGGED})) GROUP BY 1""")
def feed_error_summary(t: Tables) -> DataFrame:
    return O.error_summary(O.validate_feed(t.feed(), RULES))


_TASKS = f"""SELECT 'T' || {_K} AS "Task ID", CASE WHEN {_K} % 13 <> 0 THEN p_name END
      AS "Task Name",
    CASE WHEN {_K} % 17 = 0 THEN '  ' ELSE p_type END AS "Description",
    CASE WHEN {_K} % 19 = 0 THEN 'NaN' ELSE p_brand END AS "Owner",
    {pick(("2h", "3 h", "2 hours", "", " 4H ", "nan"), f"{_K} % 6")} AS "Estimated Time" FROM part"""
_BLANK = "(trim(coalesce(\"{c}\", '')) = '' OR lower(trim(\"{c}\")) = 'nan')"
_ISSUES = "concat_ws('; ', " + ", ".join(
    f"CASE WHEN {_BLANK.format(c=c)} THEN 'Missing {c}' END" for c in K.TASK_COLUMNS) + f""",
    CASE WHEN NOT regexp_full_match(lower(trim("Estimated Time")), '[0-9]+\\s*h')
         THEN '{K.TASK_DURATION_MESSAGE.replace("'", "''")}' END)"""


@query("tasks_split", f"""SELECT *, {_ISSUES} AS "Issues" FROM ({_TASKS})""")
def tasks_split(t: Tables) -> DataFrame:
    valid, invalid = O.split_tasks(t.tasks())
    return valid.withColumn("Issues", F.lit("")).unionByName(invalid)
