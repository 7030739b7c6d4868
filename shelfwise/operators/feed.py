"""Product-feed validation and task-list checks as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise import schemas
from shelfwise.functions.units import standard_specifications


@dataclass(frozen=True)
class FeedRules:
    categories: Sequence[str] = K.FEED_CATEGORIES
    product_id_pattern: str = K.PRODUCT_ID_PATTERN
    price_range: tuple[float, float] = K.PRICE_RANGE
    currencies: Sequence[str] = K.CURRENCIES
    strict_units: bool = False

    def override(self, config: Mapping) -> "FeedRules":
        """Rules with a configuration's categories replaced and its value rules merged in."""
        rules, changes = config.get("validation_rules", {}), {}
        if "valid_categories" in config:
            changes["categories"] = tuple(config["valid_categories"])
        if "product_id" in rules:
            changes["product_id_pattern"] = rules["product_id"]
        if "price" in rules:
            changes["price_range"] = tuple(rules["price"])
        if "currency" in rules:
            changes["currencies"] = tuple(rules["currency"])
        return replace(self, **changes)


def bool_word(value: Column) -> Column:
    """true/yes/1/y and false/no/0/n in any case; NULL for other words."""
    word = F.lower(value)
    return (F.when(word.isin(*K.TRUE_WORDS), F.lit(True))
            .when(word.isin(*K.FALSE_WORDS), F.lit(False)))


def _typed(df: DataFrame) -> dict[str, Column]:
    """The feed's raw text columns in their declared types; NULL where the text does not fit.

    A JSON document of another kind parses to NULL, as PERMISSIVE mode does.
    """
    typed = {name: F.col(name) for name, _ in K.FEED_FIELDS}
    typed["price"] = F.col("price").try_cast("double")
    typed["in_stock"] = bool_word(F.col("in_stock"))
    typed["specifications"] = F.from_json("specifications", schemas.SPECIFICATIONS)
    typed["images"] = F.from_json("images", schemas.IMAGES)
    return {name: typed[name] for name, _ in K.FEED_FIELDS if name in df.columns}


def _shown(number: float) -> str:
    return str(number)


def error_list(df: DataFrame, rules: FeedRules, raw: str = "raw") -> Column:
    """The errors of a row in order: fields, then id, category, price and currency.

    Columns hold the typed values; ``raw`` is a struct with the original texts.
    """
    errors = []
    for name, kind in K.FEED_FIELDS:
        if name not in df.columns:
            errors.append(F.lit(f"Missing required field: {name}"))
            continue
        text = F.col(f"{raw}.{name}")
        errors.append(
            F.when(text.isNull(), F.lit(f"Missing required field: {name}"))
            .when(F.col(name).isNull(), F.lit(f"Field '{name}' must be of type {kind}")))

    def present(name: str) -> Column:
        return F.col(name).isNotNull() & (F.col(name) != "")

    if "product_id" in df.columns:
        errors.append(F.when(
            present("product_id") & ~F.col("product_id").rlike(rules.product_id_pattern),
            F.concat(F.lit("Invalid product_id format: "), F.col("product_id"))))
    if "category" in df.columns:
        errors.append(F.when(
            present("category") & ~F.col("category").isin(*rules.categories),
            F.concat(F.lit("Invalid category: "), F.col("category"),
                     F.lit(". Must be one of: " + ", ".join(rules.categories)))))
    if "price" in df.columns:
        low, high = rules.price_range
        price = F.col("price")
        errors.append(F.when(
            price.isNotNull() & (F.isnan(price) | ~price.between(float(low), float(high))),
            F.concat(F.lit(f"Price out of valid range ({_shown(low)}-{_shown(high)}): "),
                     price.cast("string"))))
    if "currency" in df.columns:
        errors.append(F.when(
            present("currency") & ~F.col("currency").isin(*rules.currencies),
            F.concat(F.lit("Invalid currency: "), F.col("currency"),
                     F.lit(". Must be one of: " + ", ".join(rules.currencies)))))
    return F.array_compact(F.array(*errors))


def validate_feed(feed: DataFrame, rules: FeedRules = FeedRules()) -> DataFrame:
    """Typed, unit-standardised feed rows with their ``errors``; other columns pass through."""
    present = [n for n, _ in K.FEED_FIELDS if n in feed.columns]
    typed = feed.select("*", F.struct(*present).alias("raw")).withColumns(_typed(feed))
    flagged = typed.withColumn("errors", error_list(feed, rules))
    if "specifications" in present:
        flagged = flagged.withColumn("specifications", standard_specifications(
            F.col("specifications"), rules.strict_units))
    return flagged.drop("raw")


def error_table(validated: DataFrame, keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """(keys, pos, error): one row per error; duplicate product ids keep all their errors."""
    return validated.select(*keys, F.posexplode("errors").alias("pos", "error"))


def error_kind(error: Column) -> Column:
    """An error without its offending value."""
    return F.regexp_replace(F.regexp_replace(error, r"(?s)^(Invalid [a-z_]+( format)?): .*", "$1"),
                            r"(?s)^(Price out of valid range).*", "$1")


def error_summary(validated: DataFrame) -> DataFrame:
    """(error_kind, error_count, product_count), counted over failing rows."""
    kinds = validated.select("product_id", F.explode("errors").alias("error")).select(
        "product_id", error_kind(F.col("error")).alias("error_kind"))
    # Per (kind, product) first: copies of a product combine before any exact distinct count.
    return (kinds.groupBy("error_kind", "product_id").agg(F.count("*").alias("n"))
            .groupBy("error_kind").agg(F.sum("n").alias("error_count"),
                                       F.count("*").alias("product_count")))


# ---- task list ----

def with_task_issues(tasks: DataFrame) -> DataFrame:
    """Add ``Issues``: the row's faults joined by ``; ``, empty for a valid row."""
    def text(name: str) -> Column:
        return F.trim(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")))

    issues = [F.when((text(c) == "") | (F.lower(text(c)) == "nan"), F.lit(f"Missing {c}"))
              for c in K.TASK_COLUMNS]
    duration = F.lower(text("Estimated Time"))
    issues.append(F.when(~duration.rlike(r"^[0-9]+\s*h$"), F.lit(K.TASK_DURATION_MESSAGE)))
    return tasks.withColumn("Issues", F.concat_ws("; ", *issues))


def split_tasks(tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and invalid rows with their ``Issues``."""
    flagged = with_task_issues(tasks)
    return (flagged.filter(F.col("Issues") == "").drop("Issues"),
            flagged.filter(F.col("Issues") != ""))
