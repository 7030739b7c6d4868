"""Retail tables derived from the given ones, over all their rows.

The given tables have no defects, so defects are derived from the keys by fixed expressions;
``oracle_tables`` states the same expressions in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise import constants as K
from shelfwise.operators.joins import lookup_join

# Fixed values of the derived tables.
RETURN_CODES = (
    "BATTERY_DRAIN", "CHANGED_MIND", "COMPLEX_UI", "DAMAGED_IN_TRANSIT", "DEFECT",
    "DID_NOT_MEET_EXPECTATIONS", "DOA", "DOCUMENTATION_CONFUSING", "FAN_NOISE", "HEAVY",
    "INCOMPATIBLE", "NOISE/COIL_WHINE", "OVERHEATING", "SCREEN_ISSUE", "SETUP_DIFFICULT",
    "SPEAKER_DISTORTION", "UNDERPOWERED_SUPPLY",
)
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
FEED_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO")
FIRST_WORDS = ("blue", "cold", "hot", "large", "new", "old", "red", "small")
LAST_WORDS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
WINDOW = ("1997-01-01", "1999-12-31")
AS_OF = "2024-02-01"
ORPHAN = 1_000_000_000


# Schemas of the given tables; declaring them spares a pass over the file footers per read.
RAW = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def pick(values, index: Column) -> Column:
    """The value at a zero-based index of a short literal list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def every(key: str, n: int) -> Column:
    """Whether a key is a multiple of n: marks the rows that get a defect."""
    return F.col(key) % n == 0


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._products: int | None = None

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW[name]).parquet(f"{self.folder}/{name}.parquet")

    # ---- dimension tables ----

    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"), F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("price"))

    def catalog(self) -> DataFrame:
        return self.products().select("id", "name", "category", "price",
                                      F.col("name").alias("description"), F.col("id").alias("pos"))

    def product_records(self) -> DataFrame:
        """Products with quality defects, as the post-clean suite sees them."""
        k = F.col("p_partkey")
        return self.raw("part").select(
            F.when(~every("p_partkey", 37), k).alias("id"),
            F.when(~every("p_partkey", 23), F.col("p_brand")).alias("brand"),
            F.when(every("p_partkey", 29), "").otherwise(F.col("p_name")).alias("name"),
            F.concat(F.lit("SKU-"), k.cast("string")).alias("sku"),
            F.when(every("p_partkey", 31), "").otherwise(F.col("p_type")).alias("model"),
            F.when(~every("p_partkey", 5), F.col("p_size") / 8.0).alias("average_rating"),
            F.when(every("p_partkey", 41), "n/a").otherwise("2024-01-05 10:00:00")
            .alias("created_at"),
            F.lit("2024-01-06 11:30:00").alias("updated_at"),
            (k % 2 == 0).alias("is_active"),
            F.when(~every("p_partkey", 3), k % 4 == 0).alias("is_featured"))

    def anomaly_products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"),
            F.when(~every("p_partkey", 41), F.col("p_type")).alias("category_id"),
            F.col("p_brand").alias("brand"), F.col("p_name").alias("name"))

    def users(self) -> DataFrame:
        k, text = F.col("c_custkey"), F.col("c_custkey").cast("string")
        return self.raw("customer").select(
            k.alias("id"),
            F.when(every("c_custkey", 7), "").otherwise(
                F.concat(F.lit("user"), text, F.lit("@shop.example"))).alias("email"),
            F.col("c_name").alias("username"),
            F.when(~every("c_custkey", 19), F.col("c_mktsegment")).alias("first_name"),
            F.concat(F.lit("No "), text).alias("last_name"),
            F.when(every("c_custkey", 11), "").otherwise("*").alias("password"),
            (F.col("c_acctbal") > 0).alias("active"),
            pick(("admin", "user", "guest", "root"), k % 4).alias("role"),
            F.when(every("c_custkey", 13), "yesterday").otherwise("2023-05-01")
            .alias("create_time"),
            F.lit("2023-06-01 08:00:00").alias("update_time"))

    def legacy_users(self) -> DataFrame:
        """Several rows per user id, some without id or with a bad address."""
        k = F.col("c_custkey")
        return self.raw("customer").select(
            F.when(~every("c_custkey", 17), F.floor(k / 3).cast("bigint")).alias("user_id"),
            F.when(every("c_custkey", 7), "no address").otherwise(
                F.concat(F.lit("u"), k.cast("string"), F.lit("@shop.example"))).alias("email"),
            F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("name"),
            (F.lit(1000) - F.floor(k / 2)).cast("bigint").alias("updated"))

    # ---- sales ----

    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("created_at"))

    def order_items(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            (F.col("l_quantity").cast("int") % 3 + 1).alias("quantity"))

    def returns(self) -> DataFrame:
        """Returned line items, with the ordering user."""
        code = pick(RETURN_CODES, (F.col("l_partkey") + F.col("l_linenumber")) % 17)
        lines = self.raw("lineitem").filter(F.col("l_returnflag") == "R").select(
            "l_orderkey", "l_linenumber", F.col("l_orderkey").alias("id"),
            F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("created_at"),
            F.when(every("l_orderkey", 29), F.lower(code))
            .when(~every("l_orderkey", 43), code).alias("reason"))
        buyers = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                           F.col("o_custkey").alias("user_id"))
        return lookup_join(lines, buyers, "l_orderkey", "inner",
                           spread=["product_id", "l_linenumber"]).select(
            "id", "product_id", "user_id", "created_at", "reason")

    def payments(self) -> DataFrame:
        status = pick(("SUCCESS", "PENDING", "FAILED"), F.col("o_orderkey") % 3)
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"),
            F.when(~every("o_orderkey", 31), F.col("o_custkey")).alias("user_id"),
            F.when(every("o_orderkey", 37), -F.col("o_totalprice"))
            .when(~every("o_orderkey", 41), F.col("o_totalprice")).alias("amount"),
            F.when(every("o_orderkey", 23), "UNKNOWN").when(~every("o_orderkey", 29), status)
            .alias("payment_status"),
            F.col("o_orderdate").alias("created_at"))

    # ---- carts, wishes and other user activity: every event is one row ----

    def cart_item(self) -> DataFrame:
        e = F.col("event_id")
        return self.raw("events").select(
            F.when(every("event_id", 29), e - 1).otherwise(e).alias("id"),
            F.when(~every("event_id", 31), F.col("user_id")).alias("cart_id"),
            self._wanted_product().alias("product_id"),
            (self._k() - 10).alias("quantity"),
            F.when(~every("event_id", 17), F.col("value") - 5).alias("price"),
            F.col("ts").alias("updated_at"),
            F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")).alias("status"),
            F.col("ts").alias("last_updated"))

    def wishlist(self) -> DataFrame:
        """One wish per event; names differ from the product's now and then."""
        wishes = self.raw("events").select(
            F.col("event_id").alias("id"), "user_id", self._wanted_product().alias("product_id"),
            F.col("value").alias("price"), (F.col("value") * 0.5 - 5).alias("discounted_price"),
            F.when(~every("event_id", 23), self._k() / 10.0).alias("rating"),
            (self._k() - 2).alias("review_count"), F.col("ts").alias("create_time"))
        named = self.products().select(F.col("id").alias("product_id"), "name", "brand")
        joined = lookup_join(wishes, named, "product_id", "left", spread=["id"])
        return joined.select(
            "id", "user_id", "product_id",
            F.when(every("id", 13), F.upper("name")).otherwise(F.col("name")).alias("name"),
            F.when(every("id", 11), F.concat(F.col("brand"), F.lit("-x")))
            .otherwise(F.col("brand")).alias("brand"),
            "price", "discounted_price", "rating", "review_count", "create_time")

    def _k(self) -> Column:
        return F.regexp_extract("props", "[0-9]+", 0).cast("int")

    def products_count(self) -> int:
        if self._products is None:
            self._products = max(self.raw("part").count(), 1)
        return self._products

    def any_product(self) -> Column:
        """The product of an event, over the whole catalog."""
        return F.col("event_id") * 7 % F.lit(self.products_count())

    def _wanted_product(self) -> Column:
        return self.any_product() + F.when(every("event_id", 19), ORPHAN).otherwise(0)

    def activity(self, event_type: str) -> DataFrame:
        return self.raw("events").filter(F.col("event_type") == event_type).select(
            "user_id", F.col("event_id").alias("id"), F.col("ts").alias("at"))

    def latest_activity(self, event_type: str) -> DataFrame:
        """One row per user: the newest event of a type."""
        return self.activity(event_type).groupBy("user_id").agg(
            F.max_by("id", F.struct("at", "id")).alias("id"), F.max("at").alias("at"))

    # ---- product children ----

    def images(self) -> DataFrame:
        return self._children(F.col("p_partkey") % 3, "image_no").withColumn(
            "url", F.concat(F.lit("img/"), F.col("product_id").cast("string"), F.lit("/"),
                            F.col("image_no").cast("string")))

    def specs(self) -> DataFrame:
        return self._children((F.col("p_partkey") + 1) % 3, "spec_no").withColumn(
            "text", F.concat(F.lit("spec "), F.col("spec_no").cast("string")))

    def _children(self, count: Column, number: str) -> DataFrame:
        """0, 1 or 2 numbered rows per product."""
        rows = F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), count.cast("int"))
        return self.raw("part").select(F.col("p_partkey").alias("product_id"),
                                       F.explode(rows).alias(number))

    def inventories(self) -> DataFrame:
        """Stock as the line items show it; a product never sold has no row."""
        return self.raw("lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(
            F.count("*").alias("movements"), F.max("l_shipdate").alias("last_movement"))

    # ---- feeds ----

    def feed(self) -> DataFrame:
        """A raw product feed: every field is text."""
        k = F.col("p_partkey")
        t = k.cast("string")
        specs = F.to_json(F.create_map(
            F.lit("memory"), pick(("128 MB", "16 GB", "2 TB", "16 gb", "1.2.3 GB"), k % 5),
            F.lit("storage"), F.concat((k % 9).cast("string"), F.lit("TB")),
            F.lit("clock_speed"), F.concat((k % 7 * 400).cast("string"), F.lit(" MHz")),
            F.lit("memory_speed"), F.concat((k % 3 * 1600).cast("string"), F.lit(" MHz")),
            F.lit("power_draw"), F.concat((k % 11 * 125).cast("string"), F.lit(" mW")),
            F.lit("tdp"), F.lit("350 W"), F.lit("performance"), F.lit("500 TFLOPS"),
            F.lit("bandwidth"), F.lit("900 GB/s"), F.lit("cores"), t))
        return self.raw("part").select(
            F.concat(F.lit("S-"), t).alias("product_id"),
            F.when(~every("p_partkey", 19), F.col("p_name")).alias("name"),
            F.when(every("p_partkey", 23), "").otherwise(F.col("p_type")).alias("category"),
            F.col("p_brand").alias("brand"), F.col("p_name").alias("description"),
            F.when(every("p_partkey", 11), "about 9").when(every("p_partkey", 13), "NaN")
            .when(every("p_partkey", 17), "-100").otherwise(
                F.col("p_size").cast("string")).alias("price"),
            pick(("USD", "EUR", "GBP", "JPY", "CNY", "BTC"), k % 6).alias("currency"),
            pick(("Yes", "no", "TRUE", "maybe", "0"), k % 5).alias("in_stock"),
            F.when(every("p_partkey", 29), "not json").otherwise(specs).alias("specifications"),
            F.when(every("p_partkey", 31), F.lit(None)).otherwise(
                F.concat(F.lit('["'), t, F.lit('.png"]'))).alias("images"))

    def tasks(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").select(
            F.concat(F.lit("T"), k.cast("string")).alias("Task ID"),
            F.when(~every("p_partkey", 13), F.col("p_name")).alias("Task Name"),
            F.when(every("p_partkey", 17), "  ").otherwise(F.col("p_type")).alias("Description"),
            F.when(every("p_partkey", 19), "NaN").otherwise(F.col("p_brand")).alias("Owner"),
            pick(("2h", "3 h", "2 hours", "", " 4H ", "nan"), k % 6).alias("Estimated Time"))

    # ---- events ----

    def engine_events(self) -> DataFrame:
        """Events with the engine's type names and the product they concern."""
        kind = F.col("event_type")
        return self.raw("events").select(
            "event_id", "ts", "user_id",
            F.when(kind == "view", K.VIEW_EVENT).when(kind == "purchase", K.PURCHASE_EVENT)
            .otherwise(kind).alias("event_type"),
            self.any_product().alias("product_id"))

    def profiles(self) -> DataFrame:
        """Profiles of the users in events; one user in ten has none.

        Two categories and two features each; the second feature is part of a word, in capitals.
        """
        users = self.raw("events").select("user_id").distinct()
        return users.filter(~self.anonymous()).select(
            "user_id", *self.profile_columns(F.col("user_id")))

    @staticmethod
    def profile_columns(u: Column) -> list[Column]:
        return [F.array(pick(PART_TYPES, u % 6), pick(PART_TYPES, (u + 2) % 6))
                .alias("preferred_categories"),
                F.array(pick(FIRST_WORDS, u % 8),
                        F.upper(F.substring(pick(LAST_WORDS, u % 7), 1, 3)))
                .alias("preferred_features"),
                F.lit(0.5).alias("price_sensitivity")]

    def anonymous(self) -> Column:
        """Users who gave no profile; their events stay, without one."""
        return F.col("user_id") % 10 == 9

    def views(self) -> DataFrame:
        """View events with their product's category and the user's preferences."""
        from shelfwise.operators.recommend import preference_columns
        viewed = self.engine_events().filter(F.col("event_type") == K.VIEW_EVENT)
        products = self.catalog().select(F.col("id").alias("product_id"),
                                         F.col("name").alias("product_name"), "category")
        cats, feats, _ = self.profile_columns(F.col("user_id"))
        known = ~self.anonymous()
        preferences = preference_columns(F.when(known, cats), F.when(known, feats))
        joined = lookup_join(viewed, products, "product_id", "inner", spread=["event_id"])
        return joined.select(
            "event_id", "ts", "user_id", "product_id", "product_name", "category",
            known.alias("has_user_profile"), *[c.alias(n) for n, c in preferences.items()])

    @staticmethod
    def fill_key(seed: int = 17) -> Column:
        """A fill order that SQL can repeat: an affine permutation."""
        return (F.col("pos") * 7919 + seed) % 1000003
