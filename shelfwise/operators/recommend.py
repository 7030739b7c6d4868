"""Content recommendations in strict tiers, from candidate lists of bounded length.

Tiers of an event: (1) products of a preferred category, (2) products whose description contains
a preferred feature, (3) products of the viewed product's category, (4) the fill order. Inside a
tier catalog order (``pos``) decides; the viewed product is left out; the first k remain.

For k results it is enough to know the first k + 1 products of every list: if a product of the
true result were later in its list, the k others before it (one may be the viewed product)
would outrank it. So lists are built once per category, per feature and per distinct set of
preferences, and an event only merges three short arrays; the catalog never meets the events.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.operators.joins import lookup_join, settled
from shelfwise.sources.storage import cut_lineage, lasting

PREFERENCE = ["categories", "features"]
NO_PROFILE_TIER, FILL_TIER = 3, 4
PRODUCT = ("id", "name", "category", "price", "description")
GRAM = 3
FEW_FEATURES = 200  # looked for in one scan of the catalog
TEXT_ARRAY = "array<string>"


def _product() -> Column:
    return F.struct(*PRODUCT)


def preference_columns(categories: Column, features: Column) -> dict[str, Column]:
    """A profile's preferences as sets: what two profiles share decides, not its order."""
    cats = F.array_sort(F.array_distinct(F.array_compact(
        F.coalesce(categories, F.array().cast(TEXT_ARRAY)))))
    feats = F.array_sort(F.array_distinct(F.transform(F.array_compact(
        F.coalesce(features, F.array().cast(TEXT_ARRAY))), F.lower)))
    return {"categories": cats, "features": feats}


def first_per_group(df: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each group; the rank filter also trims groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def _entry(x: Column) -> Column:
    return F.struct(*[x["product"][f].alias(f) for f in PRODUCT], x["tier"].alias("tier"))


def _listed(df: DataFrame, group: list[str], name: str) -> DataFrame:
    """Short groups as arrays of products with their tier, ordered by (tier, pos)."""
    return df.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(
        F.struct("tier", "pos", "product"))), _entry).alias(name))


def category_rows(catalog: DataFrame, k: int) -> DataFrame:
    """(category, pos, product): the first k + 1 products per category."""
    rows = catalog.filter(F.col("category").isNotNull()).select(
        "category", "pos", _product().alias("product"))
    return first_per_group(rows, ["category"], ["pos"], k + 1)


def category_lists(catalog: DataFrame, k: int) -> DataFrame:
    """(category, same_category): the same products as one array per category."""
    return settled(listed_categories(category_rows(catalog, k)))


def listed_categories(rows: DataFrame) -> DataFrame:
    return _listed(rows.withColumn("tier", F.lit(NO_PROFILE_TIER)), ["category"], "same_category")


def fill_list(catalog: DataFrame, k: int, fill_key: Column) -> DataFrame:
    """One row (fill): the first k + 1 products of the fill order."""
    first = (catalog.select(fill_key.alias("_key"), "pos", _product().alias("product"))
             .orderBy("_key", "pos").limit(k + 1))
    return first.agg(F.transform(
        F.array_sort(F.collect_list(F.struct("_key", "pos", "product",
                                             F.lit(FILL_TIER).alias("tier")))), _entry)
        .alias("fill"))


def seeded_fill(seed: int = 0) -> Column:
    """A fixed shuffle of the catalog per seed."""
    return F.xxhash64(F.lit(seed), F.col("id"))


def _text() -> Column:
    return F.lower(F.coalesce("description", F.lit("")))


def _pieces(value: Column, size: int) -> Column:
    """All pieces of a text of one size; the empty piece is in every text."""
    if size == 0:
        return F.array(F.lit(""))
    return F.when(F.length(value) >= size, F.transform(
        F.sequence(F.lit(1), F.length(value) - size + 1),
        lambda i: F.substring(value, i, F.lit(size)))).otherwise(F.array().cast(TEXT_ARRAY))


def catalog_pieces(catalog: DataFrame, sizes: Sequence[int] = range(GRAM + 1)) -> DataFrame:
    """(id, piece): the distinct pieces of each description."""
    return catalog.select("id", F.explode(F.array_distinct(F.concat(
        F.array().cast(TEXT_ARRAY), *[_pieces(_text(), n) for n in sizes]))).alias("piece"))


def feature_matches(catalog: DataFrame, features: DataFrame) -> DataFrame:
    """(feature, id, pos, category, product) where the description contains the feature.

    ``features`` holds distinct lower-case features.
    """
    pairs = marked(catalog, features).select(F.explode("matched").alias("feature"), "id", "pos", "category")
    return lookup_join(pairs, catalog.select("id", _product().alias("product")), "id", "inner", spread=["feature"])


def marked(catalog: DataFrame, features: DataFrame, index: Callable[[], "Pieces"] | None = None) -> DataFrame:
    """(id, pos, category, matched): products with any of the features, and which of them, in order.

    A few features are all looked for in one scan of the catalog. Many are found by an
    index of pieces, which ``index`` may have ready.
    """
    few = sorted(r[0] for r in features.select("feature").limit(FEW_FEATURES + 1).collect())
    columns = ["id", "pos", "category"]
    if len(few) <= FEW_FEATURES:
        texts = catalog.select(*columns, _text().alias("_text"))
        held = F.array(*[F.when(F.contains("_text", F.lit(f)), F.lit(f)) for f in few]).cast(TEXT_ARRAY)
        return texts.select(*columns, F.array_compact(held).alias("matched")).filter(F.size("matched") > 0)
    pairs = _by_pieces(catalog, features, index() if index else Pieces.of(catalog, features))
    return pairs.groupBy("id").agg(F.first("pos").alias("pos"), F.first("category").alias("category"),
                                   F.array_sort(F.collect_set("feature")).alias("matched"))


@dataclass(frozen=True)
class Pieces:
    """The pieces of all descriptions, up to GRAM characters long, and how many products have each."""

    pieces: DataFrame
    frequency: DataFrame

    @classmethod
    def of(cls, catalog: DataFrame, features: DataFrame | None = None) -> "Pieces":
        """For some features only their own sizes and pieces count; for any, all are written."""
        if features is None:
            pieces = cut_lineage(catalog_pieces(catalog))
            return cls(pieces, cut_lineage(pieces.groupBy("piece").agg(F.count("*").alias("n"))))
        # At most four sizes: 0 (the empty feature, found in every text) to 3.
        sizes = sorted(r[0] for r in features.select(
            F.least(F.length("feature"), F.lit(GRAM))).distinct().collect())
        pieces = catalog_pieces(catalog, sizes)
        wanted = settled(_feature_pieces(features).select("piece").distinct())
        return cls(pieces, lookup_join(pieces, wanted, "piece", "inner", spread=["id"]).groupBy(
            "piece").agg(F.count("*").alias("n")))


def _feature_pieces(features: DataFrame) -> DataFrame:
    own = F.when(F.length("feature") >= GRAM, _pieces(F.col("feature"), GRAM)).otherwise(
        F.array("feature"))
    return features.select("feature", F.explode(F.array_distinct(own)).alias("piece"))


def _by_pieces(catalog: DataFrame, features: DataFrame, index: Pieces) -> DataFrame:
    """(feature, id, pos, category): substring search as an equi-join.

    Each feature is looked up under its rarest piece of three characters (or itself when shorter),
    and the few candidates are verified.
    """
    # A piece the catalog lacks has no frequency, and its feature no match.
    anchors = (lookup_join(_feature_pieces(features), index.frequency, "piece", "inner", spread=["feature"])
               .groupBy("feature").agg(F.min_by("piece", F.struct("n", "piece")).alias("piece")))
    candidates = lookup_join(index.pieces, settled(anchors), "piece", "inner", spread=["id"],
                             unique=False)
    details = catalog.select("id", "pos", "category", _text().alias("_text"))
    found = lookup_join(candidates.select("id", "feature"), details, "id", "inner",
                        spread=["feature"])
    return found.filter(F.contains("_text", "feature")).select("feature", "id", "pos", "category")


def preference_sets(views: DataFrame) -> DataFrame:
    """The distinct preferences among events with a profile, found in one pass over them."""
    return cut_lineage(views.filter("has_user_profile").select(*PREFERENCE).distinct())


@dataclass(frozen=True)
class Preferences:
    """The distinct preference sets of some views, and the products that have any of their features."""

    sets: DataFrame
    marked: DataFrame
    shelf: "Shelf | None" = None

    @classmethod
    def of(cls, views: DataFrame, catalog: DataFrame,
           shelf: "Shelf | None" = None) -> "Preferences":
        sets = preference_sets(views)
        features = sets.select(F.explode("features").alias("feature")).distinct()
        return cls(sets, cut_lineage(marked(catalog, features)) if shelf is None else shelf.marks(features), shelf)

    def kept(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A small table that depends on the marked products alone: a shelf makes it once for the marks it keeps."""
        if self.shelf is None or self.marked is not self.shelf.marked:
            return settled(make())
        if name not in self.shelf.of_marked:
            with lasting():
                self.shelf.of_marked[name] = cut_lineage(make())
        return self.shelf.of_marked[name]


@dataclass
class Shelf:
    """What a catalog gives whatever the events are, written once and used by every batch."""

    catalog: DataFrame
    category_rows: DataFrame
    same_category: DataFrame
    fill: DataFrame
    category_sizes: DataFrame
    known: frozenset[str] = frozenset()
    marked: DataFrame | None = None
    pieces: Pieces | None = None
    of_marked: dict[str, DataFrame] = field(default_factory=dict)

    @classmethod
    def of(cls, catalog: DataFrame, k: int, fill_key: Column | None = None) -> "Shelf":
        rows = cut_lineage(category_rows(catalog, k))
        return cls(catalog, rows, cut_lineage(listed_categories(rows)),
                   cut_lineage(fill_list(catalog, k, seeded_fill() if fill_key is None
                                         else fill_key)), cut_lineage(category_sizes(catalog)))

    def index(self) -> Pieces:
        """Made when a batch first has too many features for one scan."""
        if self.pieces is None:
            with lasting():
                self.pieces = Pieces.of(self.catalog)
        return self.pieces

    def marks(self, features: DataFrame) -> DataFrame:
        """The products with any of the features; the catalog is searched again only for features that are new."""
        few = frozenset(r[0] for r in features.limit(FEW_FEATURES + 1).collect())
        if len(few | self.known) > FEW_FEATURES:
            return cut_lineage(marked(self.catalog, features, self.index))
        if self.marked is None or not few <= self.known:
            self.known |= few
            every = features.sparkSession.createDataFrame([(f,) for f in sorted(self.known)], "feature string")
            with lasting():
                self.marked, self.of_marked = cut_lineage(marked(self.catalog, every)), {}
        return self.marked


def feature_rows(matches: DataFrame, catalog: DataFrame, k: int) -> DataFrame:
    """(feature, pos, product): the first k + 1 products per feature."""
    # Positions are ranked; only the few products that remain are looked up.
    ranked = settled(first_per_group(matches.select(F.explode("matched").alias("feature"), "id", "pos"),
                                     ["feature"], ["pos"], k + 1))
    return lookup_join(catalog.select("id", _product().alias("product")), ranked, "id", "inner",
                       unique=False).select("feature", "pos", "product")


def preferred_lists(preferences: DataFrame, by_category: DataFrame, by_feature: DataFrame, k: int) -> DataFrame:
    """(categories, features, preferred): the first k + 1 products of tiers 1 and 2."""
    tier1 = lookup_join(
        preferences.select(*PREFERENCE, F.explode("categories").alias("category")),
        by_category, "category", "inner", spread=PREFERENCE).select(
        *PREFERENCE, F.lit(1).alias("tier"), "pos", "product")
    tier2 = lookup_join(
        preferences.select(*PREFERENCE, F.explode("features").alias("feature")),
        by_feature, "feature", "inner",
        spread=PREFERENCE).select(*PREFERENCE, F.lit(2).alias("tier"), "pos", "product")
    # A product found twice counts in its better tier.
    best = (tier1.unionByName(tier2).groupBy(*PREFERENCE, F.col("product.id").alias("_id"))
            .agg(F.min("tier").alias("tier"), F.min("pos").alias("pos"),
                 F.first("product").alias("product")))
    short = first_per_group(best, PREFERENCE, ["tier", "pos"], k + 1)
    return settled(_listed(short, PREFERENCE, "preferred"))


def recommend(views: DataFrame, catalog: DataFrame, k: int = 3,
              fill_key: Column | None = None, preferences: Preferences | None = None,
              shelf: Shelf | None = None) -> DataFrame:
    """Add ``recommendations`` (array of product fields and ``tier``) to every view.

    ``views`` has event_id, product_id, category (of the viewed product), has_user_profile,
    categories and features; ``catalog`` has the product fields and ``pos``. Views without a
    profile get tiers 3 and 4. A ``shelf`` made for the same k and fill order saves the work on
    the catalog.
    """
    preferences = preferences or Preferences.of(views, catalog, shelf)
    by_category = category_rows(catalog, k) if shelf is None else shelf.category_rows
    same_category = category_lists(catalog, k) if shelf is None else shelf.same_category
    fill = (fill_list(catalog, k, seeded_fill() if fill_key is None else fill_key)
            if shelf is None else shelf.fill)
    by_feature = preferences.kept(f"first {k + 1}", lambda: feature_rows(preferences.marked, catalog, k))
    preferred = preferred_lists(preferences.sets, by_category, by_feature, k).withColumn("has_user_profile", F.lit(True))
    spread = ["event_id"]
    joined = lookup_join(views, preferred, [*PREFERENCE, "has_user_profile"], "left", spread)
    joined = lookup_join(joined, same_category, "category", "left", spread, keys_from=views)
    joined = joined.withColumn("fill", fill.scalar())
    return _merged(joined, views.columns, ["preferred", "same_category", "fill"], k)


def _merged(df: DataFrame, keep: list[str], lists: list[str], k: int) -> DataFrame:
    """The first k products over several lists, without the viewed one and without repeats.

    One fold that names each list once: nested filters would be copied wherever Catalyst inlines
    them.
    """
    none = F.array().cast(df.schema["fill"].dataType)
    chosen = F.aggregate(
        F.concat(*[F.coalesce(F.col(n), none) for n in lists]), none,
        lambda found, x: F.when(
            (F.size(found) >= k) | x["id"].eqNullSafe(F.col("product_id"))
            | F.exists(found, lambda y: y["id"] == x["id"]), found)
        .otherwise(F.concat(found, F.array(x))))
    return df.select(*keep, chosen.alias("recommendations"))


def exploded(recommended: DataFrame) -> DataFrame:
    """One row per recommendation: (event_id, rank, id, tier, ...)."""
    return (recommended.select("event_id", F.posexplode_outer("recommendations")
                               .alias("pos", "rec"))
            .filter(F.col("pos").isNotNull())
            .select("event_id", (F.col("pos") + 1).alias("rank"), "rec.*"))


# ---- relevance and scoring ----

def category_sizes(catalog: DataFrame) -> DataFrame:
    """(category, products)."""
    return catalog.filter(F.col("category").isNotNull()).groupBy("category").agg(
        F.count("*").alias("products"))


def matched_patterns(matches: DataFrame) -> DataFrame:
    """(matched, category, n): products per list of all features they have, and category."""
    return matches.groupBy("matched", "category").agg(F.count("*").alias("n"))


def feature_set_sizes(sets: DataFrame, patterns: DataFrame) -> DataFrame:
    """(features, category, products): how many products of a category have any feature of a set.

    Products are counted per pattern, the list of all features they have. A set meets each pattern that
    shares a feature once, at the first one they share; products and sets never meet.
    """
    each = patterns.select(F.explode("matched").alias("feature"), "matched", "category", "n")
    wanted = sets.select("features").distinct().select("features", F.explode("features").alias("feature"))
    met = lookup_join(wanted, each, "feature", "inner", spread=["features"], unique=False)
    first = F.array_min(F.array_intersect("features", "matched")) == F.col("feature")
    return met.filter(first).groupBy("features", "category").agg(F.sum("n").alias("products"))


def relevant_totals(preferences: Preferences, catalog: DataFrame, shelf: Shelf | None = None) -> DataFrame:
    """(categories, features, relevant_products): size of the union of all lists of a profile.

    By inclusion and exclusion: the products of the categories, and those with a feature, less those
    of the categories among them. All three are sums of counts; no list of products is formed.
    """
    sizes = category_sizes(catalog) if shelf is None else shelf.category_sizes
    patterns = preferences.kept("patterns", lambda: matched_patterns(preferences.marked))
    by_set = settled(feature_set_sizes(preferences.sets, patterns))
    wanted = preferences.sets.select(*PREFERENCE, F.explode("categories").alias("category"))
    of_category = lookup_join(wanted, settled(sizes), "category", "inner", spread=PREFERENCE)
    both = by_set.filter(F.col("category").isNotNull()).withColumnRenamed("products", "_both")
    own = lookup_join(of_category, both, ["features", "category"], "left", spread=PREFERENCE)
    none = F.lit(0).cast("bigint")
    summed = own.groupBy(*PREFERENCE).agg(
        F.sum(F.col("products") - F.coalesce("_both", none)).alias("_own"))
    featured = by_set.groupBy("features").agg(F.sum("products").alias("_featured"))
    joined = lookup_join(preferences.sets.join(summed, PREFERENCE, "left"), settled(featured), "features", "left",
                         spread=["categories"])
    return settled(joined.select(*PREFERENCE, (F.coalesce("_own", none) + F.coalesce("_featured", none))
                                 .alias("relevant_products")))


def event_counters(recommended: DataFrame, totals: DataFrame) -> DataFrame:
    """Counters per scored event (views with a profile).

    A recommended product is relevant exactly when it came in tier 1 or 2: a relevant product
    outside the short lists can never be among the first k.
    """
    scored = recommended.filter("has_user_profile")
    relevant = F.size(F.filter("recommendations", lambda r: r["tier"] <= 2)).cast("bigint")
    joined = lookup_join(scored, totals, PREFERENCE, "left", spread=["event_id"])
    return joined.select(
        "event_id", "user_id", "ts", F.size("recommendations").cast("bigint").alias("n_recs"),
        relevant.alias("n_relevant"), relevant.alias("n_relevant_products"),
        "relevant_products")


def user_counters(counters: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counters summed per user; relevant products count once, at the first non-zero event.

    ``by`` names further columns that depend on the user alone, such as a test variant.
    """
    first = F.min_by("relevant_products", F.when(
        F.col("relevant_products") > 0, F.struct("ts", "event_id")))
    return counters.groupBy(*by, "user_id").agg(
        F.sum("n_recs").alias("total_recommendations"),
        F.sum("n_relevant").alias("relevant_recommendations"),
        F.coalesce(first, F.lit(0).cast("bigint")).alias("total_relevant_products"),
        F.sum("n_relevant_products").alias("relevant_products_recommended"))


def with_scores(df: DataFrame) -> DataFrame:
    """Add precision, recall and F1 of the counters; 0 where undefined."""
    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(F.lit(0.0))

    p, r = F.col("precision"), F.col("recall")
    return (df.withColumns({
        "precision": share("relevant_recommendations", "total_recommendations"),
        "recall": share("relevant_products_recommended", "total_relevant_products")})
        .withColumn("f1", F.when(p + r > 0, F.lit(2.0) * (p * r) / (p + r))
                    .otherwise(F.lit(0.0))))


COUNTERS = ("total_recommendations", "relevant_recommendations", "total_relevant_products",
            "relevant_products_recommended")


def user_metrics(counters: DataFrame) -> DataFrame:
    return with_scores(user_counters(counters))


def global_metrics(counters: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Summary over all users, or one per value of the user columns in ``by``."""
    summed = user_counters(counters, by).groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c) for c in COUNTERS])
    return with_scores(summed)


def distinct_recall(recommended: DataFrame, totals: DataFrame) -> DataFrame:
    """Recall per user over distinct products: (user_id, distinct_relevant, relevant, recall)."""
    scored = recommended.filter("has_user_profile")
    hits = (scored.select("user_id", F.explode("recommendations").alias("r"))
            .filter("r.tier <= 2").groupBy("user_id", F.col("r.id").alias("id"))
            .agg(F.count("*").alias("n")).groupBy("user_id")
            .agg(F.count("*").alias("distinct_relevant")))
    with_total = lookup_join(scored.select("event_id", "user_id", *PREFERENCE), totals,
                             PREFERENCE, "left", spread=["event_id"])
    relevant = with_total.groupBy("user_id").agg(F.max("relevant_products").alias("relevant"))
    return (relevant.join(hits, "user_id", "left")
            .withColumn("distinct_relevant",
                        F.coalesce("distinct_relevant", F.lit(0).cast("bigint")))
            .withColumn("recall", F.when(F.col("relevant") > 0, F.col("distinct_relevant")
                                         .cast("double") / F.col("relevant"))
                        .otherwise(F.lit(0.0))))


def category_recommend(views: DataFrame, catalog: DataFrame, k: int = 3,
                       fill_key: Column | None = None) -> DataFrame:
    """The plain recommender: same category, then fill; profiles are ignored."""
    spread = ["event_id"]
    fill = fill_list(catalog, k, seeded_fill() if fill_key is None else fill_key)
    joined = lookup_join(views, category_lists(catalog, k), "category", "left", spread)
    joined = joined.withColumn("fill", fill.scalar())
    return _merged(joined, views.columns, ["same_category", "fill"], k)
