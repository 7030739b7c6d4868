"""URL filters from a tree of path templates per host.

Lists of rules decide the urls that they fit. The others are judged by templates. The
path is a row of segments, and the templates of a host form a tree:

1. Variable segments become wildcards: runs of digits at once, and below each node the values that
   have fewer than ``MIN_PAGES`` pages (or less than ``min_share`` of the node's pages, 0 for no such bound).
2. Branches below the same node with similar labels merge: in ``BINS`` steps of their smoothed share of
   blocked pages, one step after the other joins the branch before it while its share and the pooled share of that
   branch differ by less than ``APART`` standard errors. So a template is judged by all pages of its merged branch.
3. A template is rejected if its smoothed purity, (blocked + STRENGTH * prior) / (labelled + STRENGTH),
   reaches ``REJECT``. The prior is the share of the page's shape (its path with # for numbers) over
   all hosts, smoothed towards the share of all labelled pages.

The labels of pages are the verdicts of the rules that fit them. Pages are counted per host
and shape before the tree is built, so a large host is a few rows there.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and is judged
like the other pages of the empty host; repeated pages count once each; without labelled pages
nothing is rejected; very long paths are cut where their node has too few pages; an empty table gives no rows; rules of equal length are taken in the order of
the list; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.scratch import cut

MIN_SHARE = 0.02  # of the default; the registered query sets neither this bound nor DEPTH
MIN_PAGES = 5
DEPTH = 8  # segments that are told apart; the rest of a path is one more
APART = 1.96
BINS = 20
STRENGTH = 4.0
REJECT = 0.5
NUMBER = r"^#?([.][a-z0-9#]{1,5})?$"  # segments that are kept: empty, a number, an extension


class Rule(NamedTuple):
    rule: str  # host, then path
    verdict: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


#: Fixed values of the given task.
RULES = (Rule("org/", "allow"), Rule("example.org/es/", "block"), Rule("example.org/en/1", "block"),
         Rule("com/fr/", "allow"), Rule("com/de/", "block"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.coalesce(F.translate(host, _UPPER, _LOWER), empty), F.coalesce(path, empty)


def matched(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict, or null."""
    none = F.lit(None).cast("struct<rule:string,verdict:string>")

    def add(rest: Column, rule: Rule) -> Column:
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        return F.when(fits, F.struct(F.lit(rule.rule).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(rest)

    ranked = sorted(enumerate(rules), key=lambda x: (-len(x[1].rule), x[0]))
    return reduce(add, (r for _, r in reversed(ranked)), none)


def shape(path: Column, depth: int | None = DEPTH) -> Column:
    """The segments of a path, digits as #, at most ``depth`` and one for the rest; all of them with None."""
    return F.split(F.regexp_replace(path, r"[0-9]+", "#"), "/", -1 if depth is None else depth + 2)


def templates(shapes: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """host, shape and its template: rare values below a node become *, level by level.

    ``shapes`` has one row per host and shape with its number of pages. The common values of all nodes are
    joined, so a large host is never gathered. Below the usual depth a path leaves the tree once its node
    has too few pages for any common value, so single long paths cost no further levels.
    """
    tree = shapes.select("host", "shape", "pages", F.array().cast("array<string>").alias("template"))
    left = []  # frames of paths that are through
    for level in range(shapes.agg(F.max(F.size("shape"))).first()[0] or 0):
        if level >= DEPTH + 2:
            crowded = (tree.groupBy("host", "template").agg(F.sum("pages").alias("all"))
                       .where(F.col("all") >= MIN_PAGES).select("host", "template", F.lit(True).alias("crowded")))
            tree = cut(tree.join(crowded, ["host", "template"], "left"))
            on = F.col("crowded").isNotNull() & (F.size("shape") > level)
            rest = F.transform(F.slice("shape", level + 1, F.greatest(F.size("shape") - level, F.lit(0))),
                               lambda x: F.when(x.rlike(NUMBER), x).otherwise("*"))
            left.append(tree.where(~on).select("host", "shape", "pages", F.concat("template", rest).alias("template")))
            tree = tree.where(on).drop("crowded")
            if tree.isEmpty():
                break
        tree = tree.withColumn("value", F.get(F.col("shape"), F.lit(level)))
        children = tree.groupBy("host", "template", "value").agg(F.sum("pages").alias("own"))
        nodes = children.groupBy("host", "template").agg(F.sum("own").alias("all"))
        common = (children.where((F.col("own") >= MIN_PAGES) & F.col("value").isNotNull()).join(nodes, ["host", "template"])
                  .where(F.col("own") >= min_share * F.col("all"))
                  .select("host", "template", "value", F.lit(True).alias("common")))
        keep = F.col("common").isNotNull() | F.col("value").rlike(NUMBER)  # numbers are wildcards already
        step = F.when(F.col("value").isNull(), F.col("template")).otherwise(F.concat(
            "template", F.array(F.when(keep, F.col("value")).otherwise("*"))))
        tree = cut(tree.join(common, ["host", "template", "value"], "left").select(
            "host", "shape", "pages", step.alias("template")))
    for frame in left:
        tree = tree.unionByName(frame)
    return tree.select("host", "shape", F.array_join("template", "/").alias("template"))


def merged(counts: DataFrame) -> DataFrame:
    """Branches below one node with similar labels: host, template, and the labelled (n) and blocked (k) pages of its branch.

    ``counts`` has host, template, labelled and blocked. Templates that differ in their last literal
    segment only are branches of one node. Their smoothed shares of blocked pages fall into BINS steps; in the order of the
    steps, one joins the branch before it while its share is close to the pooled share of that whole branch. So
    however wide a node is, at most BINS rows of it are put in order, and branches cannot chain from one end
    to the other.
    """
    # the last segment that is a name of its own, neither wildcard nor number
    node = F.regexp_replace("template", r"[^/*#]+(?=(/[*#][^/]*)*/?$)", "?")
    share = (F.col("blocked") + 1) / (F.col("labelled") + 2)
    branches = cut(counts.withColumn("node", node).withColumn("bin", F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")))
    known = branches.where("labelled > 0")
    steps = known.groupBy("host", "node", "bin").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("k"))
    nodes = steps.groupBy("host", "node").agg(F.array_sort(F.collect_list(F.struct("bin", "n", "k"))).alias("steps"))

    def estimate(x: Column) -> tuple[Column, Column]:
        p = (x["k"] + 1) / (x["n"] + 2)
        return p, p * (1 - p) / (x["n"] + 2)

    def join(done: Column, x: Column) -> Column:
        (p, v), (q, w) = estimate(x), estimate(done)
        apart = (done["n"] > 0) & (F.abs(p - q) >= APART * F.sqrt(v + w))
        branch = done["branch"] + F.when(apart, 1).otherwise(0)
        own = F.struct(x["bin"].alias("bin"), x["n"].alias("n"), x["k"].alias("k"), branch.alias("branch"))
        return F.struct(F.when(apart, x["n"]).otherwise(done["n"] + x["n"]).alias("n"),
                        F.when(apart, x["k"]).otherwise(done["k"] + x["k"]).alias("k"),
                        branch.alias("branch"), F.concat(done["out"], F.array(own)).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).alias("branch"),
                     F.array().cast("array<struct<bin:int,n:bigint,k:bigint,branch:int>>").alias("out"))
    found = nodes.select("host", "node", F.aggregate("steps", start, join)["out"].alias("out"))

    def pooled(x: Column, part: str) -> Column:
        own = F.filter("out", lambda y: y["branch"] == x["branch"])
        return F.aggregate(own, F.lit(0).cast("long"), lambda total, y: total + y[part]).alias(part)

    sums = found.select("host", "node", F.explode(F.transform("out", lambda x: F.struct(
        x["bin"].alias("bin"), pooled(x, "n"), pooled(x, "k")))).alias("b")).select("host", "node", "b.*")
    # branches without labels have nothing to be compared by: they join each other
    none = branches.where("labelled = 0").select("host", "template", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("k"))
    return known.join(sums, ["host", "node", "bin"]).select("host", "template", "n", "k").unionByName(none)


def purities(shapes: DataFrame, tree: DataFrame) -> DataFrame:
    """host, shape, template, purity: the smoothed share of blocked pages of the template's branch."""
    total = shapes.agg(F.sum("labelled").alias("all"), F.sum("blocked").alias("bad"))
    base = F.coalesce(F.col("bad") / F.nullif(F.col("all"), F.lit(0)), F.lit(0.0))
    everywhere = shapes.groupBy("shape").agg(F.sum("labelled").alias("s_all"), F.sum("blocked").alias("s_bad"))
    prior = everywhere.join(F.broadcast(total)).select(  # one row
        "shape", ((F.col("s_bad") + STRENGTH * base) / (F.col("s_all") + STRENGTH)).alias("prior"))
    placed = shapes.join(tree, ["host", "shape"])
    judged = merged(placed.groupBy("host", "template").agg(
        F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")))
    return (tree.join(judged, ["host", "template"]).join(prior, "shape")
            .select("host", "shape", "template",
                    ((F.col("k") + STRENGTH * F.col("prior")) / (F.col("n") + STRENGTH)).alias("purity")))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id",
          url_col: str = "url", min_share: float = MIN_SHARE, depth: int | None = DEPTH) -> DataFrame:
    """id, host, path, rule (or null), verdict, template, and its purity.

    With ``min_share`` 0 and ``depth`` None the values with MIN_PAGES pages are told apart whatever else their node
    holds, at every depth.
    """
    host, path = split_url(F.col(url_col))
    found = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    found = found.select("*", matched(F.col("host"), F.col("path"), rules).alias("by"), shape(F.col("path"), depth).alias("shape"))
    counted = cut(found.groupBy("host", "shape").agg(
        F.count("*").alias("pages"), F.count("by").alias("labelled"),
        F.count_if(F.col("by")["verdict"] == "block").alias("blocked")))
    known = cut(purities(counted, templates(counted, min_share)))
    verdict = F.coalesce(F.col("by")["verdict"], F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    return found.join(known, ["host", "shape"], "left").select(
        id_col, "host", "path", F.col("by")["rule"].alias("rule"), verdict.alias("verdict"), "template", "purity")
