"""Removal of runs of lines that occurred before, found by winnowing.

A run of ``MIN_LINES`` consecutive lines is the shortest that is removed; with ``min_words``
any run, down to one line, with so many words goes too. Pairs of neighbouring
lines are hashed, and of the pairs in each run the least hash is its fingerprint: equal
runs have equal fingerprints, wherever they stand. Only runs whose fingerprint occurs again are
looked at further. They are compared over their whole length, which extends the match from the fingerprint
both ways, and all but the first (by document id, then line) go; overlapping runs join to longer ones.

Equal runs are compared with their first occurrence, not with each other, so a run that many
documents share costs one row per occurrence. Lines are compared exactly, by 128 bits of two
hashes; blank lines are passed over and stay.

Defined results: a null text stays null, an empty one empty; a text with fewer lines than a run
loses none, a run may recur in its own document and then loses its later lines, a text may
lose all lines and stay as an empty one; ids are integers, a null id counts as larger than all
others; a row with a null id is a document of its own, and so are rows with equal ids and different texts
(in the order of a hash of the text); rows equal in id and text are one document and keep the same
lines; a very long text is one row, and takes a task memory in proportion to its lines; an empty table gives no
rows; other columns stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.blocks import LAST
from shelfwise.llm.scratch import cut
from shelfwise.llm.tasks import unused

MIN_LINES = 3
MIN_WORDS = 50  # of the registered query: shorter runs with so many words go as well
WORD = r"\S+"
KEY = ["rank", "mark", "row"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also if lambdas within refer to it."""
    return F.get(F.transform(F.array(value), lambda once: use(once)), F.lit(0))


def _filled(lines: Column) -> Column:
    """The numbers of the lines that are not blank."""
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    return F.transform(F.filter(numbered, lambda y: F.length(F.trim(y["x"])) > 0), lambda z: z["i"])


def _keyed(documents: DataFrame, key: list[str], id_col: str, text_col: str) -> DataFrame:
    """The documents with three columns that tell them apart: rank, hash of the text, and a number where the id is null.

    The numbers are stored, so that all later reads see the same ones.
    """
    rank, mark, row = key
    found = documents.withColumns({rank: F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)),
                                   mark: F.xxhash64(text_col)})
    null = F.col(id_col).isNull()
    return found.where(~null).withColumn(row, F.lit(-1).cast("long")).union(
        cut(found.where(null).withColumn(row, F.monotonically_increasing_id())))


def _runs(documents: DataFrame, key: list[str], text_col: str, size: int, words: int | None) -> DataFrame:
    """The key, at (first line of the run, among the non-blank), n (lines), fingerprint, two hashes of the run.

    Runs of ``size`` lines, and with ``words`` those of fewer lines that have so many words. A longer run
    is made of these. A line that is not blank counts as a word at least.
    """
    def counted(x: Column) -> list[Column]:
        return [] if words is None else [F.greatest(F.regexp_count(x, F.lit(WORD)), F.lit(1)).alias("words")]

    filled = F.filter(_lines(F.col(text_col)), lambda x: F.length(F.trim(x)) > 0)
    rows = documents.select(*(F.col(c).alias(n) for c, n in zip(key, KEY, strict=True)), F.transform(
        filled, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), *counted(x))).alias("line"))
    rows = rows.where(F.size("line") >= (size if words is None else 1))
    pair = F.transform(F.slice("line", 1, F.size("line") - 1), lambda x, i: F.xxhash64(
        x["a"], F.element_at("line", (i + 2).cast("int"))["a"]))
    rows = rows.withColumn("pair", pair)

    def windows(n: int) -> Column:
        def line(i: Column, k: int) -> Column:
            return F.element_at("line", (i + k).cast("int"))

        def whole(i: Column, part: str) -> Column:
            return F.xxhash64(*(line(i, k)[part] for k in range(n)))

        starts = F.when(F.size("line") >= n, F.sequence(F.lit(1), F.size("line") - n + 1)).otherwise(F.array().cast("array<int>"))
        if n < size:
            starts = F.filter(starts, lambda i: sum((line(i, k)["words"] for k in range(n)), F.lit(0)) >= words)
        # one line has no pair: it is its own fingerprint; lengths do not share fingerprints
        least = (lambda i: line(i, 0)["a"]) if n == 1 else (lambda i: F.array_min(F.slice("pair", i, n - 1)))
        mark = least if n == size else (lambda i: F.xxhash64(F.lit(n), least(i)))
        return F.transform(starts, lambda i: F.struct(
            i.alias("at"), F.lit(n).alias("n"), mark(i).alias("fingerprint"), whole(i, "a").alias("a"), whole(i, "b").alias("b")))

    each = F.concat(*(windows(n) for n in (range(1, size + 1) if words is not None else [size])))
    return rows.select(*KEY, F.explode(each).alias("run")).select(*KEY, "run.*")


def repeated_lines(documents: DataFrame, min_lines: int = MIN_LINES, key: list[str] = KEY,
                   text_col: str = "text", min_words: int | None = None) -> DataFrame:
    """The key of each document that loses lines, and its repeated runs: at and n, among its non-blank lines."""
    if min_lines < 2:
        raise ValueError("a run has at least two lines")
    if min_words is not None and min_words < 1:
        raise ValueError("a run has at least one word")
    runs = _runs(documents, key, text_col, min_lines, min_words)
    again = runs.groupBy("fingerprint").count().where("count > 1").select("fingerprint")
    seen = cut(runs.join(again, "fingerprint").drop("fingerprint"))
    first = seen.groupBy("a", "b").agg(F.min(F.struct(*KEY, "at")).alias("first"))
    later = seen.join(first, ["a", "b"]).where(F.struct(*KEY, "at") > F.col("first"))
    return later.groupBy(*KEY).agg(F.collect_set(F.struct("at", "n")).alias("runs"))


def remove_repeated_lines(documents: DataFrame, min_lines: int = MIN_LINES, id_col: str = "doc_id",
                          text_col: str = "text", min_words: int | None = None, removed_col: str | None = None) -> DataFrame:
    """The documents with the repeated runs removed from their texts; all columns stay.

    With ``min_words``, runs of fewer lines go as well if they have so many words, be it in one line. ``removed_col``
    adds how many lines a document lost.
    """
    key, lost = [unused(f"__{n}", documents) for n in KEY], unused("__runs", documents)
    keyed = _keyed(documents, key, id_col, text_col)
    gone = repeated_lines(keyed, min_lines, key, text_col, min_words).select(
        *(F.col(n).alias(c) for c, n in zip(key, KEY, strict=True)), F.col("runs").alias(lost))
    both = keyed.join(gone, key, "left")
    runs = F.flatten(F.transform(F.col(lost), lambda r: F.sequence(r["at"] - 1, r["at"] + r["n"] - 2)))

    def spared(lines: Column, filled: Column) -> Column:
        out = F.transform(runs, lambda k: F.get(filled, k))
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), out)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    text = _let(_lines(F.col(text_col)), lambda lines: _let(_filled(lines), lambda filled: spared(lines, filled)))
    out = both.withColumn(text_col, F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(text))
    count = [] if removed_col is None else [
        F.coalesce(F.size(F.array_distinct(runs)), F.lit(0)).cast("long").alias(removed_col)]
    return out.select(*(both[c] if c != text_col else F.col(c) for c in documents.columns if c != removed_col), *count)


def removal_report(documents: DataFrame, min_words: int | None = MIN_WORDS) -> DataFrame:
    """doc_id, the text that is left, and how many lines it had and lost."""
    size = F.when(F.length("text") > 0, F.size(_lines(F.col("text")))).otherwise(0)
    source = documents.select("doc_id", "text", size.cast("long").alias("n_lines"))
    return remove_repeated_lines(source, min_words=min_words, removed_col="n_removed")
