"""Similarity join of documents by the Jaccard index of their word n-grams.

Prefix filtering: in one order of all n-grams, rare ones first, two sets that are similar enough
share an n-gram among the first n - ceil(t n) + 1 of each.

1. Texts are dealt to chunks once. Equal sets count as one; sets too small to resemble another
   only join their equals. An exchange of packed blocks counts every n-gram over all sets; the order
   goes by these counts (up to 255, over 32 bits of the key and its part), then by key. Any order is right,
   and a rare-first one leaves few candidates.
2. Prefix n-grams that two different sets share are found by an exchange of packed blocks. Only
   documents that have any are candidates.
3. Candidates that share a prefix n-gram and pass the length, the positional and the suffix filter are
   pairs; the suffix filter bounds the overlap by the sets' counts per range of keys. First
   each bucket's members pair with a dozen of the bucket, which links groups of many near copies without
   their pairs. After contracting these links, all pairs of a bucket are looked at that are not linked
   yet; a pair inside one component could add nothing. Their number grows with the square of a bucket, so tasks
   look at them as arrays: many small buckets at once, a large one cut into blocks of which every two meet.
4. Each pair is verified once on the whole sets. Only the sets of documents in pairs are built again
   and travel.

N-grams are compared by 64-bit keys, equal sets by their size and 128 bits.

Defined results: a text with fewer words than an n-gram is one n-gram; null, empty and blank texts
have none and link with nothing; repeated rows are links of similarity 1; ids are integers, a null id
links with nothing and has no component; rows with equal ids and different texts keep sets of their own, and the id
is one node that links them; a very long text is held whole by one task; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm import blocks as B, words as W
from shelfwise.llm.components import components
from shelfwise.llm.scratch import cut, stored

WORDS = 3
SET = ["n", "s1", "s2"]  # what tells the sets of n-grams apart
THRESHOLD = (90, 100)  # links from 90 / 100 on
FEW = 500_000  # ids that may be broadcast, 8 bytes each
HEADS = 10  # members of a bucket that all others are compared with at first
RANGES = 512  # of keys, for the suffix filter
BLOCK = 2_048  # members of a bucket that meet as many others in one piece of work
ENTRIES = 20_000  # of buckets, to a group of rows that a task holds
PAIRS = 1 << 19  # looked at in one step
_ROW = "rank long, n long, s1 long, s2 long, keys array<long>, places array<int>, ranges array<tinyint>"


class Sets:
    """Sets of n-grams of a batch of texts: sorted by text, then key."""

    def __init__(self, texts: pd.Series, size: int) -> None:
        found = W.tokenize(texts, lower=True)
        start, text = W.whole_windows(found.first, size)
        keys = W.windows(found.key, size)
        keys = keys[start] if len(start) else np.zeros(0, np.uint64)
        counts = np.diff(found.first)
        for few in range(1, size):  # the whole text is one n-gram
            own = np.flatnonzero(counts == few)
            if len(own):
                keys = np.concatenate((keys, W.windows(found.key, few)[found.first[own]]))
                text = np.concatenate((text, own))
        order = np.lexsort((keys, text))
        keys, text = keys[order], text[order]
        head = np.ones(len(keys), bool)
        head[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
        self.key, self.text = keys[head], text[head]
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.n = np.diff(self.first)
        self.s1 = _sum(W.mix(self.key ^ np.uint64(0xA0761D6478BD642F)), self.first)
        self.s2 = _sum(W.mix(self.key + np.uint64(0xE7037ED1A0B428DB)), self.first)


def _sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[first[1:]] - total[first[:-1]]


class Chosen:
    """The distinct sets of a chunk that can resemble another set, and their n-grams."""

    def __init__(self, frame: pd.DataFrame, size: int, threshold: tuple[int, int]) -> None:
        self.num, self.den = threshold
        self.rank = frame["rank"].to_numpy(np.int64)
        self.sets = sets = Sets(frame["text"], size)
        # one text for each distinct set, the one with the smallest rank
        order = np.lexsort((self.rank, sets.s2, sets.s1, sets.n))
        same = np.ones(len(order), bool)
        same[:1] = False
        for x in (sets.n, sets.s1, sets.s2):
            same[1:] &= x[order][1:] == x[order][:-1]
        chosen = np.zeros(len(order), bool)
        chosen[order[~same]] = True
        # a set of n differs from a similar one by an n-gram at least: n / (n + 1) >= t
        chosen &= (sets.n * self.den >= self.num * (sets.n + 1)) & (self.rank != B.LAST)
        own = np.flatnonzero(chosen[sets.text])
        self.key, self.text = sets.key[own], sets.text[own]
        self.keys, self.which = B.distinct(self.key)

    def counted(self, chunk: int, parts: int) -> pd.DataFrame:
        """Blocks of 32 bits of each distinct key, and how many of the sets have it."""
        times = np.minimum(np.bincount(self.which, minlength=len(self.keys)), 255).astype(np.uint8)
        bits = np.uint64(parts.bit_length() - 1)
        return B.pack(chunk, parts, self.keys, short=((self.keys << bits) >> np.uint64(32)).astype(np.uint32),
                      times=times).drop(columns="keys")

    def ranges(self, row: int) -> np.ndarray | None:
        """How many keys of a set lie in each of RANGES equal ranges."""
        keys = self.sets.key[self.sets.first[row]:self.sets.first[row + 1]]
        place = keys >> np.uint64(64 - (RANGES.bit_length() - 1))
        counts = np.bincount(place.astype(np.int64), minlength=RANGES)
        return counts.astype(np.int8) if counts.max() < 2**7 else None  # no filter then

    def prefixes(self, counts: pd.DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, text and place of the n-grams in the prefixes, in the order of the texts."""
        weight = np.zeros(len(self.keys), np.uint8)
        bound = B.cuts(self.keys, parts)
        own = counts[counts["kind"] == 0]
        for part, raw in zip(own["part"], own["bits"], strict=True):
            weight[bound[part]:bound[part + 1]] = np.frombuffer(raw, np.uint8)
        order = np.lexsort((self.key, weight[self.which], self.text))
        key, text = self.key[order], self.text[order]
        place = np.arange(len(key)) - np.searchsorted(text, text)
        n = self.sets.n[text]
        inside = place < n - -(-self.num * n // self.den) + 1
        return key[inside], text[inside], place[inside]


def _frequencies(blocks: pd.DataFrame) -> pd.DataFrame:
    """For each block the number of sets with each of its n-grams, 255 at most."""
    short, times = B.unpack(blocks, "short", np.uint32), B.unpack(blocks, "times", np.uint8)
    _, which = B.distinct(short)
    total = np.minimum(np.bincount(which, weights=times), 255).astype(np.uint8)[which]
    ends = np.cumsum(blocks["times"].map(len).to_numpy(np.int64))
    return pd.DataFrame({"chunk": blocks["chunk"], "part": blocks["part"], "kind": np.zeros(len(blocks), np.int32),
                         "bits": [total[a:b].tobytes() for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)]})


def candidates(documents: DataFrame, size: int, threshold: tuple[int, int], id_col: str, text_col: str) -> DataFrame:
    """One row per document: rank, size and key of its set, and the prefix n-grams that other sets share."""
    source = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    chunks, parts = B.layout(source)
    texts = B.chunked(source, chunks)

    def count(key, frame):
        return Chosen(frame, size, threshold).counted(key[0], parts)

    def grouped(own: Chosen, counts: pd.DataFrame):
        key, text, place = own.prefixes(counts, parts)
        keys, which = B.distinct(key)
        one = np.zeros(len(keys), np.uint64)
        one[which] = own.sets.s1[text]
        return key, text, place, keys, which, one

    def prefixes(key, frame, counts):
        if not len(frame):
            return B.pack(0, parts, np.zeros(0, np.uint64), one=np.zeros(0, np.uint64), several=np.zeros(0, bool))
        _, _, _, keys, which, one = grouped(Chosen(frame, size, threshold), counts)
        return B.pack(key[0], parts, keys, one=one, several=np.bincount(which, minlength=len(keys)) > 1)

    def common(frame):
        keys, which = B.distinct(B.unpack(frame, "keys", np.uint64))
        one = B.unpack(frame, "one", np.uint64)
        low, high = np.full(len(keys), 2**64 - 1, np.uint64), np.zeros(len(keys), np.uint64)
        np.minimum.at(low, which, one)
        np.maximum.at(high, which, one)
        hot = low < high
        hot[which[B.unpack(frame, "several", bool)]] = True
        return B.answer(frame, hot[which], 1)

    def rows(frame, answers):
        if not len(frame):
            return pd.DataFrame({k: [] for k in ("rank", "n", "s1", "s2", "keys", "places", "ranges")})
        own = Chosen(frame, size, threshold)
        key, text, place, keys, which, _ = grouped(own, answers)
        hit = np.flatnonzero(B.flags_of(answers, 1, keys, parts)[which])
        key, text, place = key[hit].view(np.int64), text[hit], place[hit]
        bound = np.searchsorted(text, np.arange(len(frame) + 1)).tolist()
        spans = list(zip(bound[:-1], bound[1:], strict=True))
        return pd.DataFrame({
            "rank": own.rank, "n": own.sets.n, "s1": own.sets.s1.view(np.int64), "s2": own.sets.s2.view(np.int64),
            "keys": [key[a:b] if b > a else None for a, b in spans],
            "places": [place[a:b] if b > a else None for a, b in spans],
            "ranges": [own.ranges(i) if b > a else None for i, (a, b) in enumerate(spans)]})

    each = texts.groupBy("chunk").applyInPandas(count, "part int, chunk int, short binary, times binary")
    counts = each.groupBy("part").applyInPandas(_frequencies, B._BITS)
    blocks = (texts.groupBy("chunk").cogroup(counts.groupBy("chunk"))
              .applyInPandas(prefixes, "part int, chunk int, keys binary, one binary, several binary"))
    bits = blocks.groupBy("part").applyInPandas(common, B._BITS)
    return texts.groupBy("chunk").cogroup(counts.unionByName(bits).groupBy("chunk")).applyInPandas(rows, _ROW)


def sets_of(ranks: DataFrame, documents: DataFrame, size: int) -> DataFrame:
    """rank and grams (the sorted keys of the set) of the documents (rank, text) with these ranks."""
    ranks = cut(ranks.distinct())
    few = F.broadcast(ranks) if ranks.count() <= FEW else ranks

    def build(batches):
        for batch in batches:
            for part in W.slices(batch):
                sets = Sets(part["text"], size)
                yield pd.DataFrame({"rank": part["rank"].to_numpy(), "grams": [
                    sets.key[a:b].tobytes() for a, b in zip(sets.first[:-1], sets.first[1:], strict=True)]})

    chosen = documents.join(few, "rank").select("rank", "text")
    return chosen.mapInPandas(build, "rank long, grams binary")


def verify(pairs: DataFrame, documents: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; ``documents`` has rank and text."""
    num, den = threshold

    def check(batches):
        for batch in batches:
            keep = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), num, den)
                    for x, y in zip(batch["x"], batch["y"], strict=True)]
            yield batch.loc[keep, ["a", "b"]]

    grams = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("rank")), documents, size)
    left = grams.select(F.col("rank").alias("a"), F.col("grams").alias("x"))
    right = grams.select(F.col("rank").alias("b"), F.col("grams").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(check, "a long, b long").distinct()


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    both = int(np.isin(a, b, assume_unique=True, kind="sort").sum())
    return den * both >= num * (len(a) + len(b) - both)


def _fits(x: str, y: str, threshold: tuple[int, int]) -> Column:
    """Length and positional filter of two entries: structs of n, rank and place.

    Nothing before the first n-gram that two prefixes share is in both sets, so what follows in the shorter rest
    bounds the overlap. The bound holds for that first one, and one passing n-gram makes a pair.
    """
    num, den = threshold
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    most = F.least(n - F.col(f"{x}.place"), m - F.col(f"{y}.place"))
    return (F.least(n, m) * den >= F.greatest(n, m) * num) & (most * den >= (n + m - most) * num)


def _first(x: str, y: str) -> Column:
    """Whether the key is the first that two prefixes share: each pair comes up once."""
    return F.get(F.array_intersect(f"{x}.keys", f"{y}.keys"), F.lit(0)) == F.col("key")


def _may_overlap(x: str, y: str, threshold: tuple[int, int]) -> Column:
    """Suffix filter: the sets' counts per range of keys bound the overlap."""
    num, den = threshold
    both = F.zip_with(f"{x}.ranges", f"{y}.ranges", lambda a, b: F.least(a, b).cast("int"))
    most = F.aggregate(both, F.lit(0), lambda total, i: total + i)
    return F.coalesce(most * den >= (F.col(f"{x}.n") + F.col(f"{y}.n") - most) * num, F.lit(True))


def _pairs(rows: DataFrame) -> DataFrame:
    """Distinct pairs, the smaller rank first."""
    x, y = F.col("x.rank"), F.col("y.rank")
    return rows.where(x != y).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def links(rows: DataFrame, documents: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """Links between representatives of different sets; enough of them to connect all that are similar.

    ``rows`` are the representatives' rows of ``candidates``, ``documents`` has rank and text.
    """
    entries = cut(rows.select(F.explode(F.arrays_zip("keys", "places")).alias("e"), "rank", "n").select(
        F.col("e.keys").alias("key"), F.struct("n", "rank", F.col("e.places").alias("place")).alias("x")))
    some = [F.min_by("x", F.xxhash64(F.lit(i), F.col("x.rank"))).alias(f"h{i}") for i in range(HEADS)]
    heads = entries.groupBy("key").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), *some)
    heads = heads.select("key", F.explode(F.array_distinct(F.array("lo", "hi", *(f"h{i}" for i in range(HEADS))))).alias("y"))
    pairs = cut(_pairs(entries.join(heads, "key").where(_fits("x", "y", threshold))))
    found = cut(verify(pairs, documents, size, threshold))
    joined = components(found)
    # entries by component; the largest component of a bucket needs no pairs of its own
    placed = entries.join(joined.select(F.col("id").alias("__id"), "component"), F.col("x.rank") == F.col("__id"), "left").select(
        "key", "x", F.coalesce("component", F.col("x.rank")).alias("group"))
    sizes = placed.groupBy("key", "group").count()
    main = (sizes.groupBy("key").agg(F.count("*").alias("groups"), F.max_by("group", F.struct("count", "group")).alias("main"),
                                     F.ceil(F.sum("count") / BLOCK).cast("int").alias("blocks"))
            .where("groups > 1").select("key", "main", "blocks"))
    more = rows.select(F.col("rank").alias("__id"), "ranges")
    open_ = cut(placed.join(main, "key").join(more, F.col("x.rank") == F.col("__id")).select(
        "key", "x.*", "ranges", "group", (F.col("group") == F.col("main")).alias("main"), "blocks"))
    more = verify(cut(_unlinked(open_, threshold).join(pairs, ["a", "b"], "left_anti")), documents, size, threshold)
    return found.unionByName(more)


def _unlinked(entries: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Distinct pairs (a, b) of different groups of a bucket that pass the length, the positional and the suffix filter.

    A bucket is cut into ``blocks``; each two of them, and each with itself, are a piece of work.
    """
    held = entries.agg(F.sum("blocks")).first()[0] or 0
    tasks = max(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held // ENTRIES))
    own = entries.withColumn("block", F.pmod(F.xxhash64("rank"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    dealt = own.withColumn("deal", F.pmod(F.xxhash64("key", "low", "high"), F.lit(tasks)).cast("int"))
    return (dealt.select("deal", "key", "low", "high", (F.col("block") > F.col("low")).alias("side"), "main", "n", "rank", "place",
                         "group", "ranges")
            .repartition(tasks, "deal").groupBy("deal").applyInPandas(lambda frame: _meet(frame, threshold), "a long, b long").distinct())


def _partners(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each row the range of rows that it meets; rows lie by key, low, high, side and main."""
    new = np.ones(len(frame), bool)
    new[1:] = np.any([frame[c].to_numpy()[1:] != frame[c].to_numpy()[:-1] for c in ("key", "low", "high")], axis=0)
    begin, piece = np.flatnonzero(new), np.cumsum(new) - 1
    end, side, main = np.append(begin[1:], len(frame))[piece], frame["side"].to_numpy(bool), frame["main"].to_numpy(bool)
    middle = (begin + np.bincount(piece, weights=~side).astype(np.int64))[piece]
    rest = middle + np.bincount(piece, weights=side & ~main).astype(np.int64)[piece]
    one = frame["low"].to_numpy() == frame["high"].to_numpy()
    low = np.where(one, np.arange(len(frame)) + 1, middle)
    high = np.where(main, np.where(one, low, rest), end)
    return low, np.where(side, low, high)


def _meet(frame: pd.DataFrame, threshold: tuple[int, int]) -> pd.DataFrame:
    """The pairs of some pieces of work that pass the filters (``_fits`` and ``_may_overlap``, for arrays)."""
    num, den = threshold
    frame = frame.sort_values(["key", "low", "high", "side", "main"], kind="stable")
    n, rank, place, group = (frame[c].to_numpy(np.int64) for c in ("n", "rank", "place", "group"))
    none = np.zeros(RANGES, np.uint8)
    known = np.array([x is not None for x in frame["ranges"]], bool)
    ranges = np.stack([none if x is None else np.asarray(x, np.int8).view(np.uint8) for x in frame["ranges"]])
    low, high = _partners(frame)
    times = high - low
    total = np.concatenate(([0], np.cumsum(times)))
    steps = np.unique(np.searchsorted(total, np.append(np.arange(0, total[-1], PAIRS), total[-1]), "left"))
    found = [np.zeros((0, 2), np.int64)]
    for i, j in zip(steps[:-1], steps[1:], strict=True):
        x = np.repeat(np.arange(i, j), times[i:j])
        y = np.arange(total[i], total[j]) + np.repeat(low[i:j] - total[i:j], times[i:j])
        some = np.flatnonzero(group[x] != group[y])
        x, y = x[some], y[some]
        both, most = n[x] + n[y], np.minimum((n - place)[x], (n - place)[y])
        some = np.flatnonzero((np.minimum(n[x], n[y]) * den >= np.maximum(n[x], n[y]) * num) & (most * den >= (both - most) * num))
        x, y, both = x[some], y[some], both[some]
        for at in range(0, len(x), 4096):
            p, q, b = x[at:at + 4096], y[at:at + 4096], both[at:at + 4096]
            most = np.minimum(ranges[p], ranges[q]).sum(axis=1, dtype=np.int64)
            keep = (most * den >= (b - most) * num) | ~(known[p] & known[q])
            a, b = rank[p[keep]], rank[q[keep]]
            found.append(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1)[a != b])
    pairs = np.unique(np.concatenate(found), axis=0)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def all_links(documents: DataFrame, size: int = WORDS, threshold: tuple[int, int] = THRESHOLD,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """a, b (a < b): every pair of similar documents with different sets, one document standing for each set.

    The smallest id stands for the documents of a set. A group whose members all resemble each other gives as many
    pairs as it has, which ``similarity_groups`` does without.
    """
    _, rows, _ = _representatives(documents, size, threshold, id_col, text_col)
    entries = cut(rows.select(F.explode(F.arrays_zip("keys", "places")).alias("e"), "rank", "n", "keys", "ranges").select(
        F.col("e.keys").alias("key"), F.struct("n", "rank", F.col("e.places").alias("place"), "keys", "ranges").alias("x")))
    met = entries.join(entries.withColumnRenamed("x", "y"), "key").where(
        (F.col("x.rank") < F.col("y.rank")) & _fits("x", "y", threshold) & _first("x", "y") & _may_overlap("x", "y", threshold))
    texts = documents.select(F.col(id_col).cast("long").alias("rank"), F.col(text_col).alias("text"))
    return verify(cut(_pairs(met)), texts, size, threshold)


def _representatives(documents: DataFrame, size: int, threshold: tuple[int, int], id_col: str,
                     text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``candidates``, those that stand for each set, and the smallest id of each set."""
    rows = stored(candidates(documents, size, threshold, id_col, text_col))
    known = rows.where((F.col("n") > 0) & (F.col("rank") != B.LAST))
    first = cut(known.groupBy(*SET).agg(F.min("rank").alias("first")))
    alone = rows.where(F.size("keys") > 0).join(first, SET).where("rank = first").dropDuplicates(["rank", *SET])
    return rows, alone, first


def similarity_groups(documents: DataFrame, size: int = WORDS, threshold: tuple[int, int] = THRESHOLD,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rank, n (size of the set) and component (smallest id reachable by links; null for a null id)."""
    key = SET
    rows, alone, first = _representatives(documents, size, threshold, id_col, text_col)
    texts = documents.select(F.col(id_col).cast("long").alias("rank"), F.col(text_col).alias("text"))
    # an id with different texts is one node: it links their sets
    known = rows.where((F.col("n") > 0) & (F.col("rank") != B.LAST))
    several = known.groupBy("rank").agg(F.min(F.struct(*SET)).alias("lo"), F.max(F.struct(*SET)).alias("hi")).where("lo != hi")
    same = known.join(several.select("rank"), "rank").join(first, key).select(F.col("rank").alias("a"), F.col("first").alias("b"))
    joined = components(links(alone, texts, size, threshold).unionByName(same))
    groups = first.join(joined, F.col("first") == F.col("id"), "left").select(
        *key, F.coalesce("component", "first").alias("component"))
    return rows.select("rank", *key).join(groups, key, "left").select(
        "rank", "n", F.when(F.col("rank") != B.LAST, F.coalesce("component", "rank")).alias("component"))


def components_of(documents: DataFrame, size: int = WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    groups = similarity_groups(documents, size, threshold)
    return groups.select(F.when(F.col("rank") != B.LAST, F.col("rank")).alias("doc_id"),
                         F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(documents: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """The documents that are the smallest id of their group; null ids stay. All columns stay."""
    groups = similarity_groups(documents, size, threshold)
    drop = groups.where("component < rank").select(F.col("rank").alias("__rank")).distinct()
    return documents.join(drop, documents["doc_id"].cast("long") == drop["__rank"], "left_anti")
