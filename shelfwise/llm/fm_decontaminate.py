"""Benchmark decontamination with an FM-index per training shard.

A shard is a slice of an Arrow batch of documents. Its words, reduced to those that occur in
the phrases, are indexed by a suffix order, a wavelet matrix over the transformed sequence and
sampled positions. All phrases are searched backwards at once, their occurrences located from the
samples, and the spans merged. A stretch without phrase words, or one shorter than the shortest
phrase, cannot hold an occurrence and is left out of the index: an exact reduction.

Phrases reach the tasks by broadcast in blocks of ``BLOCK_WORDS`` words at most, one pass over
the documents per block; documents are never shuffled for one block. With several blocks the rows are stored with
a number of their own, and a block is fetched, searched and released before the next one.

Defined results: a null or empty text has no words and no hits; repeated documents are each
reported; items without words or without an id are ignored, repeated item ids count once; an empty
table of items gives documents without hits; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from shelfwise.llm import words as W
from shelfwise.llm.scratch import cut as cut_lineage, stored
from shelfwise.llm.tasks import add_columns, replace_column, unused

WINDOW = 10
BLOCK_WORDS = 2_000_000
SAMPLE = 8


class Phrases(NamedTuple):
    vocabulary: np.ndarray  # sorted word keys
    rows: dict[int, np.ndarray]  # phrase length -> phrases as rows of vocabulary places
    items: dict[int, list[np.ndarray]]  # phrase length -> item places of each phrase
    names: list  # item ids


def phrases_of(items: pd.DataFrame, window: int, id_col: str, text_col: str) -> Phrases:
    """Distinct windows of the items; a shorter item is one window."""
    items = items[items[id_col].notna()]
    names = list(dict.fromkeys(items[id_col].tolist()))
    place = {name: i for i, name in enumerate(names)}
    found = W.tokenize(items[text_col], W.WORDLIKE, lower=True)
    vocabulary = np.unique(found.key)
    symbol = np.searchsorted(vocabulary, found.key)
    grouped: dict[int, dict[bytes, set[int]]] = {}
    for row, name in enumerate(items[id_col].tolist()):
        own = symbol[found.first[row]:found.first[row + 1]].astype(np.int32)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            grouped.setdefault(size, {}).setdefault(own[i:i + size].tobytes(), set()).add(place[name])
    rows = {s: np.array([np.frombuffer(p, np.int32) for p in g]) for s, g in grouped.items()}
    owners = {s: [np.array(sorted(v)) for v in g.values()] for s, g in grouped.items()}
    return Phrases(vocabulary, rows, owners, names)


class Index:
    """FM-index of a sequence of symbols 0..sigma-1; ``ends`` marks unique end symbols below all."""

    def __init__(self, sequence: np.ndarray) -> None:
        self.n = len(sequence)
        order = suffix_order(sequence)
        self.sigma = int(sequence.max()) + 1
        last = sequence[order - 1]  # the symbol before each suffix, the last before the first
        self.before = np.concatenate(([0], np.cumsum(np.bincount(sequence, minlength=self.sigma))))
        self.levels, self.zeros = [], []
        current = last
        for bit in range(max(1, (self.sigma - 1).bit_length()) - 1, -1, -1):
            ones = ((current >> bit) & 1).astype(bool)
            self.levels.append((bit, np.concatenate(([0], np.cumsum(ones, dtype=np.int32)))))
            self.zeros.append(int(self.n - ones.sum()))
            current = np.concatenate((current[~ones], current[ones]))
        self.sampled = order % SAMPLE == 0
        self.rank_sampled = np.concatenate(([0], np.cumsum(self.sampled)))
        self.samples = order[self.sampled]

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place of the transformed sequence."""
        begin = np.zeros_like(end)
        for (bit, ones), zeros in zip(self.levels, self.zeros, strict=True):
            set_ = ((symbol >> bit) & 1).astype(bool)
            b, e = ones[begin], ones[end]
            begin = np.where(set_, zeros + b, begin - b)
            end = np.where(set_, zeros + e, end - e)
        return end - begin

    def step(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one symbol earlier."""
        at, begin, symbol = row, np.zeros_like(row), np.zeros_like(row)
        for (bit, ones), zeros in zip(self.levels, self.zeros, strict=True):
            set_ = ones[at + 1] > ones[at]
            symbol |= set_.astype(symbol.dtype) << bit
            at = np.where(set_, zeros + ones[at], at - ones[at])
            begin = np.where(set_, zeros + ones[begin], begin - ones[begin])
        return self.before[symbol] + at - begin

    def search(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that begin with each phrase, searched from the last word backwards."""
        low = np.zeros(len(rows), np.int64)
        high = np.full(len(rows), self.n, np.int64)
        for j in range(rows.shape[1] - 1, -1, -1):
            symbol = rows[:, j].astype(np.int64)
            known = symbol < self.sigma
            symbol = np.where(known, symbol, 0)
            base = self.before[symbol]
            low = np.where(known, base + self.rank(symbol, low), 0)
            high = np.where(known, base + self.rank(symbol, high), 0)
        return low, np.maximum(high, low)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walk back to a sampled one, at most SAMPLE - 1 steps."""
        position = np.zeros(len(row), np.int64)
        left = np.arange(len(row))
        row = row.copy()
        for steps in range(SAMPLE):
            here = self.sampled[row[left]]
            done = left[here]
            position[done] = self.samples[self.rank_sampled[row[done]]] + steps
            left = left[~here]
            if not len(left):
                break
            row[left] = self.step(row[left])
        return position


def suffix_order(sequence: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only ranks that still tie are sorted again."""
    n = len(sequence)
    order = np.argsort(sequence, kind="stable")
    ranked = sequence[order]
    begin = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(begin, np.diff(np.append(begin, n)))
    width = 1
    while len(begin) < n and width < n:
        sizes = np.diff(np.append(begin, n))
        tied = np.repeat(sizes > 1, sizes)
        place = np.flatnonzero(tied)
        own = order[place]
        after = np.where(own + width < n, rank[np.minimum(own + width, n - 1)], -1)
        again = np.lexsort((after, rank[own]))
        own, after = own[again], after[again]
        order[place] = own
        same = (rank[own][1:] == rank[own][:-1]) & (after[1:] == after[:-1])
        head = np.concatenate(([True], ~same))
        lead = place[np.maximum.accumulate(np.where(head, np.arange(len(place)), 0))]
        rank[own] = lead
        begin = np.flatnonzero(rank[order] == np.arange(n))
        width *= 2
    return order


def occurrences(found: W.Words, phrases: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(phrase places, first words of their occurrences, length) in the words of a shard."""
    if not phrases.rows or not len(found.key):
        return
    place = np.searchsorted(phrases.vocabulary, found.key)
    place[place == len(phrases.vocabulary)] = 0
    known = phrases.vocabulary[place] == found.key
    # stretches of phrase words within one text
    text = W.owner(found.first)
    head = known & np.concatenate(([True], ~known[:-1] | (text[1:] != text[:-1])))
    stretch = np.cumsum(head) - 1
    own = np.flatnonzero(known)
    sizes = np.bincount(stretch[own], minlength=0)
    keep = sizes[stretch[own]] >= min(phrases.rows)
    own = own[keep]
    if not len(own):
        return
    number = np.unique(stretch[own], return_inverse=True)[1]
    ends = int(number[-1]) + 1
    # each stretch is followed by an end symbol of its own, below all words
    sequence = np.empty(len(own) + ends, np.int64)
    where = np.arange(len(own)) + number
    sequence[where] = place[own] + ends
    gaps = np.ones(len(sequence), bool)
    gaps[where] = False
    sequence[gaps] = np.arange(ends)
    word_at = np.zeros(len(sequence), np.int64)
    word_at[where] = own
    index = Index(sequence)
    for size, rows in phrases.rows.items():
        low, high = index.search(rows.astype(np.int64) + ends)
        count = high - low
        which = np.repeat(np.arange(len(rows)), count)
        if len(which):
            begin = np.concatenate(([0], np.cumsum(count)))[:-1]
            row = np.arange(len(which)) - begin[which] + low[which]
            yield which, word_at[index.locate(row)], size


def shard_hits(texts: list[str | None], phrases: Phrases) -> tuple[W.Words, list, list]:
    """The words of a shard, and per document its merged hit spans [first, end) and the items found."""
    found = W.tokenize(texts, W.WORDLIKE, lower=True)
    n = len(found.key)
    cover = np.zeros(n + 1, np.int64)
    text = W.owner(found.first)
    pairs = []
    for which, at, size in occurrences(found, phrases):
        np.add.at(cover, at, 1)
        np.add.at(cover, at + size, -1)
        owners = phrases.items[size]
        lengths = np.fromiter((len(x) for x in owners), np.int64, len(owners))[which]
        flat = np.concatenate([owners[w] for w in which])
        pairs.append(np.unique(np.repeat(text[at], lengths) * len(phrases.names) + flat))
    hit = np.cumsum(cover[:-1]) > 0
    head = hit & np.concatenate(([True], ~hit[:-1] | (text[1:] != text[:-1]))) if n else hit
    tail = hit & np.concatenate((~hit[1:] | (text[1:] != text[:-1]), [True])) if n else hit
    first, last = np.flatnonzero(head), np.flatnonzero(tail) + 1
    of = text[first] if len(first) else np.zeros(0, np.int64)
    items: list[list] = [[] for _ in texts]
    for pair in np.unique(np.concatenate(pairs)) if pairs else ():
        items[pair // len(phrases.names)].append(phrases.names[pair % len(phrases.names)])
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    spans = [[[int(a), int(b)] for a, b in zip(first[x:y] - base, last[x:y] - base, strict=True)]
             for x, y, base in zip(cuts[:-1], cuts[1:], found.first[:-1], strict=True)]
    return found, spans, items


def blocks(items: DataFrame, window: int, id_col: str, text_col: str) -> tuple[int, Iterator[Phrases]]:
    """The number of blocks of bounded size, and their phrases, each block fetched when its turn comes."""
    few = items.select(id_col, text_col).where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    size = few.agg(F.sum(F.length(text_col))).first()[0] or 0
    count = max(1, -(-size // (4 * BLOCK_WORDS)))
    part = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(count))
    return count, (phrases_of((few.where(part == i) if count > 1 else few).toPandas(), window, id_col, text_col)
                   for i in range(count))


def searched(frame: DataFrame, text_col: str, shared: Broadcast, kind: T.DataType) -> DataFrame:
    """The frame with n_words, the hit spans and the items found in place of its text, for one block of phrases."""
    new = {"n_words": T.LongType(), "spans": T.ArrayType(T.ArrayType(T.IntegerType())), "items": T.ArrayType(kind)}

    def run(texts: pa.Array) -> list[pa.Array]:
        found, spans, names = shard_hits(texts.to_pylist(), shared.value)
        return [pa.array(np.diff(found.first)), pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                pa.array(names, pa.list_(to_arrow_type(kind)))]

    return add_columns(frame, text_col, new, run).drop(text_col)


def hits_of_blocks(texts: DataFrame, parts: Iterator[Phrases], row: str, text_col: str,
                   kind: T.DataType) -> tuple[DataFrame, DataFrame]:
    """row and n_words of all rows; row, spans and items of the rows with hits, over all blocks.

    The rows must be stored: ``row`` tells them apart in every pass.
    """
    context = texts.sparkSession.sparkContext
    source = texts.select(F.col(row).alias("row"), F.col(text_col).alias("text"))
    counts, found = None, []
    for block in parts:
        shared = context.broadcast(block)
        del block
        done = searched(source, "text", shared, kind)
        if counts is None:
            done = stored(done)
            counts = done.select("row", "n_words")
        else:
            done = stored(done.where(F.size("spans") > 0))
        found.append(done.where(F.size("spans") > 0).drop("n_words"))
        shared.destroy()
    union = reduce(DataFrame.unionByName, found)
    return counts, (union.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                             F.flatten(F.collect_list("items")).alias("items"))
                    .select("row", merged(F.array_sort("spans")).alias("spans"), F.array_distinct("items").alias("items")))


def contaminated_spans(documents: DataFrame, items: DataFrame, window: int = WINDOW,
                       id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text") -> DataFrame:
    """Per document: n_words, spans of hit words as [first, end), and the ids of the items found."""
    source = documents.select(id_col, text_col)
    kind = items.schema[item_id].dataType
    count, parts = blocks(items, window, item_id, item_text)
    if count == 1:
        return searched(source, text_col, documents.sparkSession.sparkContext.broadcast(next(parts)), kind)
    row = unused("__row", source)
    rows = cut_lineage(source.withColumn(row, F.monotonically_increasing_id()))
    counts, found = hits_of_blocks(rows, parts, row, text_col, kind)
    ids = rows.select(F.col(row).alias("row"), F.col(id_col).alias("own"))
    return ids.join(counts, "row").join(found, "row", "left").select(
        F.col("own").alias(id_col), "n_words", *(F.coalesce(c, F.array().cast(found.schema[c].dataType)).alias(c)
                                                 for c in ("spans", "items")))


def merged(spans) -> F.Column:
    """Sorted spans with overlapping ones joined."""
    return F.aggregate(spans, F.array().cast("array<array<int>>"), lambda done, x: F.when(
        (F.size(done) > 0) & (F.element_at(F.element_at(done, -1), 2) >= x[0]),
        F.concat(F.slice(done, 1, F.size(done) - 1),
                 F.array(F.array(F.element_at(done, -1)[0],
                                 F.greatest(F.element_at(F.element_at(done, -1), 2), x[1])))),
    ).otherwise(F.concat(done, F.array(x))))


def contamination_report(documents: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The digest of ``contaminated_spans``: counts, and a hash of the items' ids."""
    spans = contaminated_spans(documents, items, window)
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + (x[1] - x[0]).cast("long"))
    return spans.select("doc_id", "n_words", hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def decontaminate(documents: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without the words of the spans; other columns and untouched texts stay as they are.

    The text before a removed span and the text after it are joined by one space. With phrases in several
    blocks, all blocks are searched in the text as it came before it is cut.
    """
    count, parts = blocks(items, window, "item_id", "text")
    if count == 1:
        shared = documents.sparkSession.sparkContext.broadcast(next(parts))

        def run(column: pa.Array) -> pa.Array:
            texts = column.to_pylist()
            found, spans, _ = shard_hits(texts, shared.value)
            return pa.array([cut(t, s, found, i) if s else t
                             for i, (t, s) in enumerate(zip(texts, spans, strict=True))], pa.string())

        return replace_column(documents, "text", run)
    row, lost, left = (unused(n, documents) for n in ("__row", "__spans", "__left"))
    rows = cut_lineage(documents.withColumn(row, F.monotonically_increasing_id()))
    _, hits = hits_of_blocks(rows, parts, row, "text", items.schema["item_id"].dataType)
    both = rows.join(hits.select(F.col("row").alias(row), F.col("spans").alias(lost)), row, "left")

    def cuts(column: pa.Array) -> list[pa.Array]:
        texts, spans = (column.field(i).to_pylist() for i in range(2))
        hit = [i for i, s in enumerate(spans) if s]
        found = W.tokenize([texts[i] for i in hit], W.WORDLIKE, lower=True)
        for place, i in enumerate(hit):
            texts[i] = cut(texts[i], spans[i], found, place)
        return [pa.array(texts, pa.string())]

    done = add_columns(both.withColumn(lost, F.struct(F.col("text").alias("text"), F.col(lost).alias("spans"))),
                       lost, {left: T.StringType()}, cuts)
    return done.select(*(done[left].alias(c) if c == "text" else done[c] for c in documents.columns))


def cut(text: str, spans: list[list[int]], found: W.Words, row: int) -> str:
    """The text without the bytes from the first to the last word of each span."""
    raw, base, first = text.encode("utf-8", "surrogatepass"), found.bound[row], found.first[row]
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at:found.start[first + a] - base])
        at = found.end[first + b - 1] - base
    kept.append(raw[at:])
    return " ".join(p for p in (k.decode("utf-8", "surrogatepass").strip(" ") for k in kept) if p)

