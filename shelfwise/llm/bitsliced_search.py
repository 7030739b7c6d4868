"""Ranked lexical search over bit-sliced Bloom signatures.

``build`` makes the index, one row per shard of documents with about as many terms each. A document's
signature has a few bits per term, and more for terms that occur at least 2, 4, 8, ... times. The
signatures lie crosswise: slice i holds bit i of all documents of the shard, so the documents that may hold
a term are the conjunction of its slices. The exact terms and counts of each document lie beside the
slices in the same row.

``search`` looks at a block of items at a time. Slices tell for every term and document how often the term may occur
at most; weights summed over the slices bound every score from above. Each task keeps the k best documents
of each item so far. In a shard it scores the k documents with the highest bounds exactly, then all others whose
bound reaches the k-th best score, so every document that is left out is proven to be outside. Tasks
return at most k rows per item; those are merged in two steps, so no task gets the rows of all shards.

Document counts and lengths cover the whole index. Terms are compared by 64-bit keys of their bytes.

Defined results: a document without text or terms is not counted and never found; repeated documents are each
found; equal scores go by ascending id, null ids last; rows of items with equal ids are one item with the terms
of all its rows, a null item id is an id like others; an item without terms has no rows; empty tables give no
rows; a very long text is a shard of its own, held whole by one task; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from shelfwise.llm.scratch import checkpoint_dir, stored
from shelfwise.llm.tasks import importable
from shelfwise.llm.words import WORDLIKE, mix, owner, tokenize

TOP = 10
SLICE_BYTES = 500_000  # of texts cut into words at once
BITS = 8  # least number of bits per entry of a signature; widths are powers of two
HASHES = 3
SHARD_TERMS = 1 << 18
SHARD_DOCS = 1_024
BLOCK_TERMS = 4_096
BLOCK_ITEMS = 512
BUCKETS = 64  # first step of merging
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
READER_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
BATCH_DOCS = 500  # handed at once to a task that builds the index
#: A shard is megabytes. Parquet would look at the size of what it holds after a hundred rows only, and keep values for a dictionary.
SMALL_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1",
                "parquet.enable.dictionary": "false"}
_INDEX = ("width int, levels int, ids binary, nulls binary, lengths binary, sizes binary, keys binary, counts binary, "
          "slices binary")
_KINDS = {"ids": np.int64, "nulls": np.bool_, "lengths": np.int64, "sizes": np.int64, "keys": np.uint64, "counts": np.int32,
          "slices": np.uint8}
_STEP = 0x9E3779B97F4A7C15


class Docs(NamedTuple):
    """Documents with at least one term; the terms of each lie one after the other."""

    ids: np.ndarray
    nulls: np.ndarray
    lengths: np.ndarray
    sizes: np.ndarray
    keys: np.ndarray
    counts: np.ndarray

    def take(self, which: np.ndarray) -> Docs:
        at = spans(np.cumsum(self.sizes) - self.sizes, self.sizes, which)
        return Docs(self.ids[which], self.nulls[which], self.lengths[which], self.sizes[which], self.keys[at], self.counts[at])


class Query(NamedTuple):
    """A block of items: its distinct terms, and for each item the places of its terms among them."""

    keys: np.ndarray
    items: list[np.ndarray]


class Weighted(NamedTuple):
    query: Query
    weight: np.ndarray  # of each term
    documents: int
    words: int


def spans(begin: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places begin, begin + 1, ... of the chosen ranges, one range after the other."""
    size = sizes[which]
    return np.repeat(begin[which] - (np.cumsum(size) - size), size) + np.arange(size.sum())


def terms_of(ids: np.ndarray, nulls: np.ndarray, texts: list) -> Docs:
    words = tokenize(texts, WORDLIKE, lower=True)
    text = owner(words.first)
    order = np.lexsort((words.key, text))
    text, key = text[order], words.key[order]
    lead = np.ones(len(key), bool)
    lead[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(lead)
    lengths = np.diff(words.first)
    some = np.flatnonzero(lengths)
    sizes = np.bincount(text[at], minlength=len(lengths))
    return Docs(ids[some], nulls[some], lengths[some], sizes[some], key[at], np.diff(np.append(at, len(key))))


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 for a single occurrence, 2 from two on, 3 from four on, and so on."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def places(keys: np.ndarray, level: int, width: int) -> Iterator[np.ndarray]:
    """The slices of terms that occur 2**level times."""
    spread = mix(keys + np.uint64((level + 1) * _STEP % 2**64))
    for i in range(HASHES):
        yield (mix(spread + np.uint64(i * _STEP % 2**64)) & np.uint64(width - 1)).astype(np.int64)


def signatures(docs: Docs, width: int) -> tuple[int, np.ndarray]:
    """Number of levels, and the slices: one row per bit, one column per eight documents."""
    doc, level = np.repeat(np.arange(len(docs.ids)), docs.sizes), levels_of(docs.counts)
    flags = np.zeros((width, len(docs.ids)), bool)
    for i in range(level.max()):
        has = level > i
        for place in places(docs.keys[has], i, width):
            flags[place, doc[has]] = True
    return int(level.max()), np.packbits(flags, axis=1, bitorder="little")


def _row(width: int, parts: list[Docs]) -> pa.RecordBatch:
    docs = Docs(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    levels, slices = signatures(docs, width)
    cells = [np.ascontiguousarray(x, kind).tobytes() for x, kind in zip((*docs, slices), _KINDS.values(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array([width], pa.int32()), pa.array([levels], pa.int32()), *(pa.array([c], pa.binary()) for c in cells)],
        names=["width", "levels", *_KINDS])


def _shards(batches):
    open_: dict[int, list[Docs]] = {}
    for batch in batches:
        step = max(1, int(batch.num_rows * SLICE_BYTES / max(batch.column(1).nbytes, 1)))
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            ids = part.column(0)
            docs = terms_of(ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False),
                            part.column(1).to_pylist())
            if not len(docs.ids):
                continue
            entries = np.add.reduceat(levels_of(docs.counts), np.cumsum(docs.sizes) - docs.sizes)
            widths = 1 << np.maximum(6, np.frexp((BITS * entries - 1).astype(np.float64))[1].astype(np.int64))
            for width in np.unique(widths):
                own = open_.setdefault(int(width), [])
                own.append(docs.take(np.flatnonzero(widths == width)))
                if sum(len(d.keys) for d in own) >= SHARD_TERMS or sum(len(d.ids) for d in own) >= SHARD_DOCS:
                    yield _row(int(width), open_.pop(int(width)))
    for width, own in open_.items():
        yield _row(width, own)


def build(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index; it is read twice per block of items, so it should be stored."""
    importable(documents.sparkSession)
    return documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _shards, _INDEX)


def blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[tuple[list, Query]]:
    """Ids and terms of items, up to BLOCK_TERMS terms and BLOCK_ITEMS items at a time; one item is never parted."""
    ids, terms, have = [], [], set()
    rows = items.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).orderBy("i")

    def done():
        keys = np.array(sorted(have), np.uint64)
        return ids, Query(keys, [np.searchsorted(keys, np.array(sorted(t), np.uint64)) for t in terms])

    for row in rows.toLocalIterator():
        own = set(tokenize([row.t], WORDLIKE, lower=True).key.tolist())
        if ids and ids[-1] == row.i:
            terms[-1] |= own
        else:
            if ids and (len(have | own) > BLOCK_TERMS or len(ids) >= BLOCK_ITEMS):
                yield done()
                ids, terms, have = [], [], set()
            ids.append(row.i)
            terms.append(own)
        have |= own
    if have:
        yield done()


def weighted(index: DataFrame, query: Query) -> Weighted:
    """Number of documents and words of the index, and the weight of each term of the block."""
    keys = query.keys

    def count(batches):
        found, documents, words = np.zeros(len(keys), np.int64), 0, 0
        for batch in batches:
            for lengths, own in zip(batch.column(0), batch.column(1), strict=True):
                n = np.frombuffer(lengths.as_buffer(), np.int64)
                documents, words = documents + len(n), words + int(n.sum())
                key = np.frombuffer(own.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                found += np.bincount(at[keys[at] == key], minlength=len(keys))
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *some], pa.int32()), pa.array([documents, words, *found[some]], pa.int64())],
                                         names=["term", "n"])

    rows = index.select("lengths", "keys").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    sums = {r.term: r.n for r in rows.collect()}  # at most BLOCK_TERMS + 2 rows, or the terms of one item
    documents = sums.get(-2, 0)
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * sums.get(i, 0) + 1))) for i in range(len(keys))]
    return Weighted(query, np.array(weight, np.int64), documents, sums.get(-1, 0))


def norms(lengths: np.ndarray, documents: int, words: int) -> np.ndarray:
    if 90 * int(lengths.max()) * documents >= 2**63:
        lengths = lengths.astype(object)
    return (10 + 90 * lengths * documents // words).astype(np.int64)


def gain(count: np.ndarray | int, norm: np.ndarray) -> np.ndarray:
    """What a term that occurs so often adds per weight; it grows with the count."""
    count = np.asarray(count, np.int64)
    return 1_000_000_000 * count // (1000 * count + 8 * norm)


class Searcher:
    """The k best documents of each item among the shards that one task has seen."""

    def __init__(self, what: Weighted, top: int):
        self.what, self.top = what, top
        self.best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in what.query.items]
        self.least = np.ones(len(self.best), np.int64)
        self.weight = what.weight.astype(np.float64)
        self.places: dict[tuple[int, int], list[np.ndarray]] = {}

    def bounds(self, width: int, levels: int, slices: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """For every item and document a number that the score does not exceed."""
        out = np.zeros((len(self.best), len(norm)), np.int64)
        slices = slices.reshape(width, -1)
        for level in range(levels):
            if (level, width) not in self.places:
                self.places[level, width] = list(places(self.what.query.keys, level, width))
            first, *others = self.places[level, width]
            may = slices[first]
            for place in others:
                may &= slices[place]
            any_ = may.any(axis=1)
            if not any_.any():
                break  # what occurs twice as often also occurs as often as that
            present = np.unpackbits(may, axis=1, count=len(norm), bitorder="little").astype(np.float64)
            more = gain(2 ** (level + 1) - 1, norm) - gain(2**level - 1, norm)
            for i, terms in enumerate(self.what.query.items):
                own = terms[any_[terms]]
                if len(own):  # sums of whole numbers far below 2**53
                    out[i] += (self.weight[own] @ present[own]).astype(np.int64) * more
        return out

    def score(self, docs: Docs, norm: np.ndarray, chosen: list[np.ndarray]) -> None:
        """Exact scores of chosen documents of each item, merged into the best."""
        which = np.unique(np.concatenate(chosen))
        if not len(which):
            return
        keys, weight = self.what.query.keys, self.what.weight
        some = docs.take(which)
        at = np.minimum(np.searchsorted(keys, some.keys), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == some.keys)
        doc = np.repeat(np.arange(len(which)), some.sizes)[hit]
        gains = np.zeros((len(which), len(keys)), np.int64)
        gains[doc, at[hit]] = gain(some.counts[hit], norm[which][doc]) * weight[at[hit]]
        for i, own in enumerate(chosen):
            if len(own):
                rows = np.searchsorted(which, own)
                total = gains[np.ix_(rows, self.what.query.items[i])].sum(axis=1)
                parts = zip(self.best[i], (total, docs.nulls[own], docs.ids[own]), strict=True)
                total, nulls, ids = (np.concatenate(x) for x in parts)
                order = np.lexsort((ids, nulls, -total))
                order = order[total[order] > 0][:self.top]
                self.best[i] = total[order], nulls[order], ids[order]
                if len(order) == self.top:
                    self.least[i] = max(1, total[order[-1]])

    def shard(self, width: int, levels: int, cells: dict[str, np.ndarray]) -> int:
        """Look at one shard; returns how many pairs of item and document were scored."""
        docs = Docs(*(cells[c] for c in Docs._fields))
        norm = norms(docs.lengths, self.what.documents, self.what.words)
        bound = self.bounds(width, levels, cells["slices"], norm)
        if bound.shape[1] > self.top:
            high = np.argpartition(bound, -self.top, axis=1)[:, -self.top:]
        else:
            high = np.tile(np.arange(bound.shape[1]), (len(bound), 1))
        leads = [h[b[h] >= x] for h, b, x in zip(high, bound, self.least, strict=True)]
        self.score(docs, norm, leads)
        for b, lead in zip(bound, leads, strict=True):
            b[lead] = -1
        rest = [np.flatnonzero(b >= x) for b, x in zip(bound, self.least, strict=True)]
        self.score(docs, norm, rest)
        return sum(len(x) + len(y) for x, y in zip(leads, rest, strict=True))


def _cells(batch: pa.RecordBatch) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    columns = [batch.column(batch.schema.names.index(c)) for c in ("width", "levels", *_KINDS)]
    for width, levels, *cells in zip(*columns, strict=True):
        yield width.as_py(), levels.as_py(), {c: np.frombuffer(x.as_buffer(), kind) for x, (c, kind) in zip(cells, _KINDS.items(), strict=True)}


def best(index: DataFrame, what: Weighted, top: int = TOP) -> DataFrame:
    """item (its number in the block), rank, doc_id, score: the best documents of each item."""

    def look(batches):
        task = Searcher(what, top)
        for batch in batches:
            for width, levels, cells in _cells(batch):
                task.shard(width, levels, cells)
        item = np.repeat(np.arange(len(task.best)), [len(b[0]) for b in task.best])
        if len(item):
            total, nulls, ids = (np.concatenate(x) for x in zip(*task.best, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=nulls), pa.array(total)],
                                             names=["item", "doc_id", "score"])

    found = index.mapInArrow(look, "item int, doc_id long, score long").withColumn(
        "bucket", F.pmod(F.spark_partition_id(), F.lit(BUCKETS)))
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "bucket").orderBy(*order))).where(F.col("rank") <= top)
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
            .select("item", "rank", "doc_id", "score"))


@contextmanager
def held(spark: SparkSession, settings: dict[str, str]):
    """Work run inside has these settings of the session."""
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def single_rows(spark: SparkSession):
    """Work run inside reads and gets rows one at a time: a shard is megabytes, and a batch of all shards of a task would be held at once."""
    return held(spark, {BATCH_ROWS: "1", READER_ROWS: "1"})


def stored_index(documents: DataFrame) -> DataFrame:
    """The index, stored in groups of few rows; writing and reading hold a few shards at once, however many a task has."""
    with held(documents.sparkSession, {BATCH_ROWS: str(BATCH_DOCS)}):
        return stored(build(documents), SMALL_GROUPS)


def search(index: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item id, rank, doc_id and score of the ``top`` best documents of every item; one pass over a stored index per block."""
    spark = index.sparkSession
    kind = items.schema[id_col].dataType
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField(id_col, kind)])
    found = T.StructType([T.StructField(id_col, kind), T.StructField("rank", T.IntegerType()),
                          T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    path, wrote = f"{checkpoint_dir(spark).rstrip('/')}/search-{uuid.uuid4().hex}", False
    for ids, query in blocks(items, id_col, text_col):
        names = F.broadcast(spark.createDataFrame(list(enumerate(ids)), schema))  # at most BLOCK_ITEMS rows
        with single_rows(spark):  # stored block by block, so that a plan holds one block only
            best(index, weighted(index, query), top).join(names, "item").select(id_col, "rank", "doc_id", "score").write.mode(
                "append").parquet(path)
        wrote = True
    return spark.read.schema(found).parquet(path) if wrote else spark.createDataFrame([], found)


def ranking(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score of the ``top`` best documents of every item."""
    return search(stored_index(documents), items, top)
