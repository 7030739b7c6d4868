"""Vectors as short codes: each part of a vector is replaced by the number of the nearest entry of its codebook.

Components become integers, ``floor(4096 * x)``, and everything after that is exact. A vector is cut into
``PARTS`` equal consecutive parts. Parts and entries are padded with zeros to a power of two and go
through the integer Walsh-Hadamard transform, which keeps squared distances up to that power as a
factor. Its coefficients in the order of their sign changes gather most of a distance in front: squared
differences are summed in that order, and an entry is given up as soon as its sum is above the whole
distance of a promising one. Entries that tie stay, so the lowest number among the nearest wins.

Codebooks start as the parts of the ``ENTRIES`` smallest ids and go through ``ROUNDS`` rounds of assignment
and mean, rounded down. A round is one pass over the vectors: tasks return one sum per entry and position, and
only the codebooks come to the driver, ``ENTRIES`` numbers per component of one vector.

Defined results: vectors that are null or hold null or non-finite components are dropped; a vector shorter than the
longest one, and a length that ``PARTS`` does not divide, are filled up with zeros at the end, so an empty vector
counts as zeros; repeated ids are rows of their own, and the first ones are taken in the order of id and
vector, null ids last; with fewer rows than entries the codebooks are shorter; an empty table gives no rows and
empty codebooks. Numbers above 2**62 in size after scaling count as 2**62 and errors end at 2**63 - 1; sums that
64 bits do not hold are taken with Python's integers, so long vectors and large numbers stay exact. Other columns
pass through.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from shelfwise.llm.scratch import stored
from shelfwise.llm.tasks import add_columns, importable
from shelfwise.operators.joins import lookup_join, settled

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
_ROWS = 2_048  # vectors whose distances are formed at once
_LARGEST = float(2**62)
_LONG = 2**63 - 1


class Codebooks(NamedTuple):
    entries: np.ndarray  # part, entry, position; integers of any size
    length: int  # of the longest vector they were made for

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel())).encode()).hexdigest()


def usable(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """The rows whose vector is there and has finite numbers only."""
    bad = F.exists(F.col(vector_col).cast("array<double>"),
                   lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vector_col).isNotNull() & ~bad)


def integer_parts(vectors: pa.Array, length: int) -> np.ndarray:
    """vector, part, position: scaled, rounded down and filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = np.diff(vectors.offsets.to_numpy())
    width = -(-length // PARTS)
    with np.errstate(over="ignore"):
        numbers = np.clip(np.floor(flat * SCALE), -_LARGEST, _LARGEST).astype(np.int64)
    out = np.zeros((len(vectors), PARTS * width), np.int64)
    out[np.arange(PARTS * width) < sizes[:, None]] = numbers
    return out.reshape(len(vectors), PARTS, width)


def sequency(size: int) -> np.ndarray:
    """Rows of the Hadamard matrix of a power of two, in the order of their sign changes."""
    places = np.arange(size)
    gray, out = places ^ (places >> 1), np.zeros(size, np.int64)
    for bit in range(size.bit_length() - 1):
        out = out << 1 | (gray >> bit & 1)
    return out


def walsh(rows: np.ndarray) -> np.ndarray:
    """The transform of the last axis, padded with zeros to a power of two, by sign changes."""
    size = 1 << max(0, rows.shape[-1] - 1).bit_length()
    out = np.zeros((*rows.shape[:-1], size), rows.dtype)
    out[..., :rows.shape[-1]] = rows
    half = 1
    while half < size:
        pairs = out.reshape(*rows.shape[:-1], size // (2 * half), 2, half)
        a, b = pairs[..., 0, :], pairs[..., 1, :]
        out = np.stack([a + b, a - b], axis=-2).reshape(out.shape)
        half *= 2
    return out[..., sequency(size)]


def exact(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as they are while squared distances of their transforms fit 64 bits, else as Python's integers."""
    size = 1 << max(0, rows.shape[-1] - 1).bit_length()
    most = max((int(abs(x).max()) for x in (rows, entries) if x.size), default=0)
    if size**2 * (2 * most) ** 2 < 2**62:  # at most size * size * (a - b)**2 for one part
        return rows.astype(np.int64), entries.astype(np.int64)
    return rows.astype(object), entries.astype(object)


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry of each row of coefficients, and the distance with the transform's factor."""
    n, size = rows.shape
    first = (rows[:, :1] - entries[None, :, 0]) ** 2
    try_ = first.argmin(axis=1)
    limit = ((rows - entries[try_]) ** 2).sum(axis=1)
    row, entry = np.nonzero(first <= limit[:, None])
    so_far = first[row, entry]
    for k in range(1, size):
        so_far = so_far + (rows[row, k] - entries[entry, k]) ** 2
        stay = (so_far <= limit[row]).astype(bool)
        if not stay.all():
            row, entry, so_far = row[stay], entry[stay], so_far[stay]
    low = limit.copy()
    np.minimum.at(low, row, so_far)
    best = (so_far == low[row]).astype(bool)
    row, entry = row[best], entry[best]
    lead = np.ones(len(row), bool)
    lead[1:] = row[1:] != row[:-1]  # pairs are in the order of rows and entries
    return entry[lead], low


def assign(parts: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """The code of each vector, one number per part, and the squared distance of all parts together."""
    codes = np.zeros(parts.shape[:2], np.int64)
    errors = np.zeros(len(parts), object)
    for part in range(PARTS):
        rows, entries = exact(parts[:, part], books.entries[part])
        rows, entries = walsh(rows), walsh(entries)
        codes[:, part], scaled = nearest(rows, entries)
        errors += (scaled // rows.shape[-1]).astype(object)
    return codes, errors


def _blocks(batches, place: int, length: int):
    for batch in batches:
        for i in range(0, batch.num_rows, _ROWS):
            yield integer_parts(batch.column(place).slice(i, _ROWS), length)


def start(vectors: DataFrame, id_col: str, vector_col: str) -> Codebooks:
    """The parts of the first vectors by id."""
    rows = vectors.select(F.col(id_col).alias("i"), F.col(vector_col).cast("array<double>").alias("v"))
    length = rows.agg(F.max(F.size("v"))).first()[0] or 0
    few = rows.orderBy(F.col("i").asc_nulls_last(), "v").limit(ENTRIES).collect()
    parts = integer_parts(pa.array([r.v for r in few], pa.list_(pa.float64())), length)
    return Codebooks(parts.transpose(1, 0, 2).astype(object), length)


def improve(vectors: DataFrame, vector_col: str, books: Codebooks) -> Codebooks:
    """Entries as the means of the parts assigned to them, rounded down; unused ones as they are."""
    _, entries, width = books.entries.shape

    def sums(batches):
        total, count = np.zeros(books.entries.shape, object), np.zeros((PARTS, entries), np.int64)
        for parts in _blocks(batches, 0, books.length):
            codes, _ = assign(parts, books)
            for part in range(PARTS):
                for entry in np.unique(codes[:, part]):
                    own = parts[codes[:, part] == entry, part]
                    large = len(own) * int(abs(own).max(initial=0)) >= 2**62
                    total[part, entry] += (own.astype(object) if large else own).sum(axis=0)
                    count[part, entry] += len(own)
        part, entry, at = (x.ravel() for x in np.indices(books.entries.shape))
        used = count[part, entry] > 0
        part, entry, at = part[used], entry[used], at[used]
        each = [int(x) for x in total[part, entry, at]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(at, pa.int32()),
             pa.array(count[part, entry], pa.int64()), pa.array([x >> 32 for x in each], pa.int64()),
             pa.array([x & 0xFFFFFFFF for x in each], pa.int64())], names=["part", "entry", "at", "n", "high", "low"])

    found = vectors.select(F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(
        sums, "part int, entry int, at int, n long, high long, low long")
    out = books.entries.copy()
    for r in found.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("high").alias("high"),
                                                      F.sum("low").alias("low")).collect():  # the size of the codebooks
        out[r.part, r.entry, r.at] = ((r.high << 32) + r.low) // r.n
    return Codebooks(out, books.length)


def train(vectors: DataFrame, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding") -> Codebooks:
    """Codebooks from all usable vectors."""
    importable(vectors.sparkSession)
    rows = usable(vectors, vector_col)
    books = start(rows, id_col, vector_col)
    if books.entries.shape[1]:
        for _ in range(rounds):
            books = improve(rows, vector_col, books)
    return books


def encode(vectors: DataFrame, books: Codebooks, vector_col: str = "embedding", code_col: str = "code",
           error_col: str = "error") -> DataFrame:
    """The usable rows with their code, two hex digits per part, and its squared error; other columns stay."""

    def run(column: pa.Array) -> list[pa.Array]:
        codes, errors = [], []
        for i in range(0, len(column), _ROWS):
            which, error = assign(integer_parts(column.slice(i, _ROWS), books.length), books)
            codes += [bytes(c).hex() for c in which.astype(np.uint8)]
            errors += [min(int(e), _LONG) for e in error]
        return [pa.array(codes, pa.string()), pa.array(errors, pa.int64())]

    return add_columns(usable(vectors, vector_col), vector_col, {code_col: T.StringType(), error_col: T.LongType()}, run)


def decode(codes: DataFrame, books: Codebooks, code_col: str = "code", vector_col: str = "decoded") -> DataFrame:
    """The vectors that codes stand for, as doubles, padded like the longest vector."""

    def run(column: pa.Array) -> list[pa.Array]:
        which = [bytes.fromhex(c) if c is not None else None for c in column.to_pylist()]
        return [pa.array([None if w is None else [int(x) / SCALE for p, e in enumerate(w) for x in books.entries[p, e]][:books.length]
                          for w in which], pa.list_(pa.float64()))]

    return add_columns(codes, code_col, {vector_col: T.ArrayType(T.DoubleType())}, run)


def compression_report(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                       label_col: str = "label") -> DataFrame:
    """id, code, error, label_error and codebooks_sha256 of every usable vector.

    The errors of a label are summed before they are joined back; a frequent label is split over tasks.
    """
    own = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    books = train(own, id_col="id", vector_col="vector")
    coded = stored(encode(own, books, "vector").drop("vector").withColumn("key", F.to_json(F.struct("label"))))
    total = coded.groupBy("key").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    done = lookup_join(coded, settled(total), "key", "left", spread=["id"])
    return done.select(F.col("id").alias(id_col), "code", "error",
                       F.least("total", F.lit(_LONG)).cast("long").alias("label_error"),
                       F.lit(books.sha256()).alias("codebooks_sha256"))
