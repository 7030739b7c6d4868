"""Near duplicates among vectors by spherical caps.

Filters are directions from a random product code: a rotated vector is cut into two halves, each half
has its own few random directions, and every pair of them is a filter. A vector passes the
filters whose two inner products sum up to ``alpha``; few halves come into question, so the list is
decoded without looking at all filters. Vectors with a common filter are compared exactly.

``alpha`` is lowered until at most ``MISSED`` of simulated pairs at just the threshold share no
filter; closer pairs are missed less. The number of filters follows the number of vectors, so that a
filter holds about ``PER_FILTER`` of them.

Equal vectors are one, with a count. Filters with the same first direction form cells, since a vector
that passes one of them often passes several. The members of a cell are dealt to blocks of about ``BLOCK``
vectors, and every two blocks meet in a task of their own. A task counts links, each only in the smallest
filter that its two vectors share, and returns the counts and the links of a spanning forest, never all pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite numbers link with
nothing; only vectors of equal dimension are compared; repeated rows are linked vectors of their own, and so are
rows with equal ids and different vectors: each has its own links, while an id is one node of the components; a null id
has no component, is kept and not compared; very long vectors take a task memory in proportion; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.components import components
from shelfwise.llm.scratch import cut, stored

THRESHOLD = 0.95
PER_FILTER = 200
HITS = 16  # filters times the share of vectors that pass one, before alpha is lowered
LEAST_SHARE = 1e-6  # of the vectors in a filter, which bounds the code to some thousand directions
MISSED = 0.005
BLOCK = 8_000
STRIPE = 500  # vectors of a filter that are compared with the others at once
_TRIALS = 1_500


class Code(NamedTuple):
    rotation: np.ndarray
    left: np.ndarray
    right: np.ndarray
    alpha: float
    split: int  # cells per first direction


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def code(dimension: int, vectors: int, threshold: float) -> Code:
    """The product code for so many vectors, the same whenever it is built."""
    rng = np.random.default_rng([dimension, 11])
    share = min(0.05, max(PER_FILTER / max(vectors, 1), LEAST_SHARE))
    size = int(np.ceil(np.sqrt(HITS / share)))
    rotation = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
    half = (dimension + 1) // 2
    left = _unit(rng.standard_normal((size, half)))
    right = _unit(rng.standard_normal((size, max(dimension - half, 1))))
    if dimension == 1:
        right[:] = 0
    x = _unit(rng.standard_normal((_TRIALS, dimension)))
    other = rng.standard_normal((_TRIALS, dimension))
    other = _unit(other - (other * x).sum(axis=1, keepdims=True) * x)
    y = threshold * x + np.sqrt(1 - threshold**2) * other if dimension > 1 else x
    trial = Code(rotation, left, right, 0.0, 1)
    best = np.empty(_TRIALS)  # the largest alpha at which a pair still shares a filter
    for i in range(_TRIALS):
        (a, b), (c, d) = (_products(trial, v[i:i + 1]) for v in (x, y))
        best[i] = _shared_alpha(a[0], b[0], c[0], d[0])
    alpha = float(np.quantile(best, MISSED))
    trial = trial._replace(alpha=alpha)
    directions = np.mean([len(np.unique(f // size)) for f in passed(trial, x)])
    return trial._replace(split=max(1, round(vectors * directions / size / BLOCK)))


def _shared_alpha(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> float:
    """max over filters of the smaller of two vectors' sums; only large halves can reach it."""
    p, q = np.argsort(-(a + c))[:64], np.argsort(-(b + d))[:64]
    return float(np.minimum(a[p][:, None] + b[q], c[p][:, None] + d[q]).max())


def _products(own: Code, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    turned = rows @ own.rotation
    half = own.left.shape[1]
    right = turned[:, half:] if turned.shape[1] > half else np.zeros((len(rows), 1))
    return turned[:, :half] @ own.left.T, right @ own.right.T


def passed(own: Code, rows: np.ndarray) -> list[np.ndarray]:
    """The filters of each unit vector."""
    a, b = _products(own, rows)
    size = len(own.right)
    need_a, need_b = own.alpha - b.max(axis=1), own.alpha - a.max(axis=1)
    out = []
    for i in range(len(rows)):
        j, k = np.flatnonzero(a[i] >= need_a[i]), np.flatnonzero(b[i] >= need_b[i])
        x, y = np.nonzero(a[i][j][:, None] + b[i][k] >= own.alpha)
        out.append(j[x] * size + k[y])
    return out


def cells(own: Code, filters: np.ndarray) -> np.ndarray:
    size = len(own.right)
    return filters // size * own.split + filters % size % own.split


def distinct_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, key (k1, k2) and vector of the rows that can link."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    some = F.exists(vector_col, lambda x: x != 0)
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite & some)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"),
                       F.xxhash64(vector_col).alias("k1"), F.xxhash64(F.lit(1), vector_col).alias("k2"))


def codes_of(representatives: DataFrame, threshold: float) -> dict[int, Code]:
    """A code per dimension."""
    counts = representatives.groupBy(F.size("vector")).count().collect()  # one row per dimension
    return {d: code(d, n, threshold) for d, n in counts}


def _dtype(kind: str) -> type:
    return np.float32 if kind == "array<float>" else np.float64


def filtered(representatives: DataFrame, codes) -> DataFrame:
    """size, cell, id, copies, vector and all filters of a vector, a row per cell that it comes to."""
    kind = _dtype(representatives.schema["vector"].dataType.simpleString())

    def run(batches):
        for batch in batches:
            sizes = batch["vector"].map(len)
            for size, own in batch.groupby(sizes.to_numpy()):
                raw = np.stack(own["vector"].to_list()).astype(kind)
                found = passed(codes.value[size], units(raw))
                places = [np.unique(cells(codes.value[size], f)) for f in found]
                yield pd.DataFrame({"size": size, "cells": places, "id": own["id"], "copies": own["copies"],
                                    "vector": [r.tobytes() for r in raw],
                                    "filters": [f.astype(np.int32).tobytes() for f in found]})

    rows = representatives.select("id", "copies", "vector").mapInPandas(
        run, "size int, cells array<long>, id long, copies long, vector binary, filters binary")
    return rows.select("size", F.explode("cells").alias("cell"), "id", "copies", "vector", "filters")


def units(raw: np.ndarray) -> np.ndarray:
    rows = raw.astype(np.float64)
    return _unit(rows / np.abs(rows).max(axis=1, keepdims=True))


def compare(key: tuple, frame: pd.DataFrame, own: Code, kind: type, threshold: float) -> pd.DataFrame:
    """Links of two blocks of a cell: per vector the linked rows counted here, and forest links."""
    _, cell, one, two = key
    frame = frame.sort_values("id")
    side = frame["block"].to_numpy()
    ids, copies = frame["id"].to_numpy(np.int64), frame["copies"].to_numpy(np.int64)
    rows = units(np.stack([np.frombuffer(v, kind) for v in frame["vector"]]))
    lists = [np.frombuffer(f, np.int32) for f in frame["filters"]]
    place = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    flat = np.concatenate(lists).astype(np.int64)
    here = np.flatnonzero(cells(own, flat) == cell)
    order = here[np.lexsort((place[here], flat[here]))]
    bounds = np.concatenate(([0], np.flatnonzero(np.diff(flat[order])) + 1, [len(order)]))
    total = np.zeros(len(frame), np.int64)
    trees = [np.zeros((0, 2), np.int64)]
    for x, y in zip(bounds[:-1], bounds[1:], strict=True):
        members = place[order[x:y]]
        a, b = members[side[members] == one], members[side[members] == two]
        if not len(a) or not len(b) or (one == two and len(a) < 2):
            continue
        link = np.zeros((len(a), len(b)), bool)
        for i in range(0, len(a), STRIPE):
            link[i:i + STRIPE] = rows[a[i:i + STRIPE]] @ rows[b].T >= threshold
        if one == two:
            np.fill_diagonal(link, False)
        if link.any():
            trees.append(forest(link, a, b))
            count(link, a, b, one == two, flat[order[x]], lists, copies, total)
    pairs = np.unique(np.concatenate(trees), axis=0)
    linked = np.flatnonzero(total)
    return pd.DataFrame({
        "id": np.concatenate((ids[linked], ids[pairs[:, 0]])),
        "n": np.concatenate((total[linked], np.zeros(len(pairs), np.int64))),
        "other": pd.array([None] * len(linked) + ids[pairs[:, 1]].tolist(), dtype="Int64")})


def count(link: np.ndarray, a: np.ndarray, b: np.ndarray, same: bool, filter_: int,
          lists: list[np.ndarray], copies: np.ndarray, total: np.ndarray) -> None:
    """Add the links whose smallest common filter this is."""
    members = np.unique(np.concatenate((a[link.any(axis=1)], b[link.any(axis=0)])))
    lower = [lists[m][lists[m] < filter_] for m in members]
    names, which, times = np.unique(np.concatenate(lower), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    use = (times > 1)[which]
    row = np.repeat(np.arange(len(members)), [len(x) for x in lower])
    table = np.zeros((len(members), int((times > 1).sum())), bool)
    table[row[use], column[which[use]]] = True
    bits = np.packbits(table, axis=1)
    at_a, at_b = np.searchsorted(members, a), np.searchsorted(members, b)
    step = max(1, 4_000_000 // max(1, bits.shape[1] * len(b)))
    for i in range(0, len(a), step):
        x, y = np.nonzero(link[i:i + step])
        x += i
        new = ~(bits[at_a[x]] & bits[at_b[y]]).any(axis=1)
        total += np.bincount(a[x[new]], weights=copies[b[y[new]]], minlength=len(total)).astype(np.int64)
        if not same:
            total += np.bincount(b[y[new]], weights=copies[a[x[new]]], minlength=len(total)).astype(np.int64)


def forest(link: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Links that connect what all links connect, as places."""
    same = len(a) == len(b) and bool((a == b).all())
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    if same:
        free_b = free_a
    out = []
    for root in np.flatnonzero(link.any(axis=1)):
        if not free_a[root]:
            continue
        free_a[root] = False
        stack = [(root, True)]
        while stack:
            at, left = stack.pop()
            new = np.flatnonzero((link[at] & free_b) if left else (link[:, at] & free_a))
            (free_b if left else free_a)[new] = False
            for x in new.tolist():
                out.append((a[at], b[x]) if left else (a[x], b[at]))
                stack.append((x, same or not left))
    return np.array(out, np.int64).reshape(-1, 2)


def link_counts(representatives: DataFrame, threshold: float) -> DataFrame:
    """id, n, other: counts of linked rows (other is null), and links that connect (n is 0)."""
    kind = _dtype(representatives.schema["vector"].dataType.simpleString())
    codes = representatives.sparkSession.sparkContext.broadcast(codes_of(representatives, threshold))
    each = filtered(representatives, codes)
    large = each.groupBy("size", "cell").count().where(F.col("count") > BLOCK).select(
        "size", "cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    dealt = each.join(large, ["size", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(
        F.least(x, F.col("block")).alias("one"), F.greatest(x, F.col("block")).alias("two")))
    tasks = dealt.withColumn("meet", F.explode(meets)).select(
        "size", "cell", "meet.one", "meet.two", "block", "id", "copies", "vector", "filters")
    return tasks.groupBy("size", "cell", "one", "two").applyInPandas(
        lambda key, frame: compare(key, frame, codes.value[key[0]], kind, threshold), "id long, n long, other long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """id, n_links, component_id, kept for every vector."""
    rows = distinct_vectors(vectors, id_col, vector_col)
    key = ["k1", "k2"]
    # a stored number stands for each distinct vector: ids may repeat
    first = cut(rows.groupBy(*key).agg(F.min("id").alias("first"), F.count("*").alias("copies"),
                                       F.min_by("vector", "id").alias("vector"))
                .withColumn("node", F.monotonically_increasing_id()))
    found = stored(link_counts(first.select(F.col("node").alias("id"), "copies", "vector"), threshold))
    links = found.where(F.col("other").isNotNull()).select(F.col("id").alias("a"), F.col("other").alias("b"))
    # an id with different vectors is one node of the components
    several = rows.groupBy("id").agg(F.min(F.struct(*key)).alias("lo"), F.max(F.struct(*key)).alias("hi")).where("lo != hi")
    placed = rows.select("id", *key).join(several.select("id"), "id").join(first.select(*key, "node"), key).select("id", "node").distinct()
    low = placed.groupBy("id").agg(F.min("node").alias("b"))
    joined = components(links.unionByName(placed.join(low, "id").select(F.col("node").alias("a"), "b")))
    least = (joined.join(first.select(F.col("node").alias("id"), "first"), "id")
             .groupBy("component").agg(F.min("first").alias("least")))
    counts = found.where(F.col("other").isNull()).groupBy("id").agg(F.sum("n").alias("n"))
    groups = (first.select(*key, "first", "copies", F.col("node").alias("id")).join(counts, "id", "left")
              .join(joined, "id", "left").join(least, "component", "left")
              .select(*key, (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"),
                      F.coalesce("least", "first").alias("component")))
    own = F.col(id_col)
    asked = vectors.select(own, F.xxhash64(vector_col).alias("k1"), F.xxhash64(F.lit(1), vector_col).alias("k2"))
    known = groups.select(F.col("k1").alias("g1"), F.col("k2").alias("g2"), "n", "component")
    linkable = own.isNotNull()  # vectors that cannot link have no group
    done = asked.join(known, (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")) & linkable, "left")
    component = F.coalesce("component", own.cast("long"))
    return done.select(own, F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                       F.coalesce(own.cast("long") == component, F.lit(True)).alias("kept"))
