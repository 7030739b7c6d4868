import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, rounds=6):
    """(vec_id, code, error, label_error) in any order, and the digest, by plain loops over Python's integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    length = max((len(v) for _, v, _ in kept), default=0)
    width = -(-length // 8)
    numbers = []
    for _, v, _ in kept:
        own = [max(-2**62, min(2**62, math.floor(4096 * x) if abs(x) < 1e300 else int(math.copysign(2**62, x)))) for x in v]
        own += [0] * (8 * width - len(own))
        numbers.append([own[p * width:(p + 1) * width] for p in range(8)])
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    books = [[list(numbers[i][p]) for i in order[:16]] for p in range(8)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(rounds if kept else 0):
        for p in range(8):
            own = [[] for _ in books[p]]
            for n in numbers:
                own[nearest(n[p], books[p])[1]].append(n[p])
            books[p] = [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else e for m, e in zip(own, books[p], strict=True)]
    out, by_label = [], {}
    for (i, _, label), n in zip(kept, numbers, strict=True):
        found = [nearest(n[p], books[p]) for p in range(8)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    top = 2**63 - 1
    return sorted(((i, c, min(e, top), min(by_label[label], top)) for i, c, e, label in out), key=repr), digest


def check(spark, rows, schema=SCHEMA):
    got = vector_codes.compression_report(spark.createDataFrame(rows, schema)).collect()
    want, digest = brute(rows)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=repr) == want
    assert {r.codebooks_sha256 for r in got} <= {digest}


def vectors(seed, n, length, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(length)] for _ in range(12)]
    return [(i, [x + rng.gauss(0, 0.2 * spread) for x in rng.choice(centres)], rng.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("length", [64, 24, 8])
def test_equals_brute_force(spark, length):
    check(spark, vectors(length, 120, length))


def test_odd_rows(spark):
    """Nulls, numbers that are not finite, repeated rows and ids, ties, null ids and lengths that do not fit."""
    rows = vectors(3, 40, 11)
    rows += [rows[0], rows[1], (rows[2][0], rows[3][1], 2), (None, rows[4][1], 1), (None, rows[5][1], None), (50, None, 1),
             (51, [1.0, None] + [0.0] * 9, 1), (52, [float("nan")] * 11, 1), (53, [float("inf")] + [0.0] * 10, None),
             (54, [], 7), (55, [0.5, -0.5], 7), (56, [0.0] * 11, 7)]
    check(spark, rows)
    check(spark, [(i, [float(i % 2)] * 8, None) for i in range(60)])
    check(spark, rows[:5])
    check(spark, [(1, [], None), (2, [], 3)])
    assert vector_codes.compression_report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vector_codes.compression_report(spark.createDataFrame([(1, None, 2)], SCHEMA)).collect() == []


def test_large_numbers_and_long_vectors_stay_exact(spark):
    check(spark, vectors(5, 40, 16, 1e7) + [(90, [1e300] * 16, 1), (91, [-1e18] * 16, 1)])
    check(spark, vectors(6, 20, 2048, 50.0))


def test_transform_keeps_distances():
    rng = np.random.default_rng(1)
    for width in (1, 3, 8, 13):
        rows, entries = rng.integers(-5000, 5000, (300, width)), rng.integers(-5000, 5000, (16, width))
        entries[9] = entries[4]
        a, b = vector_codes.walsh(rows), vector_codes.walsh(entries)
        plain = ((rows[:, None] - entries) ** 2).sum(axis=2)
        which, scaled = vector_codes.nearest(a, b)
        assert (which == plain.argmin(axis=1)).all() and (scaled == a.shape[1] * plain.min(axis=1)).all()
    rows = vector_codes.walsh(np.eye(16, dtype=np.int64)).T
    assert [int((np.diff(r) != 0).sum()) for r in rows] == list(range(16))


def test_other_columns_pass_and_codes_decode(spark):
    rows = vectors(8, 50, 16)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("error", F.lit("own")).withColumn("key", F.lit("own")) \
        .withColumn("id", F.lit("own"))
    books = vector_codes.train(frame)
    out = vector_codes.encode(frame, books, error_col="squared")
    assert {(r.error, r.key) for r in out.collect()} == {("own", "own")}
    for r in vector_codes.decode(out, books).collect():
        scaled = [math.floor(4096 * x) for x in r.embedding]
        assert sum((a - round(4096 * b)) ** 2 for a, b in zip(scaled, r.decoded, strict=True)) == r.squared
    assert vector_codes.compression_report(frame).count() == 50


def test_a_frequent_label_is_split(spark, monkeypatch):
    from shelfwise.operators import joins

    monkeypatch.setattr(joins, "ROWS_PER_TASK", 20)
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    check(spark, vectors(9, 100, 8))
