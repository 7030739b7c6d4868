import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import blocks, cap_filters, jaccard_join, line_winnowing, substring_dedup
from shelfwise.llm.components import components

import brute

DOCS = "doc_id long, text string"


def corpus(seed, n, spread=40):
    """Texts with copies, near copies, shared passages, repeated rows, ties, blanks and a long one."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(spread)]
    passage = " ".join(rng.choices(words, k=25))
    texts = ["", "  \n ", "one", "one two", "ONE two", "a b c", passage, " ".join(rng.choices(words, k=4000))]
    while len(texts) < n:
        kind = rng.randrange(5)
        own = rng.choices(words, k=rng.randrange(1, 60))
        if kind == 0:
            own = rng.choice(texts).split(" ")
        elif kind in (1, 2):
            own = rng.choice(texts).split(" ")
            own[rng.randrange(len(own))] = rng.choice(words)
        elif kind == 3:
            at = rng.randrange(len(own) + 1)
            own[at:at] = passage.split(" ")[rng.randrange(8):]
        texts.append(" ".join(own))
    rng.shuffle(texts)
    return [*enumerate(texts), (n, None), (n + 1, None)]


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(blocks, "CHUNK_CHARS", 3_000)
    monkeypatch.setattr(blocks, "PART_CHARS", 6_000)


@pytest.mark.parametrize(("size", "num"), [(3, 90), (5, 80), (1, 50)])
def test_jaccard_groups_equal_brute_force(spark, small_chunks, size, num):
    docs = corpus(size, 220)
    out = jaccard_join.similarity_groups(spark.createDataFrame(docs, DOCS), size, (num, 100)).collect()
    assert {r.rank: (r.n, r.component) for r in out} == brute.jaccard_groups(docs, size, num, 100)


def test_all_links_are_every_similar_pair_of_sets(spark):
    """One large group around the threshold: the components need few of its links, the join has them all."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.sample([w for w in words if rng.random() > 0.12], k=20))) for i in range(60)]
    docs += [(100 + i, docs[i][1]) for i in range(5)] + [(200, None), (201, "")]
    sets = {i: frozenset((t or "").split()) for i, t in docs}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    own = sorted(i for s, i in first.items() if s)
    want = {(a, b) for a in own for b in own if a < b and 100 * len(sets[a] & sets[b]) >= 55 * len(sets[a] | sets[b])}
    got = [(r.a, r.b) for r in jaccard_join.all_links(spark.createDataFrame(docs, DOCS), 1, (55, 100)).collect()]
    assert len(want) > 300 and sorted(got) == sorted(want)


def test_jaccard_threshold_is_met_exactly(spark):
    words = [f"w{i}" for i in range(40)]
    # 20 n-grams each, 18 in common of 20: 0.9; and 17 in common: below
    docs = [(1, " ".join(words[:20])), (2, " ".join(words[:19])), (3, " ".join(words[:18])), (4, " ".join(words[:17]))]
    out = jaccard_join.similarity_groups(spark.createDataFrame(docs, DOCS), 1, (90, 100)).collect()
    assert {r.rank: r.component for r in out} == {i: g for i, (_, g) in brute.jaccard_groups(docs, 1, 90, 100).items()}
    docs = [(1, " ".join(words[:10])), (2, " ".join(words[:9])), (3, " ".join(words[20:29])), (4, " ".join(words[20:28]))]
    out = jaccard_join.similarity_groups(spark.createDataFrame(docs, DOCS), 1, (90, 100)).collect()
    assert {r.rank: r.component for r in out} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_jaccard_nulls_repeats_clashes_and_empty_tables(spark):
    docs = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, None), (2, "a b c d"), (3, None), (4, "")]
    frame = spark.createDataFrame(docs, DOCS).withColumn("rank", F.lit("x")).withColumn("component", F.lit(0)).withColumn("n", F.lit(None))
    out = sorted(map(tuple, jaccard_join.components_of(frame).collect()), key=repr)
    assert out == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (None, 0, None), (2, 2, 1), (3, 0, 3), (4, 0, 4)], key=repr)
    kept = jaccard_join.keep_one(frame, 3, (90, 100))
    assert kept.columns == frame.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 1, 3, 4]
    assert jaccard_join.components_of(frame.limit(0)).collect() == []


def test_group_of_near_copies_makes_few_pairs(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(150):
        own = list(base)
        own[rng.randrange(300)] = f"x{i}"
        docs.append((i, " ".join(own)))
    frame = spark.createDataFrame(docs, DOCS)
    rows = jaccard_join.candidates(frame, 3, (90, 100), "doc_id", "text").where("size(keys) > 0")
    found = jaccard_join.links(rows, frame.withColumnRenamed("doc_id", "rank"), 3, (90, 100))
    assert found.count() < 150 * 40  # of 11,175 pairs
    assert {r.component for r in components(found).collect()} == {0}


def test_large_bucket_is_met_in_blocks(spark, monkeypatch):
    """Pairs of a bucket are looked at as arrays in pieces of bounded size, and none is lost."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "ENTRIES", 40)
    rng, docs = random.Random(3), []
    base = [f"w{i}" for i in range(120)]
    for i in range(150):
        own = list(base)
        for _ in range(rng.randrange(1, 14)):
            own[rng.randrange(120)] = rng.choice(base) if rng.random() < 0.5 else f"x{rng.randrange(60)}"
        docs.append((i, " ".join(own)))
    frame, plain, pieces = spark.createDataFrame(docs, DOCS), jaccard_join._unlinked, []

    def unlinked(entries, threshold):
        pieces.append(entries.groupBy("key", "blocks").count().collect())
        return plain(entries, threshold)

    monkeypatch.setattr(jaccard_join, "_unlinked", unlinked)
    out = jaccard_join.similarity_groups(frame, 1, (90, 100)).collect()
    assert {r.rank: (r.n, r.component) for r in out} == brute.jaccard_groups(docs, 1, 90, 100)
    assert max(r.blocks for r in pieces[0]) > 2 and all(-(-r["count"] // 16) == r.blocks for r in pieces[0])


def test_meet_gives_the_pairs_that_pass_the_filters(monkeypatch):
    monkeypatch.setattr(jaccard_join, "PAIRS", 50)
    rng, rows, rank = random.Random(4), [], 0
    for key in range(12):
        low, high = rng.choice([(0, 0), (0, 1), (1, 1), (2, 5)])
        for _ in range(rng.choice([1, 2, 3, 25])):
            rank, main = rank + 1, rng.random() < 0.4
            side = low < high and rng.random() < 0.5
            n = rng.randrange(20, 26)
            ranges = np.bincount([rng.randrange(8) for _ in range(n)], minlength=jaccard_join.RANGES).astype(np.int8)
            rows.append((key, low, high, side, main, n, rank, rng.randrange(8), -1 if main else rank, ranges if rng.random() < 0.8 else None))
    rng.shuffle(rows)
    frame = pd.DataFrame(rows, columns=["key", "low", "high", "side", "main", "n", "rank", "place", "group", "ranges"])
    want = set()
    for x in rows:
        for y in rows:
            if x[0] != y[0] or x[6] >= y[6] or x[8] == y[8] or (x[1] < x[2] and x[3] == y[3]):
                continue
            n, m, most = x[5], y[5], min(x[5] - x[7], y[5] - y[7])
            both = most if x[9] is None or y[9] is None else int(np.minimum(x[9], y[9]).sum())
            if min(n, m) * 100 >= max(n, m) * 50 and all(100 * c >= 50 * (n + m - c) for c in (most, both)):
                want.add((x[6], y[6]))
    got = jaccard_join._meet(frame, (50, 100))
    assert len(want) > 50 and sorted(zip(got["a"], got["b"], strict=True)) == sorted(want)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(200, 200 + i) for i in range(1, 50)] + [(300, 300), (401, 400)]
    out = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(101)}, **{200 + i: 200 for i in range(50)}, 400: 400, 401: 400}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("size", [13, 3, 1])
def test_substring_dedup_equals_brute_force(spark, small_chunks, size):
    docs = corpus(7, 160)
    out = substring_dedup.remove_repeats(spark.createDataFrame(docs, DOCS), size).collect()
    assert {r.doc_id: (r.n_words, r.kept.split()) for r in out} == brute.without_repeated_windows(docs, size)
    assert all(r.n_words - r.n_removed == len(r.kept.split()) for r in out)


def test_substring_dedup_nulls_and_clashes(spark):
    text = " ".join(f"w{i}" for i in range(20))
    frame = spark.createDataFrame([(None, text), (5, text), (5, text), (6, "new " + text + "  end"), (7, None)], DOCS)
    frame = frame.withColumn("chunk", F.lit("c")).withColumn("kept", F.lit(1)).withColumn("rank", F.lit(None))
    out = {(r.doc_id, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(frame).collect()}
    assert out == {(None, 20, ""), (5, 0, text), (6, 20, "new end"), (7, 0, "")}
    assert substring_dedup.removal_report(frame.limit(0)).collect() == []


@pytest.mark.parametrize("size", [2, 3, 5])
def test_line_dedup_equals_brute_force(spark, size):
    rng = random.Random(size)
    docs = [(i, "\n".join(rng.choice(["a", "b", "c", "d", "", " ", "long line", "x" * 500]) for _ in range(rng.randrange(14))))
            for i in range(120)] + [(500, None), (501, "\n".join(str(i % 50) for i in range(20_000)))]
    frame = spark.createDataFrame(docs, DOCS)
    out = line_winnowing.remove_repeated_lines(frame, size).collect()
    assert {r.doc_id: r.text for r in out} == brute.without_repeated_lines(docs, size)


def test_line_dedup_nulls_repeats_and_clashes(spark):
    text = "a\nb\nc"
    frame = spark.createDataFrame([(2, text), (1, text + "\nd"), (None, "x\n" + text), (1, text + "\nd"), (3, None), (4, "")], DOCS)
    frame = frame.withColumn("__rank", F.lit(9)).withColumn("places", F.lit("p")).withColumn("at", F.lit(None))
    out = line_winnowing.remove_repeated_lines(frame)
    assert out.columns == frame.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(2, ""), (1, text + "\nd"), (None, "x"), (1, text + "\nd"), (3, None), (4, "")], key=repr)
    assert line_winnowing.removal_report(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        line_winnowing.repeated_lines(frame, 1)


def test_line_dedup_keeps_rows_without_an_own_id_apart(spark):
    run = "a\nb\nc"
    rows = [(1, run), (2, "first\nown\n" + run), (2, "p\nq\nr\ns\nt"), (None, "w\nx\n" + run), (None, "d\ne\nf\ng\nh"),
            (None, "k\nl\nm"), (None, "k\nl\nm")]
    for frame in (spark.createDataFrame(rows, DOCS), spark.createDataFrame(rows[::-1], DOCS).repartition(5)):
        got = sorted(((r.doc_id, r.text) for r in line_winnowing.remove_repeated_lines(frame).collect()), key=repr)
        assert got == sorted([(1, run), (2, "first\nown"), (2, "p\nq\nr\ns\nt"), (None, "w\nx"), (None, "d\ne\nf\ng\nh"),
                              (None, "k\nl\nm"), (None, "")], key=repr)


def without_long_repeats(docs, size, words):
    """Every run of so many lines or words that occurred before goes; all runs of all lengths are tried."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        lines = text.split("\n")
        filled = [k for k, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for end in range(1, len(filled) + 1):
            for at in range(end):
                run = tuple(lines[k] for k in filled[at:end])
                if len(run) >= size or sum(max(1, len(x.split())) for x in run) >= words:
                    if run in seen:
                        gone |= set(filled[at:end])
                    seen.add(run)
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("words", [1, 5, 9])
def test_line_dedup_by_words_equals_brute_force(spark, words):
    rng = random.Random(words)
    choices = ["a", "b b", "c c c", "d " * 4, "", " ", "\t", "e " * 6, "f " * 9]
    docs = [(i, "\n".join(rng.choice(choices) + rng.choice(["", "", f" {i}"]) for _ in range(rng.randrange(7)))) for i in range(60)]
    docs += [(100, "only one line " * 4), (101, "only one line " * 4), (102, "new\n" + "only one line " * 4)]
    out = line_winnowing.remove_repeated_lines(spark.createDataFrame(docs, DOCS), 4, min_words=words).collect()
    got = {r.doc_id: r.text for r in out}
    assert got == without_long_repeats(docs, 4, words) and got[101] == "" and got[102] == "new"


def vectors(seed, dimension, n):
    rng = random.Random(seed)
    rows = [[rng.gauss(0, 1) for _ in range(dimension)] for _ in range(n)]
    for i in range(n):
        base = rows[rng.randrange(8)] if i % 3 == 0 else rows[rng.randrange(n)]
        noise = rng.choice([0, 0.1, 0.2, 0.28, 0.34, 0.5])
        rows.append([x * rng.choice([1, 3]) ** 0 + rng.gauss(0, noise) for x in base])
    return rows


@pytest.mark.parametrize(("dimension", "block"), [(64, 8_000), (48, 60), (3, 40), (2, 8_000), (1, 8_000)])
def test_cap_filters_against_all_pairs(spark, monkeypatch, dimension, block):
    import numpy as np
    monkeypatch.setattr(cap_filters, "BLOCK", block)
    rows = vectors(dimension, dimension, 150)
    frame = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    x = np.array(rows)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    out = {r.vec_id: r for r in cap_filters.near_duplicates(frame).collect()}
    got, true = sum(r.n_links for r in out.values()), int(link.sum())
    assert true * 0.99 <= got <= true
    assert all(out[i].n_links <= link[i].sum() for i in range(len(x)))
    if got == true:
        group = brute.components(range(len(x)), zip(*map(list, np.nonzero(link)), strict=True))
        assert {i: r.component_id for i, r in out.items()} == group
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.values())


def test_cap_filters_nulls_copies_and_clashes(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0, 2.0]), (2, [1.0, 0.0, 2.0]), (2, [1.0, 0.0, 2.0]), (3, [2.0, 0.0, 4.0]), (4, [0.0, 0.0, 0.0]), (5, None),
            (6, []), (7, [nan, 1.0, 1.0]), (8, [inf, 1.0, 1.0]), (9, [None, 1.0, 1.0]), (None, [1.0, 0.0, 2.0]), (10, [1.0, 0.0]),
            (11, [1e-30, 0.0, 2e-30]), (12, [-1.0, 0.0, -2.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("filters", F.lit(1))
    out = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in cap_filters.near_duplicates(frame).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 12)]
    assert out == sorted([(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (3, 4, 1, False), (11, 4, 1, False),
                          (None, 0, None, True), *alone], key=repr)
    assert cap_filters.near_duplicates(frame.limit(0)).collect() == []


def test_line_report_counts_lines_not_blank_rests(spark):
    rows = [(1, "one\ntwo\nthree\n"), (2, "one\ntwo\nthree\n"), (3, "\none\n\ntwo\nthree\nown"), (4, ""), (5, None), (6, " ".join("w" * 50)),
            (7, "new\n" + " ".join("w" * 50)), (8, "short line"), (9, "short line")]
    out = line_winnowing.removal_report(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out if r.text is not None) == [
        (1, "one\ntwo\nthree\n", 4, 0), (2, "", 4, 3), (3, "\n\nown", 6, 3), (4, "", 0, 0), (6, " ".join("w" * 50), 1, 0), (7, "new", 2, 1),
        (8, "short line", 1, 0), (9, "short line", 1, 0)]


def against_sql(spark, tmp_path, name, table, frame):
    """The registered query and its SQL over a table of one's own."""
    import duckdb
    from shelfwise.llm import queries

    frame.coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    found = queries.QUERIES[name](spark, str(tmp_path))
    sql = queries.ORACLE[name]
    want = db.execute(f"SELECT {', '.join(found.columns)} FROM ({sql})").fetchall()
    got = [tuple(r) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return got


def test_equal_ids_with_different_texts_are_one_node(spark, tmp_path):
    x, y, z = "a b c d e f g h i j k l m n", "q w e r t z u i o p", "one two three four five six"
    rows = [(3, x), (5, x), (5, y), (5, z), (8, z), (9, z.upper()), (5, x), (6, None), (6, "alone here now"), (None, x), (7, "")]
    got = against_sql(spark, tmp_path, "op5_ngram_jaccard_join", "documents", spark.createDataFrame(rows, DOCS))
    assert {r[2] for r in got if r[0] in (3, 5, 8, 9)} == {3} and {r[2] for r in got if r[0] in (6, 7)} == {6, 7}


def test_equal_ids_with_different_vectors_give_a_row_each(spark, tmp_path):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(3, a), (5, a), (5, b), (5, c), (8, c), (9, [0.0, 0.01, 1.0]), (5, a), (6, None), (6, [0.0, 0.0, 0.0]), (6, [-1.0, 0.0, 0.0]), (None, a)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = against_sql(spark, tmp_path, "op6_embedding_near_dedup", "embeddings", frame)
    assert len(got) == len(rows) and {r[2] for r in got if r[0] in (3, 5, 8, 9)} == {3}


def test_rows_without_an_id_are_dealt_by_their_text(spark):
    rows = [(None, f"text {i}") for i in range(400)] + [(7, f"text {i}") for i in range(3)]
    dealt = blocks.chunked(spark.createDataFrame(rows, DOCS), 10).groupBy("rank", "chunk").count().collect()
    null = [r["count"] for r in dealt if r["rank"] == blocks.LAST]
    assert len(null) == 10 and max(null) < 100 and len([r for r in dealt if r["rank"] == 7]) == 1


def test_null_ids_in_several_chunks(spark, small_chunks):
    """The same results as in one chunk: nothing is removed for a null id's sake, and nothing links to it."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    passage = " ".join(rng.choices(words, k=30))
    rows = [(None if i % 3 else i, " ".join(rng.choices(words, k=rng.randrange(80))) + " " + passage) for i in range(150)]
    out = substring_dedup.removal_report(spark.createDataFrame(rows, DOCS)).collect()
    removed = {(r.doc_id, r.n_words): r.n_removed for r in out}
    first = min(i for i, _ in rows if i is not None)
    assert all((n >= 30) == (i != first) for (i, _), n in removed.items())
    groups = jaccard_join.components_of(spark.createDataFrame(rows, DOCS)).collect()
    assert all(r.component_id is None for r in groups if r.doc_id is None) and len(groups) == 150
