import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import bitsliced_search as search
from shelfwise.llm.scratch import stored

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in WORD.findall(text or "")]


def brute(docs, items, top=10):
    tfs = [(i, Counter(terms(t))) for i, t in docs]
    tfs = [(i, c) for i, c in tfs if c]
    total = sum(c.total() for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in queries.items():
        found = []
        for i, c in tfs:
            m = 10 + 90 * c.total() * len(tfs) // total
            score = sum(math.floor(1000 * math.log((2 * len(tfs) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, n + 1, None if null else i, -s) for n, (s, null, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Äpfel", "naïve", "x9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.choice([1, 5, 30, 200]))) for _ in range(n)]
    texts += [texts[0]] * 15 + [texts[1].upper(), "", "...", "w1 " * 5000, "y" * 40_000, " ".join(f"u{i}" for i in range(9000))]
    docs = [*enumerate(texts), (n + 50, None), (3, "w3 w3 w299"), (3, "w3 w3 w299"), (None, texts[0]), (None, texts[2])]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(25)]
    items += [(100, texts[0]), (101, None), (102, ""), (103, "nowhere to be found"), (104, "w1"), (None, "w2 W3"), (104, "w5")]
    return docs, items


def got(frame):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect()), key=repr)


def test_equals_brute_force(spark, monkeypatch):
    docs, items = corpus(1, 300)
    frame = spark.createDataFrame(docs, DOCS).repartition(5).withColumn("score", F.lit("own")).withColumn("rank", F.lit("own"))
    asked = spark.createDataFrame(items, ITEMS).withColumn("item", F.lit("own"))
    want = brute(docs, items)
    assert got(search.ranking(frame, asked)) == want
    monkeypatch.setattr(search, "BLOCK_TERMS", 40)  # several blocks of items over one stored index
    index = stored(search.build(frame))
    assert got(search.search(index, asked)) == want
    assert got(search.search(index, asked, top=3)) == brute(docs, items, 3)


def test_empty_tables(spark):
    none, asked = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a")], ITEMS)
    for d, i in ((none, items), (docs, asked), (none, asked), (spark.createDataFrame([(1, None), (2, " ")], DOCS), items)):
        out = search.ranking(d, i)
        assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_shards_do_not_matter(monkeypatch, seed):
    docs, items = corpus(seed, 150)
    monkeypatch.setattr(search, "SHARD_DOCS", 7)
    table = pa.table({"id": pa.array([i for i, _ in docs], pa.int64()), "text": [t for _, t in docs]})
    shards = [s for row in search._shards(table.to_batches(max_chunksize=5)) for s in search._cells(row)]
    assert len(shards) > 20
    own = [sorted(set(search.tokenize([t], search.WORDLIKE, lower=True).key.tolist())) for _, t in items]
    keys = np.array(sorted(set().union(*own)), np.uint64)
    found = sum(np.isin(keys, c["keys"][a:b]).astype(int) for _, _, c in shards
                for a, b in zip(np.cumsum(c["sizes"]) - c["sizes"], np.cumsum(c["sizes"]), strict=True))
    n, words = sum(len(c["ids"]) for _, _, c in shards), sum(int(c["lengths"].sum()) for _, _, c in shards)
    assert (n, words) == (sum(bool(terms(t)) for _, t in docs), sum(len(terms(t)) for _, t in docs))
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in found])
    what = search.Weighted(search.Query(keys, [np.searchsorted(keys, np.array(t, np.uint64)) for t in own]), weight, n, words)
    task, scored = search.Searcher(what, 10), 0
    for width, levels, cells in shards:
        norm = search.norms(cells["lengths"], n, words)
        bound = task.bounds(width, levels, cells["slices"], norm)
        every = search.Searcher(what, len(norm))
        every.score(search.Docs(*(cells[c] for c in search.Docs._fields)), norm, [np.arange(len(norm))] * len(items))
        for i, (total, _, _) in enumerate(every.best):
            assert all(b >= s for b, s in zip(sorted(bound[i].tolist(), reverse=True), sorted(total.tolist(), reverse=True), strict=False))
        scored += task.shard(width, levels, cells)
    assert scored < 0.9 * n * len(items)
    top = {}
    for item, _, _, score in brute(docs, [(i, t) for i, (_, t) in enumerate(items)]):
        top.setdefault(item, []).append(score)
    assert {i: sorted(b[0].tolist()) for i, b in enumerate(task.best) if len(b[0])} == {i: sorted(s) for i, s in top.items()}


def test_a_task_holds_one_shard_at_a_time(spark, monkeypatch):
    """Shards reach a task one by one, and the session's setting is as before."""
    before, seen, plain = spark.conf.get(search.BATCH_ROWS), [], search.best

    def best(*args):
        seen.append(spark.conf.get(search.BATCH_ROWS))
        return plain(*args)

    monkeypatch.setattr(search, "best", best)
    documents = spark.createDataFrame([(i, f"word{i} common") for i in range(20)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "common word3")], "item_id long, text string")
    assert {r.doc_id for r in search.ranking(documents, items).where("rank = 1").collect()} == {3}
    assert seen == ["1"] and spark.conf.get(search.BATCH_ROWS) == before


def test_index_is_stored_in_groups_of_few_shards(spark, monkeypatch):
    """However many shards a task writes, it holds few of them; readers take them one by one."""
    seen, plain = [], search.build

    def build(documents):
        seen.append(spark.conf.get(search.BATCH_ROWS))
        return plain(documents)

    monkeypatch.setattr(search, "build", build)
    before = spark.conf.get(search.BATCH_ROWS), spark.conf.get(search.READER_ROWS)
    docs = [(i, " ".join(map(str, range(i * 10**6, i * 10**6 + search.SHARD_TERMS + 1)))) for i in range(6)]
    index = search.stored_index(spark.createDataFrame(docs, DOCS).coalesce(1))
    sizes = []
    for name in index.inputFiles():
        meta = pq.ParquetFile(name.removeprefix("file://")).metadata
        sizes += [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
    assert sum(sizes) == len(docs) and max(sizes) <= 2
    assert seen == [str(search.BATCH_DOCS)] and before == (spark.conf.get(search.BATCH_ROWS), spark.conf.get(search.READER_ROWS))
    with search.single_rows(spark):
        assert spark.conf.get(search.READER_ROWS) == "1"
    asked = spark.createDataFrame([(1, "3000001 3000002"), (2, "5000000")], ITEMS)
    assert [(i, d) for i, _, d, _ in got(search.search(index, asked))] == [(1, 3), (2, 5)]
