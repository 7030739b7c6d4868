"""The registered operators next to their SQL, and the pipeline next to plain versions of its stages."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
import corpus_pipeline  # noqa: E402
from compare import TABLES, compare  # noqa: E402
from shelfwise.llm import crf_quality, queries as llm, sentencepiece  # noqa: E402

import brute  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@needs_tables
@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    assert compare(spark, db, FOLDER, name).startswith("ok")


def test_names():
    assert sorted(int(n.split("_")[0][2:]) for n in llm.QUERIES) == list(range(1, 14))
    assert set(llm.ORACLE) <= set(llm.QUERIES)


@needs_tables
def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    marks = spark.read.parquet(f"{FOLDER}/labels.parquet").where(~crf_quality.held_out())
    field = crf_quality.train(docs.where(~crf_quality.held_out()), marks.select("doc_id", F.col("quality").alias("label")))
    table = docs.select("doc_id", "text").toPandas()
    good = table[crf_quality.scores(table["text"], field) >= 0.7]
    assert 0 < len(good) < len(table)
    left = brute.without_repeated_lines(list(good.itertuples(index=False, name=None)), 3, 50)
    groups = brute.jaccard_groups(list(left.items()), 5, 80, 100)
    kept = [(i, t) for i, t in left.items() if groups[i][1] == i]
    assert len(kept) < len(left)
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute.contaminated(kept, items, 10)
    assert any(h for _, h, _ in hits.values())
    vocabulary = sentencepiece.load()
    want = {i: brute.piece_ids(brute.without_hits(t, hits[i][1]), vocabulary) for i, t in kept}
    out = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id: list(r.token_ids) for r in out} == want and all(r.round_trip for r in out)


@needs_tables
def test_stages_take_odd_rows(spark):
    """Nulls, blanks, repeated rows and clashing columns; all but the last stage return the columns."""
    rows = [(1, "A good line of text.\nAnother one here.\nAnd a third.", "en", "s", 5), (2, None, None, None, None), (3, "", "en", "s", 0),
            (None, "A good line of text.", "en", "s", 1), (1, "A good line of text.\nAnother one here.\nAnd a third.", "en", "s", 5),
            (4, "x" * 50_000, "en", "s", 50_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("score", "rank", "component", "__rank", "__places", "token_ids", "key", "items"):
        frame = frame.withColumn(name, F.lit("own"))
    for docs in (frame, frame.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            got = out.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == frame.columns, name
                assert all(r["score"] == "own" and r["__rank"] == "own" for r in got)
                if name not in ("quality classifier", "n-gram Jaccard join"):
                    assert len(got) == docs.count()
            else:
                assert len(got) == docs.count() and all(r.round_trip for r in got)


def test_stage_list():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
