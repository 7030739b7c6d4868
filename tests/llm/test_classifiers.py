import random
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfwise.llm import crf_quality as Q, language_id as L, words as W

DOCS = "doc_id long, text string, lang string, source string"
SYLLABLES = {"xx": "ba be bi bo bu da de di".split(), "yy": "ka ké ki ko ku sa se si".split(), "zz": "ra re ri no nu ma me mi".split()}


def spoken(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def test_phrases_equal_brute_force():
    rng = random.Random(2)
    train = [w.encode() for w in spoken(rng, "yy", 300).split()]
    parts = {(b" " + w)[i:j] for w in train for i in range(len(w) + 1) for j in range(i + 1, len(w) + 2)}
    model = L.Automaton(train)
    words = [w.encode() for w in spoken(rng, "yy", 200).split() + spoken(rng, "xx", 200).split()] + [b"", b"q", b"kaqka", b"k" * 3000]

    def plain(word):
        word, at, count = b" " + word, 0, 0
        while at < len(word):
            end = at
            while end < len(word) and word[at:end + 1] in parts:
                end += 1
            count, at = count + 1, max(end, at + 1)
        return count

    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    got = model.phrases(data, end - [len(w) for w in words], end)
    assert got.tolist() == [plain(w) for w in words]


def test_languages_on_the_held_out_fold(spark):
    rng = random.Random(3)
    docs = [(i, spoken(rng, lang := rng.choice(sorted(SYLLABLES)), rng.randrange(5, 80)), lang, "s") for i in range(300)]
    odd = [(900, None, "xx", "s"), (901, "", "yy", None), (902, "12 !? 3", "xx", "s"), (903, "— …", None, "s"), (904, "É", None, "s"),
           (905, "ba" * 60_000, "xx", "s"), (None, "ké ko kusa", None, "s"), (906, docs[0][1], docs[0][2], "s"), (906, docs[0][1], docs[0][2], "s")]
    frame = spark.createDataFrame(docs + odd, DOCS).withColumn("score", F.lit("x")).withColumn("held_out", F.lit(2))
    out = L.predict(frame).collect()
    assert len(out) == len(docs) + len(odd)
    by = {r.doc_id: r for r in out}
    for i in (900, 901, 902, 903):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[904].lang_pred in SYLLABLES and by[905].lang_pred == "xx" and by[None].lang_pred == "yy" and not by[None].held_out
    tested = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 5 == 0]
    assert all(by[d[0]].held_out for d in tested) and np.mean([by[d[0]].lang_pred == d[2] for d in tested]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_languages_without_training_rows_and_ties(spark):
    frame = spark.createDataFrame([(1, "abc", None, "s")], DOCS)
    assert [(r.lang_pred, r.score) for r in L.predict(frame).collect()] == [("und", 0.0)]
    assert L.predict(frame.limit(0)).collect() == []
    same = L.train(spark.createDataFrame([(2, "abc abd", "b", "s"), (3, "abc abd", "a", "s")], DOCS))
    assert [(r.lang_pred, r.score) for r in L.identify(frame, same).collect()] == [("a", 0.0)]


def test_marginals_equal_all_labelings():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5):
        evidence, moves = rng.normal(size=n), rng.normal(size=(2, 2))
        weight = {}
        for code in range(2**n):
            y = [code >> i & 1 for i in range(n)]
            weight[tuple(y)] = np.exp(sum(e * v for e, v in zip(evidence, y, strict=True)) + sum(moves[a, b] for a, b in zip(y, y[1:], strict=False)))
        total = sum(weight.values())
        good, pairs = Q.marginals(np.concatenate((evidence, evidence[:2])), moves, np.array([0, n, n + min(n, 2)]), pairs=True)
        want = [sum(w for y, w in weight.items() if y[i]) / total for i in range(n)]
        assert np.allclose(good[:n], want)
        count = np.zeros((2, 2))
        for y, w in weight.items():
            for a, b in zip(y, y[1:], strict=False):
                count[a, b] += w / total
        if n > 2:
            pairs = Q.marginals(evidence, moves, np.array([0, n]), pairs=True)[1]
            assert np.allclose(pairs, count)


def test_scores_do_not_depend_on_the_batch():
    rng = random.Random(4)
    texts = ["\n".join(spoken(rng, "xx", rng.randrange(1, 9)) for _ in range(rng.randrange(6))) for _ in range(60)] + [None, "", "\n\n", "  "]
    field = Q.Field(np.random.default_rng(1).normal(size=Q.lines_of(pd.Series(["a"])).table.shape[1]), np.array([[1.0, -1], [0, 0.5]]), 5.0, -2.0)
    whole = Q.scores(pd.Series(texts, dtype=object), field)
    each = [Q.scores(pd.Series([t], dtype=object), field)[0] for t in texts]
    assert np.allclose(whole, each) and ((whole >= 0) & (whole <= 1)).all()


def test_quality_on_the_held_out_fold(spark):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        lines = [spoken(rng, "xx", rng.randrange(3, 20)).capitalize() + "." for _ in range(rng.randrange(2, 9))]
        if not good:
            lines[1:] = [x.upper().replace(" ", "!! ") for x in lines[1:]] * 3
        docs.append((i, "\n".join(lines), "xx", "s"))
        labels.append((i, int(good), 0))
    docs += [(900, None, None, None), (901, "", "xx", "s"), (902, " \n ", "xx", "s"), (903, "x" * 200_000, "xx", "s"), (None, "Ba be.", "xx", "s"),
             (904, docs[0][1], "xx", "s"), (904, docs[0][1], "xx", "s")]
    labels += [(5000, 1, 0), (None, 1, 0), (7, None, 0), (900, 0, 1)]
    frame = spark.createDataFrame(docs, DOCS).withColumn("score", F.lit("x")).withColumn("label", F.lit(3)).withColumn("quality", F.lit(3))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("t")).withColumn("n", F.lit(0))
    out = Q.quality(frame, marks).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    by = {r.doc_id: r for r in out}
    tested = [x for x in labels[:400] if zlib.crc32(str(x[0]).encode()) % 4 == 2]
    assert all(by[i].held_out for i, _, _ in tested)
    assert np.mean([by[i].predicted == q for i, q, _ in tested]) > 0.95


def test_the_sample_holds_one_text_per_id_and_label(spark):
    """Copies of a labelled id and repeated labels do not make it larger; the fit is that of the plain sample."""
    rng = random.Random(6)
    rows = [(i, "\n".join(spoken(rng, "xx", 8) for _ in range(4)) if i % 2 else "A! " * 20, "xx", "s") for i in range(40)]
    labels = [(i, i % 2) for i in range(40)]
    plain = Q.fit(pd.Series([t for _, t, _, _ in sorted(rows, key=lambda r: (r[0] % 2, r[0]))], dtype=object), np.repeat([0, 1], 20))
    many = spark.createDataFrame([*rows, *[rows[3]] * 3000], DOCS)
    marks = spark.createDataFrame([*labels, *[labels[3]] * 3000], "doc_id long, label int")
    field = Q.train(many, marks)
    assert np.allclose(field.weights, plain.weights) and np.allclose(field[2:], plain[2:])
    assert isinstance(Q.train(many, marks, rows=5), Q.Field)


def test_quality_without_labels(spark):
    frame = spark.createDataFrame([(1, "abc", "xx", "s"), (2, None, "xx", "s")], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in Q.quality(frame, none).collect()] == [0.5, 0.5]
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert {r.score for r in Q.quality(frame, ones).collect()} == {1.0}
    assert Q.quality(frame.limit(0), ones).collect() == []


def test_letters_beyond_ascii_are_words():
    found = W.tokenize(["été x1y"], L.LETTERS)
    assert np.diff(found.first).tolist() == [3]
