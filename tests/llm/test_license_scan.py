import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import license_scan

DOCS = "doc_id long, text string"


def words(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, templates):
    """Every template tried at every place."""
    out = []
    for i, text in docs:
        own, found = words(text), []
        for t in templates:
            for s in range(-len(t.words), len(own)):
                same = [0 <= s + k < len(own) and own[s + k] == w for k, w in enumerate(t.words)]
                if all(same[k] for k in t.keys):
                    found.append((t.label, t.base, s + t.keys[0], sum(same) / len(same)))
        base = [s for _, b, s, _ in found if b]
        out.append((i, len(own), len(base), min(base, default=None), max(base, default=None),
                    ",".join(sorted({n for n, b, _, _ in found if b})), ",".join(sorted({n for n, *_ in found})),
                    max((x for *_, x in found), default=0.0)))
    return sorted(out, key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    texts = [text.replace("[", "").replace("]", "") for _, text in license_scan.BASE + license_scan.TEMPLATES]
    out = []
    for i in range(n):
        parts = [rng.choice(["the", "license", "cc", "by", "all", "rights", "reserved", "version 2", "Öffentlich", "public"])
                 for _ in range(rng.randrange(12))]
        for _ in range(rng.randrange(3)):
            own = rng.choice(texts).split()
            if rng.random() < 0.4:
                own[rng.randrange(len(own))] = "changed"
            if rng.random() < 0.2:
                own = own[1:]
            parts.insert(rng.randrange(len(parts) + 1), rng.choice([str, str.upper, str.title])(rng.choice([" ", ", ", "\n* "]).join(own)))
        out.append((i, " ".join(parts)))
    return out


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_equals_brute_force(spark):
    docs = corpus(1, 250)
    docs += [docs[5], (5, "cc by"), (300, None), (301, ""), (302, "..."), (303, "Cc-By!cc\x00by CC by by cc  by"), (None, "ALL RIGHTS RESERVED"),
             (304, "all rights reserved " * 20_000), (305, "x" * 300_000 + " cc by"), (306, "K cc Kby gnu İ MIT licenſe"),
             (307, "cc"), (308, "general public licensé"), (309, "license version 2 0"), (310, "apache license version 2.0")]
    frame = spark.createDataFrame(docs, DOCS)
    assert got(license_scan.scan_report(frame)) == brute(docs, license_scan.all_templates())


def test_frequencies_choose_the_words_but_not_the_result(spark):
    docs = corpus(2, 60)
    frame, templates = spark.createDataFrame(docs, DOCS), license_scan.all_templates()
    counts = license_scan.frequencies(frame, templates)
    assert counts["license"] == sum("license" in words(t) for _, t in docs)
    postings = license_scan.index(templates, counts)
    assert sum(map(len, postings.values())) == len(templates)
    for word, own in postings.items():
        for posting in own:
            assert all(counts.get(word, 0) <= counts.get(w["word"], 0) for w in posting["must"])
    name = F.col("w")
    base = frame.select("doc_id", license_scan.words_of(F.col("text")).alias("w"))
    results = [got(base.select("doc_id", license_scan.matches(name, license_scan.index(templates, c)).alias("m"))
                   .select("doc_id", F.sort_array("m").alias("m"))) for c in (counts, {}, {w: -n for w, n in counts.items()})]
    assert results[0] == results[1] == results[2] and any(r[1] for r in results[0])


def test_own_templates_and_other_columns(spark):
    mine = [license_scan.parse("own", "given [under the] old [terms]"), license_scan.parse("own-2", "[a a] b")]
    frame = spark.createDataFrame([(1, "Under the new terms. a a a b", "x", "y")], "doc_id long, text string, __words string, places string")
    row = license_scan.scan(frame, mine).collect()[0]
    assert (row["__words"], row["places"], row["n_words"]) == ("x", "y", 8)
    assert sorted((m["label"], m["start"], m["end"], m["agree"], m["of"]) for m in row["matches"]) == [
        ("own", 0, 3, 3, 5), ("own-2", 4, 5, 2, 3), ("own-2", 5, 6, 3, 3)]
    with pytest.raises(ValueError, match="two key words"):
        license_scan.parse("short", "the [license] text")


def test_empty_table(spark):
    out = license_scan.scan_report(spark.createDataFrame([], DOCS))
    assert out.collect() == [] and out.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def test_no_python_in_the_plan(spark):
    plan = license_scan.scan_report(spark.createDataFrame([(1, "cc by")], DOCS).selectExpr("*"))._jdf.queryExecution().toString()
    assert not re.search("PythonUDF|InPandas|InArrow|ArrowEval|Exchange", plan)
