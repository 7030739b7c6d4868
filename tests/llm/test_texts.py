import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import fm_decontaminate as D, page_diff as P, sentencepiece as S, url_filters as U

import brute

DOCS = "doc_id long, text string"
NASTY = ["", None, " a ", "a  b\n\nc\t\r\n", "▁x é 漢字 😀", "x" * 3_000, "  ", "\n", "Hello world, the end", "\x00\x1f", "the " * 500, "ééé ▁▁"]


@pytest.fixture(scope="module")
def vocabulary():
    return S.load()


def words_of(data, ends, ids, bounds):
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def test_paths_equal_brute_force(vocabulary):
    rng = random.Random(0)
    texts = [t for t in NASTY if t] + ["".join(rng.choices("thequickbrown  é\n", k=60)) for _ in range(60)]
    ids, bounds = S.encode_texts(texts, vocabulary, S.table_of({}))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == brute.piece_ids(text, vocabulary)
    assert S.decode_ids(ids, bounds, vocabulary.pieces) == texts


def test_ids_equal_the_library_in_its_unigram_mode(vocabulary):
    sp = pytest.importorskip("sentencepiece")
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = pb.ModelProto()
    with open(S.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:  # sums in single precision must stay exact
        piece.score = max(piece.score, -40_000)
    library = sp.SentencePieceProcessor()
    library.LoadFromSerializedProto(model.SerializeToString())
    scored = [(t, max(s, -40_000.0), i) for t, s, i in vocabulary.scored]
    own = S.build(vocabulary.pieces, scored, vocabulary.byte_ids)
    rng = random.Random(1)
    texts = ["the hend of ofther thing", "Ärger über naïve cafés", *("".join(rng.choices("etaoinsh rdlu", k=80)) for _ in range(80))]
    ids, bounds = S.encode_texts(texts, own, S.table_of({}))
    got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    scores = {i: s for _, s, i in own.scored}
    for text, mine in zip(texts, got, strict=True):
        theirs = library.encode(text)
        assert mine == theirs or sum(scores[i] for i in mine) == sum(scores[i] for i in theirs)


def test_relational_way_equals_the_way_in_tasks(spark, vocabulary):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("theandé9 ", k=rng.randrange(1, 14))) for _ in range(30)) for _ in range(40)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts, *NASTY])], DOCS)
    table = S.word_table(frame, vocabulary)
    assert len(table) > 200
    for word, ids in table.items():
        want = brute.piece_ids(word[1:], vocabulary) if word[0] == " " else brute.piece_ids("\n" + word, vocabulary)[2:]
        assert ids == want or word in (" ", "\n"), word
    packed = S.packed_words(frame, vocabulary)
    assert all((a == b).all() for a, b in zip(packed, S.table_of(table), strict=True))
    few = S.word_table(frame, vocabulary, limit=50)
    assert 0 < len(few) <= 50
    a, b = (S.encode_texts(texts, vocabulary, S.table_of(t)) for t in (table, {}))
    assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


def test_encode_and_decode_frames(spark, vocabulary):
    rows = [*enumerate(NASTY), (None, "the end"), (3, NASTY[3])]
    frame = spark.createDataFrame(rows, DOCS).withColumn("token_ids", F.lit("x")).withColumn("word", F.lit(1)).withColumn("decoded", F.lit(2))
    out = S.decode(S.encode(frame, vocabulary), vocabulary).collect()
    assert sorted(((r.doc_id, r.decoded, r.word) for r in out), key=repr) == sorted(((i, t, 1) for i, t in rows), key=repr)
    done = S.encoded(frame).collect()
    assert len(done) == len(rows) and all(r.round_trip and r.n_tokens == len(r.token_ids or []) for r in done)
    assert S.encoded(frame.limit(0)).collect() == []
    bad = spark.createDataFrame([([99_999_999],)], "token_ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        S.decode(bad, vocabulary).collect()


def spoiled(seed, n=80):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(12)]
    items += [(20, None), (21, "  .,"), (22, "W1, w2"), (3, items[3][1]), (23, items[0][1]), (None, "w1")]
    docs = []
    for i in range(n):
        own = rng.choices([*words, "other"], k=rng.randrange(60))
        if rng.random() < 0.5:
            at = rng.randrange(len(own) + 1)
            own[at:at] = (rng.choice(items)[1] or "").upper().split()
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(own)))
    return [*docs, (900, None), (901, ""), (902, "w1 " * 3000), (903, "é w1 É")], items


@pytest.mark.parametrize(("size", "block"), [(10, 2_000_000), (3, 2_000_000), (10, 20)])
def test_contamination_equals_brute_force(spark, monkeypatch, size, block):
    monkeypatch.setattr(D, "BLOCK_WORDS", block)
    docs, items = spoiled(size)
    frame = spark.createDataFrame(docs, DOCS).withColumn("items", F.lit(1)).withColumn("spans", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = D.contaminated_spans(frame, bench, size).collect()
    want = brute.contaminated(docs, items, size)
    assert {r.doc_id: (r.n_words, {k for a, b in r.spans for k in range(a, b)}, set(r["items"])) for r in out} == want
    assert all(a[1] < b[0] for r in out for a, b in zip(r.spans, r.spans[1:], strict=False))
    left = D.decontaminate(frame, bench, size)
    assert left.columns == frame.columns
    assert {r.doc_id: r.text for r in left.collect()} == {i: brute.without_hits(t, want[i][1]) for i, t in docs}


@pytest.mark.parametrize("block", [2_000_000, 20])
def test_contamination_reports_every_row(spark, monkeypatch, block):
    """Rows with null or equal ids and as many words stay apart, and repeated rows stay several, in any number of blocks."""
    monkeypatch.setattr(D, "BLOCK_WORDS", block)
    items = [(k, " ".join(f"{c}{k}" for c in "abcdefgh")) for k in range(30)]
    texts = [f"{x} {items[k][1]} {y}" for k, x, y in ((0, "p", "q"), (1, "r", "s"), (2, "p q", ""), (29, "", "v w"))] + ["n " * 10, None, ""]
    docs = [(i, t) for t in texts for i in (None, None, 5, 5)] + [(7, texts[0] + " and " + items[17][1])]
    frame = spark.createDataFrame(docs, DOCS).withColumn("row", F.lit(3)).withColumn("void", F.lit(None))
    bench = spark.createDataFrame(items, "item_id long, text string")
    plain = [brute.contaminated([(0, t)], items, 5)[0] for _, t in docs]
    out = D.contaminated_spans(frame, bench, 5).collect()
    got = [(r.doc_id, r.n_words, sorted(k for a, b in r.spans for k in range(a, b)), sorted(r["items"])) for r in out]
    assert sorted(got, key=repr) == sorted(((i, n, sorted(h), sorted(x)) for (i, _), (n, h, x) in zip(docs, plain, strict=True)), key=repr)
    left = D.decontaminate(frame, bench, 5)
    assert left.columns == frame.columns
    want = [(i, brute.without_hits(t, h)) for (i, t), (_, h, _) in zip(docs, plain, strict=True)]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(want, key=repr)
    assert D.contamination_report(frame.limit(0), bench, 5).collect() == []


def test_contamination_of_empty_tables(spark):
    docs, items = spoiled(1, 5)
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    assert D.contamination_report(frame.limit(0), bench).collect() == []
    none = D.contamination_report(frame, bench.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated or r.n_hit or r.n_items for r in none)


def test_index_counts_and_locates():
    rng = np.random.default_rng(3)
    sequence = np.concatenate((rng.integers(1, 4, 200), [0]))
    index = D.Index(sequence)
    rows = np.array([[a, b, c] for a in (1, 2, 3) for b in (1, 2, 3) for c in (1, 2, 9)])
    low, high = index.search(rows)
    for row, a, b in zip(rows, low, high, strict=True):
        places = [i for i in range(198) if sequence[i:i + 3].tolist() == row.tolist()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


PAGE = """<!DOCTYPE html><html><head><title>no</title><script>if (a < b) "<p>no</p>"</script></head><body>
<nav>no</nav><div class="cookie-notice">no</div><header>no</header><!-- <p>no</p> -->
<article><header><h1>Head&amp;line</h1></header><p>One <b>two</b>&nbsp;three<br>four<p>Un&eacute;<div class="ad">no</div><form>no</form>
<ul><li>a<li>b</ul><aside>no</aside><table><tr><td>c<td>d</table><section id="comments">no</section>last</article>
<div class="sidebar">no</div><footer>no</footer>"""


def test_markup_decides():
    assert P.candidates(PAGE) == [(x, True) for x in ("Head&line", "One two three four", "Uné", "a", "b", "c", "d", "last")]
    assert P.candidates(None) == P.candidates("") == P.candidates("<p></p> <script>x") == []
    assert P.candidates("plain &lt;text&gt; <b>bold") == [("plain <text> bold", False)]
    assert P.blocks("<p hidden>a</p><div style='display: none'>b</div><p>c") == [("a", P.DROPPED), ("b", P.DROPPED), ("c", P.OPEN)]
    deep = "<div>" * 3_000 + "x" + "</div>" * 3_000
    assert P.candidates(deep) == [("x", False)]


@pytest.mark.parametrize("page", [
    "<a x" * 250_000, "<div>" * 200_000, '<a x="' * 170_000 + ">", "<a x='\">" * 120_000, "</script" * 120_000,
    "<script>" + "</script" * 120_000, "<p>" + "<b>" * 100_000 + "<x-y>" + "<div>" * 50_000,
    "<ul>" + "<b>" * 100_000 + "<li></li>" * 50_000, "<!--" * 200_000, "<p " + 'class="' * 120_000 + ">"])
def test_broken_pages_take_time_in_proportion(page):
    start = time.process_time()
    P.blocks(page)
    assert time.process_time() - start < 5


def test_quotes_in_tags():
    assert P.blocks("<p title='a > b'>c</p><p title=\"d'>\">e</p>") == [("c", P.OPEN), ("e", P.OPEN)]
    assert P.blocks("<p>one<p title='x>two</p><p>it's</p>") == [("one", P.OPEN)]
    assert P.blocks("<p>one<p title='x>two</p><p>three</p>") == [("one", P.OPEN), ("two", P.OPEN), ("three", P.OPEN)]
    assert P.blocks("a < b <c d") == [("a < b <c d", P.OPEN)]


def test_shared_lines_are_a_longest_common_subsequence():
    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            old = row[:]
            for j, y in enumerate(b):
                row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
        return row[-1]

    rng = random.Random(5)
    for _ in range(500):
        a, b = (rng.choices("abcd", k=rng.randrange(14)) for _ in range(2))
        own = [x for x, s in zip(a, P.shared(a, b), strict=True) if s]
        rest = iter(b)
        assert all(x in rest for x in own) and len(own) == longest(a, b)


def test_unmarked_pages_differ_from_their_neighbours(spark):
    def page(body):
        return f"<div>Menu</div><div>Shop</div><p>{body}</p><div>Imprint</div>"

    rows = [(1, "http://h.com/a/1", page("one")), (2, "http://h.com/a/2", page("two")), (3, "http://h.com/a/3", page("two")),
            (4, "http://other.com/a", page("alone")), (5, "http://h.com/b", PAGE), (6, None, page("null")), (7, "http://h.com/a/2", None),
            (None, "http://h.com/a/9", page("nine")), (8, "nowhere", page("x"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("lines", F.lit(1))
    out = P.main_texts(frame.coalesce(1))
    got = {r.page_id: r.text for r in out.collect()}
    whole = "Menu\nShop\n{}\nImprint"
    assert got == {1: "one", 2: "two", 3: "two", 4: whole.format("alone"), 5: "\n".join(t for t, _ in P.candidates(PAGE)),
                   6: whole.format("null"), 7: "", None: "nine", 8: whole.format("x")}
    assert {(r.page_id, r.url) for r in out.collect()} == {(i, u) for i, u, _ in rows}
    assert P.main_texts(frame.limit(0)).collect() == []


def test_articles_differ_from_their_neighbours(spark):
    """Every page goes through the difference: an article that the neighbour repeats whole is none where another one is new."""
    def page(*bodies):
        return "<nav>Menu</nav>" + "".join(f"<article><p>{b}</p><p>{b} too</p></article>" for b in bodies)

    rows = [(1, "http://h.com/1", page("one", "teaser")), (2, "http://h.com/2", page("teaser", "two")),
            (3, "http://h.com/3", page("teaser", "two")), (4, "http://h.com/4", page("two")),
            (5, "http://other.com/", page("alone", "teaser")), (6, "http://h.com/3a", "<div>x</div>"), (6, "http://h.com/3a", "<div>x</div>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text) for r in P.main_texts(frame).collect())
    assert got == [(1, "one\none too"), (2, "two\ntwo too"), (3, "two\ntwo too"), (4, "two\ntwo too"), (5, "alone\nalone too\nteaser\nteaser too"),
                   (6, "x"), (6, "x")]


@pytest.mark.parametrize("ranges", [1, 7, 60])
def test_differences_do_not_depend_on_the_ranges(spark, ranges):
    """Long runs of copies fill ranges, and hosts begin and end anywhere: every page gets the partner of a plain pass."""
    rng = random.Random(9)
    pages = [("whole.com", "same")] * 25 + [("alone.com", "one")]
    pages += [(f"h{k % 5}.com", rng.choice(["x", "y", "z"])) for k in range(30)]
    for host, parts in (("a.com", [("p", 30), ("q", 1), ("p", 25)]), ("b.com", [("p", 1), ("q", 40)]), ("c.com", [("p", 40), ("q", 1)])):
        pages += [(host, body) for body, n in parts for _ in range(n)]
    rows = [(i, f"http://{h}/{i:03d}", f"<div>Menu {h}</div><p>{b}</p><div>Imprint</div>") for i, (h, b) in enumerate(pages)]
    lines = {i: [f"Menu {h}", b, "Imprint"] for i, (h, b) in enumerate(pages)}
    want = {}
    for host in {h for h, _ in pages}:
        own = [i for i, (h, _) in enumerate(pages) if h == host]
        for at, i in enumerate(own):
            start = at
            while start and lines[own[start - 1]] == lines[i]:
                start -= 1
            near = own[start - 1] if start else next((j for j in own[at:] if lines[j] != lines[i]), None)
            want[i] = "\n".join(lines[i] if near is None else [pages[i][1]])
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert {r.page_id: r.text for r in P.main_texts(frame).collect()} == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


URLS = [(None, "", ""), ("", "", ""), ("no scheme", "", ""), ("http://A.Org", "a.org", ""), ("http://A.org/B?c/d#e", "a.org", "/B"),
        ("http://a.org?x=http://b/c", "a.org", ""), ("x://h#f", "h", ""), ("://É.COM/x/", "É.com", "/x/"),
        ("http://a/b://c", "a", "/b://c"), ("http://a\nb/c\nd", "a\nb", "/c\nd"), ("http:///p", "", "/p")]


def test_hosts_and_paths(spark):
    frame = spark.createDataFrame([(u,) for u, _, _ in URLS], "url string")
    host, path = U.split_url(F.col("url"))
    assert [tuple(r) for r in frame.select(host, path).collect()] == [(h, p) for _, h, p in URLS]


def test_longest_rule_wins(spark):
    def plain(host, path):
        fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: len(r.rule), default=None)

    hosts = ["org", "a.org", "example.org", "x.example.org", "myexample.org", "com", "a.com", "acom", "net", ""]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12", "/en/2", "/fr/", "/de/x", "/x/de/"]
    rows = [(h, p) for h in hosts for p in paths]
    out = spark.createDataFrame(rows, "host string, path string").select("host", "path", U.matched(F.col("host"), F.col("path"), U.RULES).alias("by"))
    for r in out.collect():
        assert (r.by and r.by.rule) == (want := plain(r.host, r.path)) or (want and (r.by.rule, r.by.verdict) == (want.rule, want.verdict))


def plain_verdicts(rows):
    """The tree, branch and purity rules in loops over all pages."""
    import re
    from collections import defaultdict

    pages = []
    for i, url in rows:
        at = (url or "").find("://")
        rest = url[at + 3:] if at >= 0 else ""
        host = re.match(r"(?s)[^/?#]*", rest)[0]
        path = re.match(r"(?s)[^?#]*", rest[len(host):])[0]
        host = brute.lower(host)
        fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.rule), default=None)
        pages.append((i, host, path, rule, tuple(re.sub("[0-9]+", "#", path).split("/", U.DEPTH + 1))))
    template = {(h, s): () for _, h, _, _, s in pages}
    for level in range(U.DEPTH + 2):
        node, own = defaultdict(int), defaultdict(int)
        for _, h, _, _, s in pages:
            value = s[level] if level < len(s) else None
            node[h, template[h, s]] += 1
            own[h, template[h, s], value] += 1
        new = {}
        for h, s in template:
            t = template[h, s]
            if level < len(s):
                n = own[h, t, s[level]]
                keep = re.search(U.NUMBER, s[level]) or (n >= U.MIN_PAGES and n >= U.MIN_SHARE * node[h, t])
                t = (*t, s[level] if keep else "*")
            new[h, s] = t
        template = new
    count = defaultdict(lambda: [0, 0])
    shapes = defaultdict(lambda: [0, 0])
    for _, h, _, rule, s in pages:
        for c in (count[h, "/".join(template[h, s])], shapes[s]):
            c[0] += rule is not None
            c[1] += rule is not None and rule.verdict == "block"
    total = [sum(c[k] for c in shapes.values()) for k in (0, 1)]
    base = total[1] / total[0] if total[0] else 0.0
    branches = defaultdict(list)
    for (h, t), (n, k) in count.items():
        p = (k + 1) / (n + 2)
        branches[h, re.sub(r"[^/*#]+(?=(/[*#][^/]*)*/?$)", "?", t), n > 0].append((p, t, n, k))
    merged = {}
    for (h, _, known), own in branches.items():
        steps = defaultdict(list)
        for p, t, n, k in own:
            steps[min(int(p * U.BINS), U.BINS - 1) if known else 0].append((t, n, k))
        groups = []  # templates, pages and blocked pages of each branch
        for _, step in sorted(steps.items()):
            n, k = sum(x[1] for x in step), sum(x[2] for x in step)
            if groups:
                (p, v), (q, w) = ((s, s * (1 - s) / (m + 2)) for s, m in (((k + 1) / (n + 2), n), ((groups[-1][2] + 1) / (groups[-1][1] + 2), groups[-1][1])))
            if not groups or abs(p - q) >= U.APART * (v + w) ** 0.5:
                groups.append([[], 0, 0])
            groups[-1] = [groups[-1][0] + [t for t, _, _ in step], groups[-1][1] + n, groups[-1][2] + k]
        for names, n, k in groups:
            for t in names:
                merged[h, t] = (n, k)
    out = {}
    for i, h, path, rule, s in pages:
        n, k = merged[h, "/".join(template[h, s])]
        prior = (shapes[s][1] + U.STRENGTH * base) / (shapes[s][0] + U.STRENGTH)
        purity = (k + U.STRENGTH * prior) / (n + U.STRENGTH)
        out[i] = (h, path, rule and rule.rule, rule.verdict if rule else "block" if purity >= U.REJECT else "allow", round(purity, 9))
    return out


def test_verdicts_equal_brute_force(spark):
    rng = random.Random(6)
    hosts = ["a.org", "example.org", "x.example.org", "a.com", "b.net", "c.net"]
    rows = []
    for i in range(900):
        parts = [rng.choice(["en", "es", "de", "fr"]), *(rng.choice(["news", "shop", f"t{rng.randrange(99)}x", str(rng.randrange(50))]) for _ in range(rng.randrange(3)))]
        rows.append((i, f"http://{rng.choices(hosts, [5, 3, 1, 5, 2, 1])[0]}/{'/'.join(parts)}{rng.choice(['', '/', '.html', '?q', '#x'])}"))
    rows += [(1000 + k, u) for k, (u, _, _) in enumerate(URLS)] + [(2000, "http://a.com/" + "x/" * 500), (2001, rows[0][1])]
    frame = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("template", F.lit(1))
    out = {r.page_id: (r.host, r.path, r["rule"], r.verdict, round(r.purity, 9)) for r in U.judge(frame).collect()}
    want = plain_verdicts(rows)
    assert out == want and {v[3] for v in want.values() if v[2] is None} == {"allow", "block"}
    nulls = spark.createDataFrame([(None, "http://b.net/x"), (None, None)], "page_id long, url string")
    assert sorted((r.page_id, r.verdict) for r in U.judge(nulls).collect()) == [(None, "allow"), (None, "allow")]
    assert U.judge(frame.limit(0)).collect() == []


def test_wide_and_deep_nodes_have_no_share_cut(spark, monkeypatch):
    """A section below 2% of its host keeps its own verdict, and so does one after the eighth segment."""
    words = [f"{a}{b}" for a in "abcdefghijkl" for b in "mnopqrstuvwx"]
    rows = [f"http://example.org/en/{i}/{w}" for w in words for i in range(6)]
    rows += [f"http://big.com/{'de' if k % 3 else 'fr'}/{w}/{i}" for k, w in enumerate(words) for i in range(1 + k % 7)]
    deep = "a/b/c/d/e/f/g/h/i"
    rows += [f"http://big.com/{x}/{deep}/{y}/{i}" for x in ("de", "fr", "it") for y in ("one", "two") for i in range(7)]
    rows += [f"http://big.com/es/{deep}/{y}/{z}/{i}" for y in "pq" for z in words[:30] for i in range(2)] + ["http://big.com/" + "x/" * 400]
    rows = list(enumerate(rows))
    frame = spark.createDataFrame(rows, "page_id long, url string")
    wide = {r.page_id: r for r in U.judge(frame, min_share=0, depth=None).collect()}
    assert wide[7].template == "/en/#/an" and "/".join(["", "it", deep, "one", "#"]) in {r.template for r in wide.values()}
    monkeypatch.setattr(U, "MIN_SHARE", 0)
    monkeypatch.setattr(U, "DEPTH", 420)
    want = plain_verdicts(rows)
    assert {i: (r.host, r.path, r["rule"], r.verdict, round(r.purity, 9)) for i, r in wide.items()} == want


def test_branches_do_not_chain_from_clean_to_blocked(spark):
    """21 sections of 50 pages with 0%, 5%, ... 100% blocked: neighbours are alike, the ends are not."""
    counts = [("h", f"/s{i:02d}/*", 50, round(2.5 * i)) for i in range(21)] + [("h", "/none/*", 0, 0), ("g", "/s00/*", 50, 0)]
    out = {(r.host, r.template): (r.n, r.k) for r in U.merged(
        spark.createDataFrame(counts, "host string, template string, labelled long, blocked long")).collect()}
    shares = [out["h", f"/s{i:02d}/*"] for i in range(21)]
    assert all(k / n < 0.2 for n, k in shares[:2]) and all(k / n > 0.8 for n, k in shares[-2:])
    assert len(set(shares)) >= 4 and sum(n for n, _ in set(shares)) == 1050
    assert out["h", "/none/*"] == (0, 0) and out["g", "/s00/*"] == (50, 0)


def test_a_small_section_of_a_large_host_keeps_its_template(spark):
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    rows = [f"http://h.net/{w}/{p}" for w in words for p in "abcdefgh"]
    frame = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    assert {r.template for r in U.judge(frame, min_share=0, depth=None).collect()} == {f"/{w}/*" for w in words}
    assert all(r.template.startswith("/*/") for r in U.judge(frame).collect())
