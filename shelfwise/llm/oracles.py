"""Expected results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from shelfwise.llm.license_scan import all_templates

#: Lower-cased words of a text column, as a list; null has none.
_WORDLIKE = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP5 = r"""
WITH RECURSIVE doc AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS r,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingle AS (SELECT DISTINCT r, doc_id, array_to_string(list_slice(w, i, i + least(3, len(w)) - 1), ' ') AS s
            FROM (SELECT r, doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, any_value(a.doc_id) AS one, any_value(b.doc_id) AS two, count(*) AS c
           FROM shingle a JOIN shingle b USING (s) WHERE a.doc_id < b.doc_id GROUP BY a.r, b.r),
link AS (SELECT DISTINCT one AS a, two AS b FROM common JOIN size x ON x.r = a JOIN size y ON y.r = b
         WHERE 100 * c >= 90 * (x.n + y.n - c)),
both_ AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM doc WHERE len(w) > 0 UNION SELECT reach.doc_id, b FROM reach JOIN both_ ON a = r)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(CASE WHEN n IS NOT NULL THEN m END, d.doc_id) AS component_id
FROM doc d LEFT JOIN size USING (r) LEFT JOIN (SELECT doc_id, min(r) AS m FROM reach GROUP BY doc_id) USING (doc_id)
"""

_OP6 = """
WITH RECURSIVE every AS MATERIALIZED (SELECT vec_id, embedding, row_number() OVER () AS r FROM embeddings),
vec AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, r FROM every
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.r, a.vec_id AS a, b.vec_id AS b FROM vec a JOIN vec b ON a.r <> b.r AND len(a.v) = len(b.v)
         WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT DISTINCT vec_id, vec_id AS s FROM vec UNION SELECT reach.vec_id, b FROM reach JOIN link ON a = s),
placed AS (SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(CASE WHEN v.r IS NOT NULL THEN m END, e.vec_id) AS component_id
           FROM every e LEFT JOIN vec v ON v.r = e.r LEFT JOIN (SELECT r, count(*) AS n FROM link GROUP BY r) l ON l.r = e.r
           LEFT JOIN (SELECT vec_id, min(s) AS m FROM reach GROUP BY vec_id) x ON x.vec_id = e.vec_id)
SELECT *, coalesce(component_id = vec_id, true) AS kept FROM placed
"""

_OP7 = f"""
WITH item AS (SELECT DISTINCT item_id, {_WORDLIKE.format('text')} AS w FROM benchmark WHERE item_id IS NOT NULL),
phrase AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS p
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, coalesce({_WORDLIKE.format('text')}, []) AS w FROM documents),
place AS (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
          FROM doc, (SELECT DISTINCT len(p) AS size FROM phrase) WHERE len(w) >= size),
found AS (SELECT doc_id, i, size, item_id FROM place JOIN phrase ON p = list_slice(w, i, i + size - 1)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS pos FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
          FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP10 = r"""
WITH doc AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 12), ' ')) AS k
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM doc WHERE len(w) > 12)),
gone AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS m FROM win) WHERE m < doc_id),
word AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS pos FROM gone),
lost AS (SELECT doc_id, list(pos) AS p FROM word GROUP BY doc_id),
each AS (SELECT doc_id, w[pos] AS one, pos FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS pos FROM doc)
         ANTI JOIN word USING (doc_id, pos)),
kept AS (SELECT doc_id, string_agg(one, ' ' ORDER BY pos) AS t FROM each GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(p), 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_OP9 = r"""
WITH line AS (
  SELECT doc_id, x, i FROM (SELECT doc_id, unnest(l) AS x, unnest(generate_series(1, len(l))) AS i
                            FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))),
filled AS (SELECT doc_id, x, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n,
                  greatest(len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')), 1) AS words FROM line WHERE trim(x) <> ''),
run AS (SELECT a.doc_id, a.n, [a.x, b.x, c.x] AS xs, [a.i, b.i, c.i] AS places
        FROM filled a JOIN filled b ON b.doc_id = a.doc_id AND b.n = a.n + 1
        JOIN filled c ON c.doc_id = a.doc_id AND c.n = a.n + 2
        UNION ALL SELECT a.doc_id, a.n, [a.x, b.x], [a.i, b.i]
        FROM filled a JOIN filled b ON b.doc_id = a.doc_id AND b.n = a.n + 1 WHERE a.words + b.words >= 50
        UNION ALL SELECT doc_id, n, [x], [i] FROM filled WHERE words >= 50),
later AS (SELECT doc_id, places FROM (
            SELECT doc_id, places, row_number() OVER (PARTITION BY xs ORDER BY doc_id, n) AS place FROM run)
          WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, unnest(places) AS i FROM later),
kept AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY i) AS t, count(*) AS left_
         FROM line ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
had AS (SELECT doc_id, count(*) AS n FROM line GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t, '') END AS text,
       CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE n END AS n_lines,
       CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE n - coalesce(left_, 0) END AS n_removed
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN had USING (doc_id)
"""


_OP11 = f"""
WITH doc AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, w, CAST(len(w) AS BIGINT) AS n
  FROM (SELECT doc_id, {_WORDLIKE.format('text')} AS w FROM documents) WHERE len(w) > 0),
term AS (SELECT DISTINCT item_id, unnest({_WORDLIKE.format('text')}) AS t FROM benchmark),
place AS MATERIALIZED (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM doc) SEMI JOIN term USING (t) GROUP BY r, t),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM doc),
weight AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
           FROM place, whole GROUP BY t, docs),
norm AS (SELECT r, doc_id, 10 + (90 * n * docs) // words AS m FROM doc, whole),
scored AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM term JOIN place USING (t) JOIN weight USING (t) JOIN norm USING (r) GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
                  doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def _op12() -> str:
    words = ", ".join(f"({n}, '{t.label}', {t.base}, {i - t.keys[0]}, '{w}', {i in t.keys})"
                      for n, t in enumerate(all_templates()) for i, w in enumerate(t.words))
    return f"""
WITH template(t, label, base, place, word, key) AS (VALUES {words}),
need AS (SELECT t, any_value(label) AS label, any_value(base) AS base, count(*) AS n, count(*) FILTER (key) AS keys FROM template GROUP BY t),
doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDLIKE.format('text')}, []) AS w FROM documents),
word AS MATERIALIZED (SELECT r, unnest(w) AS word, unnest(generate_series(0, len(w) - 1)) AS pos FROM doc),
may AS (SELECT r, t, pos AS start FROM word JOIN template USING (word) WHERE place = 0),
met AS (SELECT r, m.t, start, count(*) AS agree, count(*) FILTER (key) AS keys
        FROM may m JOIN template x ON x.t = m.t JOIN word USING (r) WHERE word.pos = start + place AND word.word = x.word GROUP BY ALL),
found AS (SELECT r, start, label, base, agree / n AS share FROM met JOIN need USING (t) WHERE met.keys = need.keys),
sums AS (SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
                max(share) AS score FROM found GROUP BY r),
named AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels, string_agg(label, ',' ORDER BY label) FILTER (base) AS base_labels
          FROM (SELECT r, label, bool_or(base) AS base FROM found GROUP BY r, label) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM doc LEFT JOIN sums USING (r) LEFT JOIN named USING (r)
"""


def _op13(rounds: int = 6) -> str:
    """Rounds written one after the other; positions go through the vectors in order, 8 parts of ``width`` each."""
    books = """
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p, k ORDER BY vec_id NULLS LAST, embedding) - 1 AS e, k, x AS c
  FROM part JOIN first USING (r))"""
    for n in range(1, rounds + 2):
        books += f""",
near{n} AS MATERIALIZED (
  SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d
  FROM (SELECT r, p, e, sum((x - c) * (x - c)) AS d FROM part JOIN book{n - 1} USING (p, k) GROUP BY r, p, e)
  GROUP BY r, p)"""
        if n <= rounds:
            books += f""",
mean{n} AS (SELECT p, e, k, sum(x) AS s, count(*) AS n FROM near{n} JOIN part USING (r, p) GROUP BY p, e, k),
book{n} AS MATERIALIZED (SELECT p, e, k, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
                         FROM book{n - 1} LEFT JOIN mean{n} USING (p, e, k))"""
    last = rounds + 1
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, embedding, row_number() OVER () AS r FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
size AS (SELECT CAST((max(len(embedding)) + 7) // 8 AS BIGINT) AS width FROM kept),
first AS (SELECT r, vec_id, embedding FROM kept ORDER BY vec_id NULLS LAST, embedding LIMIT 16),
part AS MATERIALIZED (
  SELECT r, j // width AS p, j % width AS k, CAST(coalesce(floor(4096 * CAST(embedding[j + 1] AS DOUBLE)), 0) AS HUGEINT) AS x
  FROM (SELECT r, embedding, width, unnest(generate_series(0, 8 * width - 1)) AS j FROM kept, size)),{books},
own AS (SELECT r, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM near{last} GROUP BY r),
sums AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM kept JOIN own USING (r) GROUP BY label)
SELECT vec_id, code, error, label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, k)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN own USING (r) JOIN sums ON sums.label IS NOT DISTINCT FROM kept.label
"""


ORACLE: dict[str, str] = {"op5_ngram_jaccard_join": _OP5, "op6_embedding_near_dedup": _OP6,
                          "op7_decontamination": _OP7, "op9_line_dedup": _OP9, "op10_substring_dedup": _OP10,
                          "op11_ranked_search": _OP11, "op12_license_scan": _op12(),
                          "op13_vector_codes": _op13()}
