"""Licence scans by a positional index of rare words.

A template is a short run of words; the words in brackets are its mandatory key phrases, and each must stand at its
place relative to the others. Other words only count for the score. The index holds, for each template, its two
key words with the highest inverse document frequency over all documents, with their places in the template. A scan
looks up those words of a file that the index has, so never its common words. A hit of the rarest word with its
partner at the right distance is a candidate; then all key words are compared at their places. Every
place where the key phrases stand holds both rare words, so none is lost; frequencies decide the work, not the result.

All of it is one projection over the documents: no shuffle of texts, no join. The index is a constant of the plan with
two postings per template. Only the frequencies of the templates' own words are counted first, in one pass.

Defined results: null and empty texts have no words, no labels and score 0; repeated documents are each reported; places
that overlap all count; very long texts take memory in proportion to their words in one task; a template needs two key
words at least; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.tasks import unused

#: Longest runs of ASCII digits, ASCII letters and everything beyond ASCII; the JVM matches a class of what
#: is in it many times faster than one of all that is not.
WORDS = r"[0-9A-Za-z\P{ASCII}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases that always give their label.
BASE = [
    ("cc-by", "[cc by]"),
    ("gpl", "[general public license]"),
    ("reserved", "[all rights reserved]"),
]

# Labels and wordings of common licences. Brackets hold what must stand.
TEMPLATES = [
    ("agpl-3.0", "gnu [affero general public license] version 3"),
    ("apache-2.0", "licensed under the [apache license version 2 0]"),
    ("apache-2.0", "released under the [apache license 2 0]"),
    ("artistic-2.0", "the [artistic license 2 0]"),
    ("bsd", "[redistribution and use in source and binary forms with or without modification are permitted] provided that the following conditions are met"),
    ("bsd", "released under the [bsd license]"),
    ("bsd-2-clause", "licensed under the [bsd 2 clause] license"),
    ("bsd-3-clause", "licensed under the [bsd 3 clause] license"),
    ("bsd-3-clause", "may be used to [endorse or promote products derived from this software without specific prior written permission]"),
    ("bsl-1.0", "distributed under the [boost software license version 1 0]"),
    ("cc-by-4.0", "licensed under [cc by 4 0]"),
    ("cc-by-4.0", "licensed under a [creative commons attribution 4 0] international license"),
    ("cc-by-nc", "licensed under [cc by nc] 4 0"),
    ("cc-by-nc", "[creative commons attribution noncommercial] 4 0 international license"),
    ("cc-by-nc-nd", "licensed under [cc by nc nd] 4 0"),
    ("cc-by-nc-sa", "licensed under [cc by nc sa] 4 0"),
    ("cc-by-nd", "licensed under [cc by nd] 4 0"),
    ("cc-by-sa", "licensed under [cc by sa] 4 0"),
    ("cc-by-sa", "[creative commons attribution sharealike] 4 0 international license"),
    ("cc0-1.0", "[cc0 1 0] universal public domain dedication"),
    ("epl-2.0", "the terms of the [eclipse public license] v 2 0"),
    ("gpl-2.0", "gnu [general public license version 2]"),
    ("gpl-2.0", "gnu general public license [either version 2 of the license] or at your option any later version"),
    ("gpl-3.0", "this work is licensed under the [gnu general public license version 3]"),
    ("gpl-3.0", "gnu general public license [either version 3 of the license] or at your option any later version"),
    ("isc", "[permission to use copy modify and or distribute this software for any purpose with or without fee] is hereby granted"),
    ("lgpl", "gnu [lesser general public license] version 3"),
    ("mit", "released under the [mit license]"),
    ("mit", "[permission is hereby granted free of charge to any person obtaining a copy of this software] and associated documentation files"),
    ("mpl-2.0", "subject to the terms of the [mozilla public license v 2 0]"),
    ("mpl-2.0", "the [mozilla public license version 2 0]"),
    ("unlicense", "this is [free and unencumbered software released into the public domain]"),
    ("zlib", "[altered source versions must be plainly marked as such] and must not be misrepresented as being the original software"),
]


class Template(NamedTuple):
    label: str
    base: bool
    words: tuple[str, ...]
    keys: tuple[int, ...]  # places of the words that must stand


def parse(label: str, text: str, base: bool = False) -> Template:
    words, keys, inside = [], [], False
    for token in text.split():
        inside = inside or token.startswith("[")
        if inside:
            keys.append(len(words))
        inside = inside and not token.endswith("]")
        words.append(token.strip("[]"))
    if len(keys) < 2:
        raise ValueError(f"a template needs two key words: {text}")
    return Template(label, base, tuple(words), tuple(keys))


def all_templates() -> list[Template]:
    return [parse(label, text, True) for label, text in BASE] + [parse(label, text) for label, text in TEMPLATES]


def lowered(word: Column) -> Column:
    """A-Z only."""
    return F.translate(word, _UPPER, _LOWER)


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text.cast("string"), F.lit(WORDS), F.lit(0)), F.array().cast("array<string>"))


def frequencies(documents: DataFrame, templates: list[Template], text_col: str = "text") -> dict[str, int]:
    """In how many documents each key word occurs. At most one row per word of the templates comes back."""
    vocabulary = sorted({t.words[k] for t in templates for k in t.keys})
    words = documents.select(words_of(F.col(text_col)).alias("words"))
    # lower() is cheap on ASCII but also folds letters beyond it, so the few words it leaves are looked up again
    some = F.transform(F.filter("words", lambda w: F.lower(w).isin(vocabulary)), lowered)
    own = F.array_distinct(F.filter(some, lambda w: w.isin(vocabulary)))
    rows = words.select(F.explode(own).alias("word")).groupBy("word").count().collect()
    return {r["word"]: r["count"] for r in rows}


def index(templates: list[Template], found_in: dict[str, int]) -> dict[str, list[dict]]:
    """For each template's rarest key word a posting: all words relative to its place, the next rare word first."""
    postings: dict[str, list[dict]] = {}
    for template in templates:
        rare = sorted(template.keys, key=lambda k: (found_in.get(template.words[k], 0), template.words[k], k))
        anchor, partner = rare[:2]
        rest = [k for k in template.keys if k not in (anchor, partner)]
        at = lambda k: {"at": k - anchor, "word": template.words[k]}  # noqa: B023, E731
        postings.setdefault(template.words[anchor], []).append({
            "label": template.label, "base": template.base, "first": template.keys[0] - anchor, "last": template.keys[-1] - anchor,
            "must": [at(k) for k in (partner, *rest, anchor)], "may": [at(k) for k in range(len(template.words)) if k not in template.keys]})
    return postings


_WORD = "array<struct<at: int, word: string>>"
_POSTINGS = f"array<struct<label: string, base: boolean, first: int, last: int, must: {_WORD}, may: {_WORD}>>"


def matches(words: Column, postings: dict[str, list[dict]]) -> Column:
    """label, base, start, end (last word), agree and of (words of the template) for each place of a template."""
    table, none = F.from_json(F.lit(json.dumps(postings)), f"map<string, {_POSTINGS}>"), F.array().cast(_POSTINGS)
    stands = lambda i, w: F.coalesce(lowered(F.get(words, i + w["at"])) == w["word"], F.lit(False))
    # lower() also folds letters beyond ASCII; such a word is looked up in vain and fails the comparison
    hits = F.filter(F.transform(words, lambda w, i: F.when(F.lower(w).isin(sorted(postings)), i)), lambda i: i.isNotNull())

    def at_hit(i: Column) -> Column:
        mine = F.coalesce(F.try_element_at(table, lowered(F.get(words, i))), none)
        good = F.filter(mine, lambda p: F.forall(p["must"], lambda w: stands(i, w)))
        return F.transform(good, lambda p: F.struct(
            p["label"].alias("label"), p["base"].alias("base"), (i + p["first"]).alias("start"), (i + p["last"]).alias("end"),
            (F.size(p["must"]) + F.size(F.filter(p["may"], lambda w: stands(i, w)))).alias("agree"),
            (F.size(p["must"]) + F.size(p["may"])).alias("of")))

    return F.flatten(F.transform(hits, at_hit))


def scan(documents: DataFrame, templates: list[Template] | None = None, text_col: str = "text", words_col: str = "n_words",
         matches_col: str = "matches") -> DataFrame:
    """The documents with their number of words and the places of all templates."""
    templates = all_templates() if templates is None else templates
    postings = index(templates, frequencies(documents, templates, text_col))
    name = unused("__words", documents)
    kept = [documents[c] for c in documents.columns if c.lower() not in (words_col.lower(), matches_col.lower())]
    return (documents.select(*kept, words_of(F.col(text_col)).alias(name))
            .select("*", F.size(name).cast("long").alias(words_col), matches(F.col(name), postings).alias(matches_col)).drop(name))


def scan_report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score: the best share of a template's words."""
    found = scan(documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    base = found.withColumn("places", F.transform(F.filter("matches", lambda m: m["base"]), lambda m: m["start"].cast("long")))
    names = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda m: m["label"]))), ",")
    return base.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"), names(F.filter("matches", lambda m: m["base"])).alias("base_labels"),
        names(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["agree"] / m["of"])), F.lit(0.0)).alias("score"))
