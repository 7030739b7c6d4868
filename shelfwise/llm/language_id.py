"""Language by cross-parsing: how few phrases of a language's own text spell a document.

Per language a suffix automaton of sampled training text tells, from any place of a word, how far
the longest match reaches. A word is parsed greedily into such matches; a byte unknown to the
language is a phrase of its own. Phrases end at the ends of words, so every distinct word of a
slice is parsed once. The language with the fewest phrases per letter wins.

Training text is a bounded sample: per language ``SAMPLE_ROWS`` rows in the order of a hash of
their text, of each at most ``SAMPLE_CHARS`` characters, ``TRAIN_CHARS`` per language in all.
Every document is scored over its whole text.

Defined results: a null text, or one without letters, is ``und`` with score 0; so is everything
without training rows. Equal phrase counts go to the language first in the alphabet. Repeated
rows are each scored. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from shelfwise.llm import words as W
from shelfwise.llm.sampling import per_label
from shelfwise.llm.tasks import add_columns

SAMPLE_ROWS = 400
SAMPLE_CHARS = 2_000
TRAIN_CHARS = 100_000
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
LETTERS[0x80:] = True
_MARK = 0x20  # stands before a word, so that beginnings match beginnings


class Automaton:
    """Suffix automaton of the bytes of words: ``moves[state, kind[byte]]``, 0 for no move."""

    def __init__(self, words: list[bytes]) -> None:
        edges: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        for word in words:
            last = 0  # every word starts anew: matches never span two words
            for byte in (_MARK, *word):
                last = self._extend(edges, link, length, last, byte)
        used = sorted({byte for own in edges for byte in own})
        self.kind = np.zeros(256, np.int64)
        self.kind[used] = np.arange(1, len(used) + 1)
        self.moves = np.zeros((len(edges), len(used) + 1), np.int32)
        for state, own in enumerate(edges):
            for byte, to in own.items():
                self.moves[state, self.kind[byte]] = to

    @staticmethod
    def _extend(edges: list, link: list, length: list, last: int, byte: int) -> int:
        """Add a byte behind ``last``; states that are there already are used again."""
        to = edges[last].get(byte)
        if to is not None and length[to] == length[last] + 1:
            return to

        def split(p: int, q: int) -> int:
            edges.append(dict(edges[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            copy = len(edges) - 1
            link[q] = copy
            while p >= 0 and edges[p].get(byte) == q:
                edges[p][byte] = copy
                p = link[p]
            return copy

        if to is not None:
            return split(last, to)
        edges.append({})
        link.append(0)
        length.append(length[last] + 1)
        new, p = len(edges) - 1, last
        while p >= 0 and byte not in edges[p]:
            edges[p][byte] = new
            p = link[p]
        if p >= 0:
            q = edges[p][byte]
            link[new] = q if length[p] + 1 == length[q] else split(p, q)
        return new

    def phrases(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of longest matches that spell each marked word; all words advance together."""
        order = np.argsort(start - end, kind="stable")  # long words first
        start, size = start[order], (end - start)[order]
        kinds = self.kind[data]
        count = np.ones(len(order), np.int64)
        state = np.full(len(order), self.moves[0, self.kind[_MARK]], np.int32)
        for step in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -step))  # words longer than step
            byte = kinds[start[:live] + step]
            here = state[:live]
            to = self.moves[here, byte]
            fresh = (here == 0) | (to == 0)  # an unknown byte leads to 0: a phrase of its own
            count[:live] += fresh
            state[:live] = np.where(fresh, self.moves[0, byte], to)
        out = np.empty(len(order), np.int64)
        out[order] = count
        return out


def training_words(texts: list[str], chars: int = TRAIN_CHARS) -> list[bytes]:
    """Words in the order of the texts, up to ``chars`` bytes in all."""
    found = W.tokenize((t.lower() for t in texts), LETTERS, keys=False)
    fit = int(np.searchsorted(np.cumsum(found.end - found.start + 1), chars, side="right"))
    spans = zip(found.start[:fit].tolist(), found.end[:fit].tolist(), strict=True)
    return [found.data[a:b].tobytes() for a, b in spans]


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
          rows: int = SAMPLE_ROWS) -> dict[str, Automaton]:
    """One automaton per language, from the bounded sample of the labelled rows."""
    few = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.substring(text_col, 1, SAMPLE_CHARS).alias("text"))
    sample = per_label(few, rows, "lang")
    out = {}
    for lang, own in sample.groupby("lang"):
        if words := training_words(own["text"].tolist()):
            out[lang] = Automaton(words)
    return out


def count_phrases(texts: list[str | None], models: list[Automaton]) -> tuple[np.ndarray, np.ndarray]:
    """Per text the phrases of each language (texts x languages), and whether it has a letter."""
    lowered = [t.lower() if isinstance(t, str) else "" for t in texts]
    found = W.tokenize(lowered, LETTERS)
    at, which = distinct(found.key)
    total = np.zeros((len(texts), len(models)), np.int64)
    for j, model in enumerate(models):
        count = model.phrases(found.data, found.start[at], found.end[at])
        total[:, j] = W.sums(count[which], found.first)
    ascii_ = np.concatenate(([0], np.cumsum(LETTERS[found.data] & (found.data < 0x80))))
    letter = ascii_[found.bound[1:]] > ascii_[found.bound[:-1]]
    for i in np.flatnonzero(~letter & (np.diff(found.first) > 0)):
        letter[i] = any(ch.isalpha() for ch in lowered[i])
    return total, letter


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, and for each place the number of its key."""
    order = np.argsort(key)
    ranked = key[order]
    head = np.ones(len(key), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(head) - 1
    return order[head], which


def identify(documents: DataFrame, models: dict[str, Automaton], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """id, lang_pred and score: 1 less the winner's phrases as a share of the runner-up's."""
    names = sorted(models)
    shared = documents.sparkSession.sparkContext.broadcast([models[n] for n in names])

    def run(texts: pa.Array) -> list[pa.Array]:
        total, letter = count_phrases(texts.to_pylist(), shared.value)
        best = choose(total, letter, names)
        return [pa.array(best["lang_pred"], pa.string()), pa.array(best["score"])]

    return add_columns(documents.select(id_col, text_col), text_col,
                       {"lang_pred": T.StringType(), "score": T.DoubleType()}, run).drop(text_col)


def choose(total: np.ndarray, letter: np.ndarray, names: list[str]) -> dict[str, np.ndarray]:
    """The language with the fewest phrases; the number of letters is the same for all."""
    n = len(total)
    if not names:
        return {"lang_pred": np.full(n, "und", object), "score": np.zeros(n)}
    best = np.argmin(total, axis=1)
    low = total[np.arange(n), best].astype(float)
    next_ = np.sort(total, axis=1)[:, 1] if len(names) > 1 else np.full(n, np.inf)
    score = np.where(letter, 1 - low / np.maximum(next_, 1), 0.0)
    return {"lang_pred": np.where(letter, np.array(names, object)[best], "und"),
            "score": np.clip(score, 0, 1)}


def predict(documents: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Learn from all folds but one, predict every document."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == held_out
    models = train(documents.where(~F.coalesce(fold, F.lit(True))))
    scored = identify(documents, models)
    return scored.select("doc_id", F.coalesce(fold, F.lit(False)).alias("held_out"), "lang_pred", "score")
