"""Removal of passages that an earlier document has already.

A word goes if a window of ``WINDOW`` consecutive words that covers it also starts in a document
with a smaller id. Overlapping windows join to maximal spans.

Every pair of documents would have to meet for automata of reference shards, since every document
is a reference for all later ones; the references neither fit a broadcast nor have another bound. So
equal windows are found by their keys instead, in two exchanges of packed blocks (``blocks``):

1. Each window has an anchor, the least of the keys of its 5-word runs, equal wherever the window
   occurs. Anchors that two documents share are found; other windows are unique.
2. The windows with shared anchors are exchanged with their smallest document, and each chunk
   learns which of its windows started in an earlier document elsewhere.

Windows are compared by 96 bits of two independent keys.

Defined results: null and empty texts have no words; texts shorter than a window lose none; ids
are integers, a null id counts as larger than all others, rows with equal ids do not remove from
each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm import blocks as B, words as W

WINDOW = 13
ANCHOR = 5
_SECOND = 0x5851F42D4C957F2D


class Chunk:
    """Windows of a chunk's documents."""

    def __init__(self, frame: pd.DataFrame, window: int) -> None:
        self.rank = frame["rank"].to_numpy(np.int64)
        self.found = W.tokenize(frame["text"])
        self.window = window
        self.start, text = W.whole_windows(self.found.first, window)
        self.doc = self.rank[text]
        size = min(ANCHOR, window)
        least = sliding_min(W.windows(self.found.key, size), window - size + 1)
        self.anchors, self.anchor = B.distinct(least[self.start] if len(self.start) else np.zeros(0, np.uint64))

    def several(self) -> np.ndarray:
        """Anchors of two or more documents of this chunk."""
        low, high = extremes(self.anchor, self.doc, len(self.anchors))
        return low < high

    def shared(self, bits: pd.DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows with shared anchors, their distinct keys (sorted; two parts), and their places there."""
        own = np.flatnonzero(B.flags_of(bits, 1, self.anchors, parts)[self.anchor])
        at = self.start[own]
        first = W.windows(self.found.key, self.window)
        second = W.windows(self.found.key, self.window, _SECOND)
        first = first[at] if len(at) else np.zeros(0, np.uint64)
        second = (second[at] if len(at) else np.zeros(0, np.uint64)).astype(np.uint32)
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
        head = np.ones(len(own), bool)
        head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        which = np.empty(len(own), np.int64)
        which[order] = np.cumsum(head) - 1
        return own, a[head], b[head], which


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Least of each ``size`` neighbours, by doubling."""
    width = 1
    while width * 2 <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest and len(values) > rest else values


def extremes(which: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest document of each key."""
    low, high = np.full(n, B.LAST), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(low, which, doc)
    np.maximum.at(high, which, doc)
    return low, high


def remove_repeats(documents: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """id, n_words, n_removed, and the kept words joined by one space (null for a null text)."""
    source = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    chunks, parts = B.layout(source)
    texts = B.chunked(source, chunks)

    def anchors(key, frame):
        own = Chunk(frame, window)
        return B.pack(key[0], parts, own.anchors, flag=own.several())

    def repeated(frame):
        keys, which = B.distinct(B.unpack(frame, "keys", np.uint64))
        hot = np.bincount(which, minlength=len(keys)) > 1
        hot[which[B.unpack(frame, "flag", bool)]] = True
        return B.answer(frame, hot[which], 1)

    def candidates(key, frame, bits):
        if not len(frame):
            return B.pack(0, parts, np.zeros(0, np.uint64), more=np.zeros(0, np.uint32), doc=np.zeros(0))
        own = Chunk(frame, window)
        at, first, second, which = own.shared(bits, parts)
        low, _ = extremes(which, own.doc[at], len(first))
        return B.pack(key[0], parts, first, more=second, doc=low)

    def earlier(frame):
        keys, more = B.unpack(frame, "keys", np.uint64), B.unpack(frame, "more", np.uint32)
        doc = B.unpack(frame, "doc", np.int64)
        order = np.lexsort((doc, more, keys))
        k, m, d = keys[order], more[order], doc[order]
        head = np.ones(len(k), bool)
        head[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
        least = d[np.maximum.accumulate(np.where(head, np.arange(len(d)), 0))]
        flags = np.zeros(len(k), bool)
        flags[order] = d > least
        return B.answer(frame, flags, 2)

    def kept(frame, bits):
        if not len(frame):
            return pd.DataFrame({"rank": [], "n_words": [], "n_removed": [], "kept": []})
        own = Chunk(frame, window)
        at, first, _, which = own.shared(bits, parts)
        low, _ = extremes(which, own.doc[at], len(first))
        gone = B.flags_of(bits, 2, first, parts)[which] | (own.doc[at] > low[which])
        return cut(frame, own, own.start[at[gone]])

    blocks = texts.groupBy("chunk").applyInPandas(anchors, "part int, chunk int, keys binary, flag binary")
    bits = blocks.groupBy("part").applyInPandas(repeated, B._BITS)
    pairs = (texts.groupBy("chunk").cogroup(bits.groupBy("chunk"))
             .applyInPandas(candidates, "part int, chunk int, keys binary, more binary, doc binary"))
    later = pairs.groupBy("part").applyInPandas(earlier, B._BITS)
    out = (texts.groupBy("chunk").cogroup(bits.unionByName(later).groupBy("chunk"))
           .applyInPandas(kept, "rank long, n_words long, n_removed long, kept string"))
    return out.select(F.when(F.col("rank") != B.LAST, F.col("rank")).alias(id_col), "n_words", "n_removed", "kept")


def cut(frame: pd.DataFrame, own: Chunk, start: np.ndarray) -> pd.DataFrame:
    """The documents without the words of the windows at ``start``."""
    found = own.found
    n = len(found.start)
    cover = np.bincount(start, minlength=n + 1) - np.bincount(start + own.window, minlength=n + 1)
    keep = np.cumsum(cover[:n]) == 0
    left = np.flatnonzero(keep)
    size = found.end[left] - found.start[left] + 1
    ends = np.cumsum(size)
    flat = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(found.start[left] - (ends - size), size)
    data = found.data[flat]
    data[ends - 1] = 0x20  # whatever stood behind a word
    raw = data.tobytes()
    bound = np.concatenate(([0], ends))[np.searchsorted(left, found.first)].tolist()
    texts = [raw[a:b - 1].decode("utf-8", "surrogatepass") if b > a else "" for a, b in
             zip(bound[:-1], bound[1:], strict=True)]
    kept = W.sums(keep, found.first)
    return pd.DataFrame({"rank": own.rank, "n_words": np.diff(found.first),
                         "n_removed": np.diff(found.first) - kept, "kept": texts})


def removal_report(documents: DataFrame) -> DataFrame:
    """The digest of ``remove_repeats``."""
    return remove_repeats(documents).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
