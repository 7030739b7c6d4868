"""Document quality from a linear-chain conditional random field over lines.

Every non-empty line is good or bad. Its evidence is its own shape (case, symbols, repeated
words, lengths) and that of the lines before and after it; transitions tie neighbours. Forward and
backward sums give each line its marginal of being good; their mean, weighted by the length of the
lines, is carried through a fitted logistic curve to the document's score.

Only documents are labelled, so each line is trained with the label of its document. The field is
fitted on a bounded sample: per label ``SAMPLE_ROWS`` documents in the order of a hash of their
id, one text of each id, its first ``SAMPLE_CHARS`` characters, and long documents in sequences of
``SEQUENCE`` lines. One task fits it, and only the weights come to the driver. Scoring reads whole texts and runs
whole chains; a task holds the lines of a slice of texts, of one text at least, so a very long one costs it memory
in proportion to its lines.

Defined results: a text that is null, empty or blank is one line of its own kind ("empty") and
gets a score; repeated rows are each scored alike; repeated labels of a document count once, contradicting ones
are each used; of rows with equal ids one text is learned from; null labels are ignored; without training rows of
both labels every score is the share of label 1 (0.5 if there are none); an empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from shelfwise.llm import words as W
from shelfwise.llm.sampling import rows_per_label
from shelfwise.llm.tasks import add_columns, importable

SAMPLE_ROWS = 2_000
SAMPLE_CHARS = 20_000
SEQUENCE = 40
ROUNDS = 150
PREDICT_AT = 0.7
_LINES = 8_192

_LINE = np.ones(256, bool)
_LINE[0x0A] = False


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a:b] = True
    return out


_UPPER, _LOWER = _class((0x41, 0x5B)), _class((0x61, 0x7B))
_DIGIT = _class((0x30, 0x3A))
_BEYOND = _class((0x80, 0x100))
_SPACE = ~W.NOT_SPACE
_STOP = _class((0x2C, 0x2D), (0x2E, 0x2F), (0x27, 0x28), (0x2D, 0x2E))  # , . ' -
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _BEYOND | _SPACE | _STOP)
_SHAPES = ("upper", "digit", "beyond", "symbol", "stop", "bang", "bar", "same", "echo")
_CUTS = {"upper": (0.05, 0.12, 0.3, 0.6), "digit": (0.01, 0.05, 0.2, 0.5), "beyond": (0.3, 0.6),
         "symbol": (0.005, 0.02, 0.05, 0.1, 0.2), "stop": (0.001, 0.02, 0.06, 0.15),
         "bang": (0.005, 0.03, 0.1), "bar": (0.005, 0.03, 0.1), "same": (0.02, 0.1, 0.3, 0.7),
         "echo": (0.1, 0.3, 0.6), "words": (2, 5, 12, 40, 150), "mean": (2.5, 4, 6, 9, 14)}


class Lines(NamedTuple):
    first: np.ndarray  # first line of each text, and the end
    weight: np.ndarray  # bytes
    table: np.ndarray  # lines x features


def lines_of(texts: pd.Series) -> Lines:
    """The lines of the texts with their own features and their neighbours'."""
    found = W.tokenize(texts, _LINE, keys=False)
    word = W.tokenize(texts)
    data, start, end = found.data, found.start, found.end
    size = (end - start).astype(float)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return (total[end] - total[start]) / np.maximum(size, 1)

    at = np.searchsorted(word.start, np.append(start, len(data)))  # first word of each line
    begin, stop = at[:-1], np.searchsorted(word.start, end)
    count = (stop - begin).astype(float)
    letters = np.concatenate(([0], np.cumsum(word.end - word.start)))
    line = np.searchsorted(start, word.start, side="right") - 1

    def repeats(lag: int) -> np.ndarray:
        same = np.zeros(len(word.key) + 1, np.int64)
        if len(word.key) > lag:
            same[lag + 1:] = np.cumsum((word.key[lag:] == word.key[:-lag]) & (line[lag:] == line[:-lag]))
        return (same[stop] - same[begin]) / np.maximum(count, 1)

    values = {"upper": share(_UPPER[data]), "digit": share(_DIGIT[data]), "beyond": share(_BEYOND[data]),
              "symbol": share(_SYMBOL[data]), "stop": share(_STOP[data]), "bang": share(data == 0x21),
              "bar": share(data == 0x7C), "same": repeats(1),
              "echo": np.maximum(repeats(2), repeats(3)), "words": count,
              "mean": (letters[stop] - letters[begin]) / np.maximum(count, 1)}
    own = np.stack([values[name] > cut for name, cuts in _CUTS.items() for cut in cuts], axis=1)
    # a text without lines becomes one line of its own kind
    empty = np.diff(found.first) == 0
    order = np.argsort(np.concatenate((W.owner(found.first), np.flatnonzero(empty))), kind="stable")
    own = np.concatenate((own, np.zeros((int(empty.sum()), own.shape[1]), bool)))[order]
    is_empty = np.concatenate((np.zeros(len(size), bool), np.ones(int(empty.sum()), bool)))[order]
    weight = np.concatenate((size, np.ones(int(empty.sum()))))[order]
    first = np.concatenate(([0], np.cumsum(np.maximum(np.diff(found.first), 1))))
    text = W.owner(first)
    edge = np.concatenate(([True], text[1:] != text[:-1], [True]))
    before = np.zeros_like(own)
    before[1:] = own[:-1]
    before[edge[:-1]] = False
    after = np.zeros_like(own)
    after[:-1] = own[1:]
    after[edge[1:]] = False
    flags = np.stack((np.ones(len(own), bool), is_empty, edge[:-1], edge[1:]), axis=1)
    return Lines(first, weight, np.concatenate((flags, own, before, after), axis=1))


def gathered(texts: pd.Series) -> Lines:
    """The lines of many texts, made slice by slice to bound the memory."""
    parts = [lines_of(p["text"]) for p in W.slices(pd.DataFrame({"text": texts}))]
    sizes = np.concatenate([np.diff(p.first) for p in parts])
    return Lines(np.concatenate(([0], np.cumsum(sizes))), np.concatenate([p.weight for p in parts]),
                 np.concatenate([p.table for p in parts]))


class Field(NamedTuple):
    weights: np.ndarray  # features: evidence that a line is good
    moves: np.ndarray  # 2 x 2: from label, to label
    slope: float
    offset: float


def _chains(first: np.ndarray) -> list[np.ndarray]:
    """For each step the lines that stand there, long chains first."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = first[:-1][order], sizes[order]
    live = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0))
    return [begin[:n] + step for step, n in enumerate(live)]


def _spread(prior: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """One step of sums of products, in logarithms: lines x label -> lines x next label."""
    return np.logaddexp(prior[:, :1] + moves[0], prior[:, 1:] + moves[1])


def marginals(evidence_: np.ndarray, moves: np.ndarray, first: np.ndarray,
              pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each line, and if asked the expected number of each transition."""
    score = np.stack((np.zeros(len(evidence_)), evidence_), axis=1)
    ahead, back = score.copy(), np.zeros_like(score)
    steps = _chains(first)
    for now, then in zip(steps, steps[1:], strict=False):
        ahead[then] += _spread(ahead[now[:len(then)]], moves)
    for now, then in zip(steps[-2::-1], steps[:0:-1], strict=False):
        back[now[:len(then)]] = _spread(score[then] + back[then], moves.T)
    total = ahead + back
    good = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500)))
    expected = np.zeros((2, 2))
    if pairs:
        for now, then in zip(steps, steps[1:], strict=False):
            now = now[:len(then)]
            both = (ahead[now][:, :, None] + moves + (score[then] + back[then])[:, None, :])
            both = np.exp(both - np.logaddexp(total[now][:, 0], total[now][:, 1])[:, None, None])
            expected += both.sum(axis=0)
    return good, expected


def evidence(table: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each line's features; the flags become numbers for some lines at a time."""
    return np.concatenate([np.zeros(0), *(table[i:i + _LINES].astype(np.float64) @ weights for i in range(0, len(table), _LINES))])


def gradient(table: np.ndarray, error: np.ndarray) -> np.ndarray:
    return sum((error[i:i + _LINES] @ table[i:i + _LINES].astype(np.float64) for i in range(0, len(table), _LINES)),
               np.zeros(table.shape[1]))


def fit(texts: pd.Series, labels: np.ndarray, rounds: int = ROUNDS) -> Field | float:
    """A field by gradient ascent, or the share of label 1 if there is nothing to tell apart."""
    labels = np.asarray(labels, float)
    if not len(labels) or labels.min() == labels.max():
        return float(labels.mean()) if len(labels) else 0.5
    lines = gathered(texts)
    table = lines.table
    target = np.repeat(labels, np.diff(lines.first))
    cuts = [np.arange(a, b, SEQUENCE) for a, b in zip(lines.first[:-1], lines.first[1:], strict=True)]
    first = np.append(np.concatenate(cuts), len(table))
    inner = np.ones(len(table), bool)
    inner[first[:-1]] = False
    to = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (target[to - 1].astype(int), target[to].astype(int)), 1)
    # every document counts alike, and both labels together
    share = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    importance = np.repeat(share / np.diff(lines.first), np.diff(lines.first))
    scale = 1 / importance.sum()
    weights, moves = np.zeros(table.shape[1]), np.zeros((2, 2))
    first_moment, second = np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)
    for i in range(1, rounds + 1):
        good, expected = marginals(evidence(table, weights), moves, first, pairs=True)
        slope = np.concatenate((gradient(table, (target - good) * importance) * scale - 1e-4 * weights,
                                ((seen - expected) / len(table)).ravel() - 1e-3 * moves.ravel()))
        first_moment = 0.9 * first_moment + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = 0.1 * first_moment / (1 - 0.9**i) / (np.sqrt(second / (1 - 0.99**i)) + 1e-8)
        weights += move[:-4]
        moves += move[-4:].reshape(2, 2)
    mean = means(lines, weights, moves)
    return Field(weights, moves, *_curve(mean, labels))


def means(lines: Lines, weights: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Marginal of being good per text, weighted by the length of the lines."""
    good, _ = marginals(evidence(lines.table, weights), moves, lines.first)
    return W.sums(good * lines.weight, lines.first) / W.sums(lines.weight, lines.first)


def _curve(mean: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and offset of the logistic curve from mean marginal to label."""
    slope, offset = 4.0, -2.0
    table = np.stack((mean, np.ones(len(mean))), axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(table @ (slope, offset), -30, 30)))
        curve = (table.T * (p * (1 - p))) @ table + 0.1 * np.eye(2)
        change = np.linalg.solve(curve, table.T @ (labels - p) - 0.1 * np.array([slope - 4, offset + 2]))
        slope, offset = slope + change[0], offset + change[1]
    return max(float(slope), 1e-3), float(offset)


def scores(texts: pd.Series, field: Field | float) -> np.ndarray:
    if not isinstance(field, Field):
        return np.full(len(texts), field)
    mean = means(lines_of(texts), field.weights, field.moves)
    return 1 / (1 + np.exp(-np.clip(field.slope * mean + field.offset, -30, 30)))


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Field | float:
    """Fit on the bounded sample; ``labels`` has doc_id and label (0 or 1).

    The sample is drawn from the labels, so that only its few ids, at most ``rows`` per label, meet the texts by a
    broadcast. Equal ids and labels are one row before and after, so copies make neither larger.
    """
    importable(documents.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    known = known.select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    few = rows_per_label(known, rows, text="doc_id").select("doc_id", "label")
    text = F.substring(F.coalesce("text", F.lit("")), 1, SAMPLE_CHARS)
    found = documents.select("doc_id", text.alias("text")).join(F.broadcast(few), "doc_id")
    sample = found.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))

    def one(batches):
        table = pd.concat([pd.DataFrame({"doc_id": [], "label": [], "text": []}), *batches])
        table = table.sort_values(["label", "doc_id"])
        field = fit(table["text"], table["label"].to_numpy(float))
        flat = [field] if not isinstance(field, Field) else [*field.weights, *field.moves.ravel(), field.slope, field.offset]
        yield pd.DataFrame({"field": [flat]})

    row = sample.repartition(1).mapInPandas(one, "field array<double>").first()
    flat = np.array([0.5] if row is None else row[0])  # the plan of a table known to be empty has no task
    if len(flat) == 1:
        return float(flat[0])
    return Field(flat[:-6], flat[-6:-2].reshape(2, 2), float(flat[-2]), float(flat[-1]))


def score(documents: DataFrame, field: Field | float, column: str = "score") -> DataFrame:
    """The documents with a score (0 to 1, higher: label 1 likelier); a column of that name is replaced."""
    shared = documents.sparkSession.sparkContext.broadcast(field)

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(scores(pd.Series(texts.to_pylist(), dtype=object), shared.value))]

    return add_columns(documents, "text", {column: T.DoubleType()}, run)


def held_out(fold: int = 2, folds: int = 4) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == fold, F.lit(False))


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn ``labels.quality`` outside the held-out fold, score every document."""
    field = train(documents.where(~held_out()),
                  labels.where(~held_out()).select("doc_id", F.col("quality").alias("label")))
    scored = score(documents.select("doc_id", "text"), field)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
