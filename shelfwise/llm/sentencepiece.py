"""Encoding into subword pieces, and back, by best paths through a lattice of pieces.

The best path is the one with the largest sum of piece scores (unigram segmentation). A space
belongs to the word behind it, and no piece has a space behind another character or a line feed
inside, so words are segmented one by one.

Frequent words take the relational way: substrings of bounded length are exploded, joined to the
piece table, grouped by word, and folded with a higher-order aggregate. This table holds at most
``FREQUENT`` words, found by their counts over all documents, and is broadcast. Tasks
encode documents in place and build the same lattice in arrays for the words that
the table lacks, so no text is shuffled and no word is missing. Both ways take the same
path: edges in the order of their start, an equal sum does not replace an earlier one.

A character without a piece costs the lowest score less 10 and becomes its byte pieces. As in the
library whose files are read, a space is put before each text and taken off again; but a
text's own U+2581 is kept apart from the space by its byte pieces, so decoding gives every text back.

Defined results: a null text gives null ids, an empty one none; repeated texts are encoded alike;
unknown ids fail the decoding; control pieces decode to nothing; other columns are kept, one that
clashes with a result is replaced.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfwise.llm import words as W
from shelfwise.llm.scratch import cut
from shelfwise.llm.tasks import add_columns, importable, nulls

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
FREQUENT = 65_536
LONGEST = 32  # longer words are left to the tasks, whose cost is linear in their length
MAX_PIECES = 1_000_000  # the vocabulary is broadcast
SLICE_BYTES = 2_000_000
CHUNK_BYTES = 200_000
_SPACE = 0x20
_MARK = "▁"


class Vocabulary(NamedTuple):
    """Pieces as bytes with a space for the mark, and a trie of the scored ones."""

    pieces: list[bytes]
    scored: list[tuple[str, float, int]]
    byte_ids: np.ndarray
    unknown: float
    keys: np.ndarray  # node * 256 + byte, sorted
    nodes: np.ndarray  # the node each key leads to
    ids: np.ndarray  # piece that ends at a node, or -1
    scores: np.ndarray


def load(path: str = MODEL) -> Vocabulary:
    """Read a piece file; its pieces must not reach over a word's end."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    if size > MAX_PIECES:
        raise ValueError(f"{size} pieces; at most {MAX_PIECES} can be broadcast")
    pieces: list[bytes] = [b""] * size
    scored = []
    byte_ids = np.full(256, -1, np.int64)
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            pieces[i] = bytes([int(piece[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            if _MARK in piece.lstrip(_MARK) or "\n" in piece or " " in piece:
                raise ValueError(f"piece {piece!r} reaches over the end of a word")
            pieces[i] = piece.replace(_MARK, " ").encode()
            scored.append((piece.replace(_MARK, " "), model.get_score(i), i))
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary has no piece for some byte")
    return build(pieces, scored, byte_ids)


def build(pieces: list[bytes], scored: list[tuple[str, float, int]], byte_ids: np.ndarray) -> Vocabulary:
    moves: dict[int, int] = {}
    ids, scores = [-1], [0.0]
    for text, value, i in scored:
        node = 0
        for byte in text.encode():
            to = moves.get(node * 256 + byte)
            if to is None:
                to = moves[node * 256 + byte] = len(ids)
                ids.append(-1)
                scores.append(0.0)
            node = to
        ids[node], scores[node] = i, value
    keys = np.array(sorted(moves), np.int64)
    nodes = np.array([moves[k] for k in keys.tolist()], np.int64)
    unknown = min((s for _, s, _ in scored), default=0.0) - 10
    return Vocabulary(pieces, scored, byte_ids, unknown, keys, nodes, np.array(ids), np.array(scores))


# The relational way

def frequent_words(documents: DataFrame, text_col: str, limit: int) -> DataFrame:
    """At most ``limit`` words, those above a count that leaves no more; counted over all texts."""
    words = F.regexp_extract_all(F.concat(F.lit(" "), F.col(text_col)), F.lit(r"( *[^ \n]+|\n| +)"))
    counted = (documents.where(F.length(text_col) > 0).select(F.explode(words).alias("word"))
               .where(F.length("word") <= LONGEST).groupBy("word").agg(F.count("*").alias("n")))
    counted = cut(counted.where("n > 1"))
    level = F.least("n", F.lit(10_000))  # at most that many levels
    seen, floor = 0, 10_001
    for n, words_ in sorted(counted.groupBy(level.alias("level")).count().collect(), reverse=True):
        seen += words_
        if seen > limit:
            break
        floor = n
    return counted.where(F.col("n") >= floor).select("word")


def lattice(words: DataFrame, pieces: DataFrame, unknown: float, longest: int) -> DataFrame:
    """Edges of each word: substrings that are pieces, and single characters that are none."""
    start = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("start"))
    room = F.least(F.lit(longest), F.length("word") - F.col("start") + 1)
    parts = (start.select("word", "start", F.explode(F.sequence(F.lit(1), room)).alias("size"))
             .select("word", "start", "size", F.substring("word", F.col("start"), F.col("size")).alias("piece")))
    joined = parts.join(F.broadcast(pieces), "piece", "left")
    known = F.col("id").isNotNull()
    return joined.where(known | (F.col("size") == 1)).select(
        "word", F.struct(F.col("start"), F.col("size"), F.coalesce("score", F.lit(unknown)).alias("score"),
                         F.coalesce("id", F.lit(-1)).alias("id")).alias("edge"))


def best_paths(edges: DataFrame) -> DataFrame:
    """word and its best path as (id, start, size), folded over the edges in the order of their start."""
    node = "array<struct<sum:double,id:int,start:int,size:int>>"
    grouped = edges.groupBy("word").agg(F.array_sort(F.collect_list("edge")).alias("edges"))
    begin = F.transform(F.sequence(F.lit(0), F.length("word")), lambda i: F.struct(
        F.when(i == 0, F.lit(0.0)).alias("sum"), F.lit(-1).alias("id"), F.lit(0).alias("start"), F.lit(0).alias("size")))

    def relax(best: Column, edge: Column) -> Column:
        # best[i]: the path to the end of character i
        total = best[edge["start"] - 1]["sum"] + edge["score"]
        to = edge["start"] + edge["size"] - 1
        old = best[to]["sum"]
        new = F.struct(total.alias("sum"), edge["id"].alias("id"), edge["start"].alias("start"), edge["size"].alias("size"))
        return F.when(old.isNull() | (total > old),
                      F.transform(best, lambda x, i: F.when(i == to, new).otherwise(x))).otherwise(best)

    best = F.aggregate("edges", begin.cast(node), relax)
    steps = F.aggregate(  # backwards from the end, step by step
        F.sequence(F.lit(1), F.length("word")),
        F.struct(F.length("word").alias("at"), F.array().cast("array<struct<id:int,start:int,size:int>>").alias("path")),
        lambda state, _: F.when(state["at"] == 0, state).otherwise(F.struct(
            (F.col("best")[state["at"]]["start"] - 1).alias("at"),
            F.concat(F.array(F.struct(F.col("best")[state["at"]]["id"], F.col("best")[state["at"]]["start"],
                                      F.col("best")[state["at"]]["size"]).cast("struct<id:int,start:int,size:int>")),
                     state["path"]).alias("path"))))["path"]
    return grouped.withColumn("best", best).select("word", steps.alias("path"))


class Table(NamedTuple):
    """Words with known ids, by key."""

    key: np.ndarray
    bound: np.ndarray
    ids: np.ndarray


def table_of(words: dict[str, list[int]]) -> Table:
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    ends = np.cumsum([len(r) for r in raw]).astype(np.int64)
    begin = np.concatenate(([0], ends))[:-1].astype(np.int64)
    key = word_keys(np.frombuffer(b"".join(raw), np.uint8), begin, ends) if raw else np.zeros(0, np.uint64)
    order = np.argsort(key)
    lists = list(words.values())
    lists = [lists[i] for i in order.tolist()]
    return Table(key[order], np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64),
                 np.array([i for x in lists for i in x], np.int64))


def word_paths(documents: DataFrame, vocabulary: Vocabulary, text_col: str, limit: int) -> DataFrame:
    """The frequent words and their best paths, by the relational way."""
    pieces = piece_table(documents.sparkSession, vocabulary)
    longest = max((len(t) for t, _, _ in vocabulary.scored), default=1)
    return best_paths(lattice(frequent_words(documents, text_col, limit), pieces, vocabulary.unknown, longest))


def path_ids(word: str, path: list, byte_ids: np.ndarray) -> list[int]:
    ids: list[int] = []
    for step in path:
        raw = word[step["start"] - 1:step["start"] - 1 + step["size"]].encode()
        ids += [step["id"]] if step["id"] >= 0 else byte_ids[list(raw)].tolist()
    return ids


def word_table(documents: DataFrame, vocabulary: Vocabulary, text_col: str = "text",
               limit: int = FREQUENT) -> dict[str, list[int]]:
    """Ids of the frequent words."""
    rows = word_paths(documents, vocabulary, text_col, limit).collect()  # at most ``limit`` short words
    return {word: path_ids(word, path, vocabulary.byte_ids) for word, path in rows}


def packed_words(documents: DataFrame, vocabulary: Vocabulary, text_col: str = "text", limit: int = FREQUENT) -> Table:
    """The same as arrays; one task packs them, at most ``limit`` short words, so the driver holds a few MB only."""
    importable(documents.sparkSession)
    byte_ids = vocabulary.byte_ids

    def pack(batches):
        words = {}
        for batch in batches:
            for word, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words[word] = path_ids(word, path, byte_ids)
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in table_of(words)], names=list(Table._fields))

    paths = word_paths(documents, vocabulary, text_col, limit)
    row = paths.repartition(1).mapInArrow(pack, "key binary, bound binary, ids binary").first()
    if row is None:  # the plan of a table known to be empty has no task
        return table_of({})
    return Table(*(np.frombuffer(x, kind) for x, kind in zip(row, (np.uint64, np.int64, np.int64), strict=True)))


def piece_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    return spark.createDataFrame(vocabulary.scored, "piece string, score double, id int")


# The way in tasks

def spans(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts with a space before each that is not empty: bytes, text bounds, word starts and ends."""
    parts = [b" " + t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    bound = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    space, feed = data == _SPACE, data == 0x0A
    head = np.zeros(len(data) + 1, bool)
    head[bound] = True
    head[1:-1] |= (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
    head[-1] = True
    cut = np.flatnonzero(head)
    return data, bound, cut[:-1], cut[1:]


def word_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = (end - start).astype(np.uint64)
    return W.mix(W.running(W._BYTE[data], start, end) + size * np.uint64(0xD6E8FEB86659FD93))


def segment(data: np.ndarray, start: np.ndarray, end: np.ndarray,
            vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each word and their bounds, for words of about ``CHUNK_BYTES`` at a time."""
    part = np.cumsum(end - start) // CHUNK_BYTES
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(start)]))
    done = [_segment(data, start[a:b], end[a:b], vocabulary)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]
    ids = np.concatenate([np.zeros(0, np.int64), *(d[0] for d in done)])
    counts = np.concatenate([np.zeros(0, np.int64), *(d[1] for d in done)])
    return ids, np.concatenate(([0], np.cumsum(counts)))


def _segment(data: np.ndarray, start: np.ndarray, end: np.ndarray,
             vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The edges of all words are found together, then folded in the order of their start."""
    n, size = len(start), end - start
    first = np.concatenate(([0], np.cumsum(size + 1)))[:-1]  # place 0 of each word in ``best``
    word = np.repeat(np.arange(n), size)
    place = np.arange(len(word)) - np.concatenate(([0], np.cumsum(size)))[:-1][word]
    byte = data[start[word] + place]
    lead = np.flatnonzero((byte & 0xC0) != 0x80)
    width = np.diff(np.append(lead, len(word)))  # a word ends where a character ends
    word, place = word[lead], place[lead]
    at, stop = start[word] + place, end[word]
    bare = np.ones(len(word), bool)  # characters that are no piece
    edges = []
    row, node, depth = np.arange(len(word)), np.zeros(len(word), np.int64), 0
    while len(row) and len(vocabulary.keys):  # walk the trie from every character at once
        inside = at[row] + depth < stop[row]
        row, node = row[inside], node[inside]
        key = node * 256 + data[at[row] + depth]
        found = np.minimum(np.searchsorted(vocabulary.keys, key), len(vocabulary.keys) - 1)
        hit = vocabulary.keys[found] == key
        row, node = row[hit], vocabulary.nodes[found[hit]]
        depth += 1
        ends = vocabulary.ids[node] >= 0
        own = row[ends]
        bare[own[width[own] == depth]] = False
        edges.append((own, np.full(len(own), depth), vocabulary.scores[node[ends]], vocabulary.ids[node[ends]]))
    own = np.flatnonzero(bare)
    edges.append((own, width[own], np.full(len(own), vocabulary.unknown), np.full(len(own), -1)))
    row, length, score, ident = (np.concatenate(x) for x in zip(*edges, strict=True))
    order = np.argsort(place[row], kind="stable")
    row, length, score, ident = row[order], length[order], score[order], ident[order]
    here = first[word[row]] + place[row]
    to = here + length
    best = np.full(int((size + 1).sum()), -np.inf)
    best[first] = 0
    via = np.full(len(best), -1)
    cuts = np.flatnonzero(np.diff(place[row])) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(row)), strict=True):
        total, target = best[here[a:b]] + score[a:b], to[a:b]  # no two edges share start and end
        won = np.flatnonzero(total > best[target])
        best[target[won]] = total[won]
        via[target[won]] = a + won
    # back from the ends
    live, spot, taken = np.arange(n), first + size, []
    while len(live):
        edge = via[spot]
        taken.append((live, edge))
        spot = here[edge]
        more = spot > first[live]
        live, spot = live[more], spot[more]
    of = np.concatenate([t[0] for t in taken])
    edge = np.concatenate([t[1] for t in taken])
    edge = edge[::-1][np.argsort(of[::-1], kind="stable")]
    of = np.sort(of)
    # a character without a piece becomes its bytes
    count = np.where(ident[edge] < 0, length[edge], 1)
    ids = np.repeat(ident[edge], count)
    unknown = np.flatnonzero(ids < 0)
    begin = np.cumsum(count) - count
    which = np.repeat(np.arange(len(edge)), count)[unknown]
    ids[unknown] = vocabulary.byte_ids[data[at[row[edge[which]]] + unknown - begin[which]]]
    return ids, np.bincount(of, weights=count, minlength=n).astype(np.int64)


def gather(values: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The ranges of ``values``, one after the other."""
    ends = np.cumsum(count)
    return values[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - count), count)]


def encode_texts(texts: list[str | None], vocabulary: Vocabulary,
                 table: Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and the bounds of each."""
    data, bound, start, end = spans(texts)
    key = word_keys(data, start, end)
    order = np.argsort(key)
    ranked = key[order]
    head = np.ones(len(key), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(head) - 1
    at, own = order[head], ranked[head]
    count, begin = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
    pool = table.ids
    place = np.searchsorted(table.key, own)
    place[place == len(table.key)] = 0
    have = table.key[place] == own if len(table.key) else np.zeros(len(own), bool)
    begin[have] = table.bound[place[have]]
    count[have] = table.bound[place[have] + 1] - begin[have]
    left = np.flatnonzero(~have)
    ids, bounds = segment(data, start[at[left]], end[at[left]], vocabulary)
    begin[left] = len(pool) + bounds[:-1]
    count[left] = np.diff(bounds)
    pool = np.concatenate((pool, ids))
    out = gather(pool, begin[which], count[which])
    total = np.concatenate(([0], np.cumsum(count[which])))
    return out, total[np.searchsorted(start, bound)]


def decode_ids(ids: np.ndarray, bounds: np.ndarray, pieces: list[bytes]) -> list[str]:
    """The texts of the ids; the space that was put before each is taken off."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    raw = gather(data, (np.cumsum(sizes) - sizes)[ids], sizes[ids]).tobytes()
    ends = np.concatenate(([0], np.cumsum(sizes[ids])))[bounds].tolist()
    return [raw[a + 1 if raw[a:a + 1] == b" " else a:b].decode("utf-8", "surrogatepass")
            for a, b in zip(ends[:-1], ends[1:], strict=True)]


def encode(documents: DataFrame, vocabulary: Vocabulary, text_col: str = "text",
           ids_col: str = "token_ids", frequent: int = FREQUENT) -> DataFrame:
    """The documents with a column of piece ids."""
    context = documents.sparkSession.sparkContext
    shared = context.broadcast((vocabulary._replace(scored=[]),
                                packed_words(documents, vocabulary, text_col, frequent)))

    def run(texts: pa.Array) -> list[pa.Array]:
        ids, bounds = encode_texts(texts.to_pylist(), *shared.value)
        return [lists(ids, bounds, texts)]

    return add_columns(documents, text_col, {ids_col: T.ArrayType(T.IntegerType())}, run, SLICE_BYTES)


def lists(ids: np.ndarray, bounds: np.ndarray, like: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)), mask=nulls(like))


def decode(documents: DataFrame, vocabulary: Vocabulary, ids_col: str = "token_ids",
           text_col: str = "decoded") -> DataFrame:
    """The documents with the texts of their ids."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary.pieces)

    def run(column: pa.Array) -> list[pa.Array]:
        ids = column.flatten().to_numpy(zero_copy_only=False)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(shared.value)):
            raise ValueError("an id is not in the vocabulary")
        counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        texts = decode_ids(ids, np.concatenate(([0], np.cumsum(counts))), shared.value)
        return [pa.array([t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist(), strict=True)],
                         pa.string())]

    return add_columns(documents, ids_col, {text_col: T.StringType()}, run, SLICE_BYTES)


def encoded(documents: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, the ids of the whole text, their number, and whether they decode to the same text."""
    vocabulary = load(path)
    source = documents.select("doc_id", "text")
    context = documents.sparkSession.sparkContext
    shared = context.broadcast((vocabulary._replace(scored=[]), packed_words(source, vocabulary)))

    def run(texts: pa.Array) -> list[pa.Array]:
        values = texts.to_pylist()
        ids, bounds = encode_texts(values, *shared.value)
        back = decode_ids(ids, bounds, shared.value[0].pieces)
        same = [a == (b or "") for a, b in zip(back, values, strict=True)]
        return [lists(ids, bounds, texts), pa.array(np.diff(bounds)), pa.array(same)]

    new = {"token_ids": T.ArrayType(T.IntegerType()), "n_tokens": T.LongType(), "round_trip": T.BooleanType()}
    return add_columns(source, "text", new, run, SLICE_BYTES).drop("text")
