"""Keys of many documents, compared in packed blocks.

Documents are dealt to chunks by a hash of their id, or of their text where the id is null. A chunk's task sorts its distinct keys and
cuts them by their first bits into blocks, one row per chunk and part. All blocks of a part meet
in one task, which answers with one bit per key; the answers go back to the chunks. A key crosses the
network once per chunk however many documents hold it, so common keys do not gather rows.

The number of chunks and parts follows the size of the texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

CHUNK_CHARS = 6_000_000
PART_CHARS = 12_000_000
LAST = 2**63 - 1
_BITS = "chunk int, part int, kind int, bits binary"


def layout(documents: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Number of chunks, and of parts as a power of two, for the size of the texts."""
    size = documents.agg(F.sum(F.length(text_col))).first()[0] or 0
    return max(1, -(-size // CHUNK_CHARS)), 1 << max(0, (max(1, size // PART_CHARS) - 1).bit_length())


def chunked(documents: DataFrame, chunks: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """chunk, rank and text; a null id ranks behind all others, and its rows are dealt by their texts.

    Rows that repeat an id and a text may lie in one chunk; different texts do not, however many share an id that is null.
    """
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    deal = F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(rank)
    return documents.select(F.pmod(F.xxhash64(deal), F.lit(chunks)).cast("int").alias("chunk"),
                            rank.alias("rank"), F.col(text_col).alias("text"))


def cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of the parts among sorted keys."""
    if parts == 1:
        return np.array([0, len(keys)])
    shift = np.uint64(64 - (parts.bit_length() - 1))
    return np.searchsorted(keys >> shift, np.arange(parts + 1, dtype=np.uint64))


def pack(chunk: int, parts: int, keys: np.ndarray, **columns: np.ndarray) -> pd.DataFrame:
    """One row per part that has keys."""
    bound = cuts(keys, parts)
    full = np.flatnonzero(np.diff(bound))
    out = {"part": full.astype(np.int32), "chunk": np.full(len(full), chunk, np.int32),
           "keys": [keys[bound[p]:bound[p + 1]].tobytes() for p in full]}
    for name, values in columns.items():
        out[name] = [values[bound[p]:bound[p + 1]].tobytes() for p in full]
    return pd.DataFrame(out)


def unpack(blocks: pd.DataFrame, column: str, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(blocks[column]), dtype)


def answer(blocks: pd.DataFrame, flags: np.ndarray, kind: int) -> pd.DataFrame:
    """The bits of each block that has any, in the order of its keys."""
    sizes = blocks["keys"].map(len).to_numpy(np.int64) // 8
    ends = np.cumsum(sizes)
    parts = [flags[a:b] for a, b in zip(ends - sizes, ends, strict=True)]
    some = [i for i, p in enumerate(parts) if p.any()]
    return pd.DataFrame({"chunk": blocks["chunk"].to_numpy()[some], "part": blocks["part"].to_numpy()[some],
                         "kind": np.full(len(some), kind, np.int32),
                         "bits": [np.packbits(parts[i]).tobytes() for i in some]})


def flags_of(bits: pd.DataFrame, kind: int, keys: np.ndarray, parts: int) -> np.ndarray:
    """The answers for a chunk's sorted keys; keys of a part without an answer have none set."""
    out = np.zeros(len(keys), bool)
    bound = cuts(keys, parts)
    own = bits[bits["kind"] == kind]
    for part, raw in zip(own["part"], own["bits"], strict=True):
        a, b = bound[part], bound[part + 1]
        out[a:b] = np.unpackbits(np.frombuffer(raw, np.uint8), count=b - a).astype(bool)
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct keys, and the place of each key among them."""
    order = np.argsort(keys)
    ranked = keys[order]
    head = np.ones(len(keys), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(head) - 1
    return ranked[head], which
