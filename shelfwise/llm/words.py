"""Words of many texts at once, as arrays: where each begins and ends, and a 64-bit key of its bytes.

Helpers for tasks: Spark hands them Arrow batches; they work through slices of bounded size.
A single text is never cut, so the longest text bounds the memory of a slice from below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd

SLICE_BYTES = 4_000_000
LONG_WORD = 256  # longer words get a cryptographic key: sums of powers can be made to collide

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_SEED = np.random.default_rng(7)
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACES
#: Digits, letters and everything beyond ASCII.
WORDLIKE = np.zeros(256, bool)
WORDLIKE[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = True
WORDLIKE[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Words(NamedTuple):
    data: np.ndarray  # bytes of all texts, parted by line feeds
    bound: np.ndarray  # first byte of each text, and the end
    first: np.ndarray  # first word of each text, and the end
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES // 2)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(have)
    return have


def running(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each range the sum of value times power of its place in the range, modulo 2**64."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _power(_BASE, n + 1)[:n], out=total[1:])
    return (total[end] - total[start]) * _power(_INVERSE, n + 1)[start]


def tokenize(texts: Iterable[str | None], word: np.ndarray = NOT_SPACE, lower: bool = False,
             keys: bool = True) -> Words:
    """Words are longest runs of the bytes marked in ``word``; a line feed must not be one."""
    parts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
    data = np.frombuffer(b"\n".join([b"", *parts, b""]), np.uint8)
    if lower:
        data = LOWER[data]
    sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
    bound = np.concatenate(([1], 1 + np.cumsum(sizes)))
    inside = word[data]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = change[::2], change[1::2]
    first = np.searchsorted(start, bound)
    if not keys:
        return Words(data, bound, first, start, end, np.zeros(0, np.uint64))
    size = (end - start).astype(np.uint64)
    key = mix(running(_BYTE[data], start, end) + size * np.uint64(0xD6E8FEB86659FD93))
    for i in np.flatnonzero(size >= LONG_WORD):
        raw = hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest()
        key[i] = int.from_bytes(raw, "little")
    return Words(data, bound, first, start, end, key)


def windows(key: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """A 64-bit key for each run of ``size`` keys; different salts give independent keys."""
    n = len(key) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    values = mix(key + np.uint64(salt)) if salt else key
    start = np.arange(n)
    return mix(running(values, start, start + size) + np.uint64(size))


def owner(first: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def whole_windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that lie within one text, and their texts."""
    count = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    begin = np.concatenate(([0], np.cumsum(count)))[:-1]
    return np.arange(len(text)) - begin[text] + first[:-1][text], text


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text, zero for a text without any."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def slices(frame: pd.DataFrame, column: str = "text",
           size: int = SLICE_BYTES) -> Iterator[pd.DataFrame]:
    """Parts of a batch with about ``size`` characters each, one row at least."""
    lengths = frame[column].map(lambda t: len(t) if isinstance(t, str) else 0).to_numpy(np.int64)
    part = np.cumsum(lengths) // size
    cut = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(frame)]))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if b > a:
            yield frame.iloc[a:b]
