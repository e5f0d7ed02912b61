"""Word shingles of whole texts as 64-bit hashes, for an Arrow batch at a time.

Words are runs of bytes other than ASCII white space, A-Z lower-cased. A word's hash comes from prefix
sums of byte values times powers of an odd number, so no loop runs over words; a shingle's hash mixes
those of its words in order. A text with fewer words than a shingle has is one shingle as a whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(20240501)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(max(n, 1 << 20), base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where all words begin and end; no word crosses a bound."""
    n = len(data)
    space = _SPACE[data]
    first = np.zeros(n + 1, bool)
    first[bounds[:-1]] = True
    first[1:n] |= space[: n - 1] if n else False
    starts = np.flatnonzero(first[:n] & ~space)
    last = np.zeros(n + 1, bool)
    last[bounds[1:]] = True
    last[:n] |= space
    return starts, np.flatnonzero(last[1:] & ~space) + 1


def span_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans of data, A-Z lower-cased."""
    n = len(data)
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[:n], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words begin (and end) among them."""
    starts, ends = word_spans(data, bounds)
    return span_keys(data, starts, ends), np.searchsorted(starts, bounds)


def _column(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.binary())
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[bounds[0] : bounds[-1]] if held is not None and held.size else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, at = word_hashes(*_column(texts))
    grams = np.zeros(max(len(words) - k + 1, 0), np.uint64)
    for j in range(k):
        grams = mixed(grams + words[j : len(grams) + j] * np.uint64(2 * j + 3))
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if hi - lo >= k:
            out.append(np.unique(grams[lo : hi - k + 1]))
        elif hi > lo:
            whole = np.full(1, hi - lo, np.uint64)
            for w in words[lo:hi]:
                whole = mixed(whole * np.uint64(5) + w)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
