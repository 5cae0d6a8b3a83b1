"""Words of Arrow texts and their 64-bit hashes, by numpy over the byte buffer.

A word is ``[^\\x20\\x09-\\x0D]+``; all separators are single bytes that occur
in no longer UTF-8 sequence, so the bytes can be cut without decoding.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_LETTER = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)  # a random value for each byte


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, mod 2^64; kept for the next slice."""
    if len(_POWERS[0]) < n:
        for k, b in enumerate((_BASE, _INVERSE)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    data: np.ndarray    # bytes of all texts, one after the other
    begin: np.ndarray   # of each word, in data
    end: np.ndarray
    first: np.ndarray   # index of the first word of each text, and their number as the last item
    hash: np.ndarray

    def text(self, a: int, b: int) -> bytes:
        """Words a..b joined by one blank."""
        return b" ".join([self.data[s:e].tobytes() for s, e in zip(self.begin[a:b], self.end[a:b], strict=True)])


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of a string or binary array; nulls have none."""
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.binary())
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[ends[0]:ends[-1]] if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    if lower:
        data = _LOWER[data]
    inside = ~_SEPARATOR[data]
    # a word begins where a text begins or a separator ends
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    begin = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])))
    end = np.flatnonzero(inside & (edge[1:] | np.concatenate([~inside[1:], [True]]))) + 1
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * power[:len(data)], out=total[1:])
    size = (end - begin).astype(np.uint64)
    return Words(data, begin, end, np.searchsorted(begin, ends), mix((total[end] - total[begin]) * inverse[begin] + size))


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive word hashes."""
    out = h[:len(h) - k + 1].copy()
    for j in range(1, k):
        out = mix(out * np.uint64(0xD1342543DE82EF95) + h[j:len(h) - k + 1 + j])
    return out


def prefix_hash(h: np.ndarray) -> np.ndarray:
    """Prefix sums from which span_hash reads the hash of any run of words."""
    out = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _powers(len(h) + 1)[0][:len(h)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words begin..end, equal for equal runs wherever they stand."""
    return mix((prefix[end] - prefix[begin]) * _powers(len(prefix))[1][begin] + (end - begin).astype(np.uint64))


def joined(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with one blank after each: bytes, begins and ends of words."""
    size = w.end - w.begin
    ends = np.cumsum(size + 1) - 1
    out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
    letters = np.ones(len(out), bool)
    letters[ends] = False
    out[letters] = w.data[~_SEPARATOR[w.data]]
    return out, ends - size, ends
