"""Sets of word shingles as sorted 64-bit hashes, worked out for many texts at once with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 21
#: For sets, whose work takes some 50 bytes of memory for each byte of a chunk.
SET_CHUNK = 1 << 18
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A one-to-one map of 64-bit numbers that spreads each bit over all."""
    x = x + np.uint64(int(salt) * 0xD1342543DE82EF95 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64), 99)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _P_INVERSE)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of UTF-8 bytes; A-Z count as a-z, words end at space, tab, \\n, \\v, \\f and \\r."""
    data = np.where((data >= 65) & (data <= 90), data | 32, data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power_tables(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)], dtype=np.uint64)))
    return starts, ends, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def chunks(texts: list[bytes], most: int = CHUNK) -> Iterator[list[bytes]]:
    chunk, size = [], 0
    for text in texts:
        if chunk and size + len(text) > most:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text) + 1
    if chunk:
        yield chunk


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct runs of width words; with fewer words, of the whole sequence."""
    for chunk in chunks(texts, SET_CHUNK):
        begins = np.cumsum([0] + [len(t) + 1 for t in chunk])
        starts, _, words = word_hashes(np.frombuffer(b"\n".join(chunk), np.uint8))
        first = np.searchsorted(starts, begins)
        runs = mix(words, width)
        for k in range(1, width):
            runs[: len(words) - k] = mix(runs[: len(words) - k] ^ words[k:], width + k)
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= width:
                yield np.unique(runs[a : b - width + 1])
            elif b > a:
                whole = mix(words[a : a + 1], 1000 + b - a)
                for w in words[a + 1 : b]:
                    whole = mix(whole ^ w, 2000)
                yield whole
            else:
                yield np.empty(0, np.uint64)
