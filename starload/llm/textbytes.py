"""Whole Arrow columns of texts as byte arrays: word spans and 64-bit word hashes without a Python loop per word.

UTF-8 keeps ASCII bytes out of longer characters, so separators and A-Z lower-casing
work on bytes. Hashes are polynomial sums of random byte values modulo 2**64 with an
avalanche step; equal words always have equal hashes, and unequal ones collide with a
chance of about 2**-60 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_rng = np.random.default_rng(20240607)
BYTE_VALUE = _rng.integers(1, 2 ** 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15 & ~7 | 5
INVERSE = pow(BASE, -1, 2 ** 64)

#: Separator bytes of the word pattern ``[^\x20\x09-\x0D]+``.
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 9, 10, 11, 12, 13]] = True
#: Everything but ASCII letters, digits and bytes of longer characters.
NOT_ALNUM = np.array([not (b >= 128 or chr(b).isalnum()) for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)

_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers.get("n", np.zeros(0)).size < n:
        size = max(n, 1 << 20)
        for key, base in (("n", BASE), ("i", INVERSE)):
            factors = np.full(size, base, dtype=U64)
            factors[0] = 1
            _powers[key] = np.multiply.accumulate(factors)
    return _powers["n"], _powers["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit changes about half of the output bits."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def slices(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows ``[i, j)`` of about ``limit`` bytes: (i, j, bytes, row offsets). Rows stay whole."""
    n = len(texts)
    if not n:
        return
    bufs = texts.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64)[texts.offset: texts.offset + n + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, j, data[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
        i = j


def spans(data: np.ndarray, offs: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and each row's first word (with the total at the end)."""
    n = data.size
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(offs.size, np.int64)
    word = ~gap[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    if not starts.size:
        return np.zeros(0, U64)
    power, inverse = _power_table(data.size)
    total = np.zeros(data.size + 1, dtype=U64)
    np.cumsum(BYTE_VALUE[data] * power[: data.size], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U64))
