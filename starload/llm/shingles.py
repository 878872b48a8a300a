"""Word shingles of whole texts as sorted arrays of 64-bit hashes, and their signatures."""

from __future__ import annotations

from bisect import bisect_right
from math import ceil, exp, sqrt

import numpy as np

from starload.llm.textbytes import BLANK, LOWER, U64, hash_spans, mix, spans

ORDER = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x27D4EB2F165667C5),
         U64(0x85EBCA77C2B2AE63), U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53), U64(0x94D049BB133111EB))


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int) -> list[np.ndarray]:
    """Each row's distinct shingles of ``width`` words (lower-cased A-Z), sorted; all words as one if there are fewer."""
    data = LOWER[data]
    starts, ends, first = spans(data, offs, BLANK)
    words = hash_spans(data, starts, ends)
    rolled = np.zeros(words.size, dtype=U64)
    for k in range(width):
        part = mix(words + ORDER[k])
        rolled[: words.size - k] += part[k:] * ORDER[(k + 1) % width]
    rolled = mix(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(rolled[a: b - width + 1]))
        elif b > a:  # fewer words than a shingle has: the sequence as one, apart from any longer shingle
            code = U64(b - a)
            for w in words[a:b]:
                code = mix(np.array([code], dtype=U64) * ORDER[0] + w)[0]
            out.append(np.array([code], dtype=U64))
        else:
            out.append(np.zeros(0, dtype=U64))
    return out


def set_hash(shingles: np.ndarray) -> int:
    """A 64-bit hash of a set as a signed integer."""
    total = mix(shingles).sum(dtype=U64) if shingles.size else U64(0)
    return int(mix(np.array([total], dtype=U64) + np.array([shingles.size], dtype=U64) * ORDER[1]).view(np.int64)[0])


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if a.size > b.size:
        a, b = b, a
    if not a.size:
        return 0
    at = np.searchsorted(b, a)
    at[at == b.size] = b.size - 1
    return int((b[at] == a).sum())


class Bands:
    """Size bands and the signatures that any two linked sets of neighbouring sizes must share.

    Sets ``r``, ``s`` (``|r| <= |s|``) with Jaccard similarity of at least ``t`` percent differ in at
    most ``D = (100 - t) * |r| / t`` elements. The hash range is cut into ``D + 1 + spare`` classes; at least
    ``1 + spare`` of them hold the same elements in both sets. So linked sets share the hash of
    a class that is not empty, unless one of them has over ``spare`` empty classes; such sets
    also sign their empty classes. ``spare`` is three standard deviations above the mean number of
    empty classes of the band's smallest sets, so few sets do (their empty classes would else
    bring most sets of a band together). ``D`` is that of the largest
    size of the smaller set's band, and a set signs for each band its partner may be of.
    """

    def __init__(self, percent: int, ratio: float = 1.2):
        self.percent = percent
        self._classes: dict[int, tuple[int, int]] = {}
        self.lows = [1]
        while self.lows[-1] < 2 ** 40:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * ratio)))

    def band(self, size: int) -> int:
        return bisect_right(self.lows, size) - 1

    def classes(self, band: int) -> tuple[int, int]:
        """Number of classes of a band and the empty ones a set may leave out."""
        if band not in self._classes:
            low = self.lows[band]
            most = (100 - self.percent) * (self.lows[band + 1] - 1) // self.percent
            spare, need = 0, int(most > 0)
            while spare < need:
                spare = need
                load = low / (most + 1 + spare)
                empty = (most + 1 + spare) * exp(-load)
                need = ceil(empty + 3 * sqrt(empty * (1 - (1 + load) * exp(-load))))
            self._classes[band] = most + 1 + spare, spare
        return self._classes[band]

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        """All signatures of a sorted set."""
        n = shingles.size
        if not n:
            return np.zeros(0, dtype=U64)
        total = np.zeros(n + 1, dtype=U64)
        np.cumsum(mix(shingles ^ ORDER[2]), out=total[1:])
        out = []
        for band in range(self.band(-(-self.percent * n // 100)), self.band(n) + 1):
            m, spare = self.classes(band)
            step = 2 ** 64 // m + 1
            edges = np.searchsorted(shingles, np.arange(1, m, dtype=U64) * U64(step)) if m > 1 else np.zeros(0, np.int64)
            edges = np.concatenate([[0], edges, [n]])
            sums = total[edges[1:]] - total[edges[:-1]]
            filled = np.diff(edges) > 0
            if m - int(filled.sum()) > spare:
                filled[:] = True
            kind = np.flatnonzero(filled).astype(U64)
            out.append(mix(sums[filled] + mix(kind * ORDER[3] + ORDER[4] ^ U64(band + 1))))
        return np.concatenate(out)


def bitmap(shingles: np.ndarray, words: int) -> np.ndarray:
    """Each element flips one of ``64 * words`` bits; two bitmaps differ in at most as many bits as the sets in elements."""
    at = (shingles >> U64(7)) % U64(64 * words)
    odd = np.bincount(at.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(U64)


def bitmap_words(size: int) -> int:
    """64-bit words of a set's bitmap: two bits an element or more, as a power of two, so that neighbours in size can be folded alike."""
    return 1 << max(0, (2 * size // 64)).bit_length()
