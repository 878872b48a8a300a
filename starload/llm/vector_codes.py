"""Vector code compression: product codes by exact integer nearest entries in Walsh-Hadamard space.

A vector is cut into equal parts; each part is coded as the index of its nearest codebook
entry. Parts and entries are zero-padded to a power of two, ``n``, and transformed by the integer
Walsh-Hadamard matrix, whose rows are orthogonal with squared length n: the squared distance of
two transforms is n times that of the originals. Squared differences are added up in sequency
order (few sign changes first); a partial sum is a lower bound, so an entry goes as soon as it
exceeds the full sum of the entry that looked best after the first coefficients. All of it
is integer arithmetic, hence the codes are exact and the same on every machine.

Each round of codebook fitting is one pass over the rows: a task adds up its rows' parts by
entry, and only ``parts * entries`` sums reach the driver, whatever the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.frames import cut
from starload.llm.intvec import extent, matrix

#: Coefficients added between two looks at the bounds, and rows compared at once.
STEP = 4
ROWS = 2048
CODES = "vec_id long, label long, codes array<int>, error long"


def walsh(rows: np.ndarray) -> np.ndarray:
    """The integer Walsh-Hadamard transform of the last axis (zero-padded to a power of two), by rising sequency."""
    width = rows.shape[-1]
    n = 1 << max(0, width - 1).bit_length()
    out = np.zeros((*rows.shape[:-1], n), dtype=np.int64)
    out[..., :width] = rows
    signs = np.ones((1, 1), dtype=np.int64)
    half = 1
    while half < n:
        pairs = out.reshape(*rows.shape[:-1], n // (2 * half), 2, half)
        out = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2)
        out = out.reshape(*rows.shape[:-1], n)
        signs = np.block([[signs, signs], [signs, -signs]])
        half *= 2
    return out[..., np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest entry (ties to the lower index) and scaled squared distance, all in transform space."""
    n = x.shape[1]
    dist = np.square(x[:, None, :STEP] - entries[None, :, :STEP]).sum(axis=2)
    limit = np.square(x - entries[dist.argmin(axis=1)]).sum(axis=1)
    row, entry = np.nonzero(dist <= limit[:, None])
    dist = dist[row, entry]
    for s in range(STEP, n, STEP):
        dist = dist + np.square(x[row, s: s + STEP] - entries[entry, s: s + STEP]).sum(axis=1)
        alive = dist <= limit[row]  # an equal sum may belong to a lower index
        row, entry, dist = row[alive], entry[alive], dist[alive]
    starts = np.searchsorted(row, np.arange(x.shape[0]))  # the row's first guess is always left
    least = np.minimum.reduceat(dist, starts)
    best = np.flatnonzero(dist == least[row])
    first = best[np.searchsorted(row[best], np.arange(x.shape[0]))]
    return entry[first], least


@dataclass
class Codebooks:
    """``books[part, entry, position]``, int64."""

    books: np.ndarray

    @property
    def width(self) -> int:
        """Components of a vector, its padding included."""
        return self.books.shape[0] * self.books.shape[2]

    def sha256(self) -> str:
        """Digest of all components in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows x parts) and squared distances (rows x parts) of whole vectors."""
        parts, _, width = self.books.shape
        cells = rows.reshape(rows.shape[0], parts, width)
        codes = np.zeros((rows.shape[0], parts), dtype=np.int64)
        dist = np.zeros((rows.shape[0], parts), dtype=np.int64)
        for p in range(parts):
            entries = walsh(self.books[p])
            for i in range(0, rows.shape[0], ROWS):
                x = walsh(cells[i: i + ROWS, p])
                codes[i: i + ROWS, p], scaled = nearest(x, entries)
                dist[i: i + ROWS, p] = scaled // x.shape[1]
        return codes, dist

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for."""
        return np.concatenate([self.books[p][codes[:, p]] for p in range(self.books.shape[0])], axis=1)


def _sums(books: Codebooks):
    """A task's number of rows and component sums of every entry in use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.books.shape
        count = np.zeros((parts, entries), dtype=np.int64)
        total = np.zeros((parts, entries, width), dtype=np.int64)
        for batch in batches:
            rows = matrix(batch.column(0), books.width)
            if not rows.shape[0]:
                continue
            codes, _ = books.assign(rows)
            cells = rows.reshape(rows.shape[0], parts, width)
            for p in range(parts):
                count[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(total[p], codes[:, p], cells[:, p])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(count[part, entry]),
             pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

    return run


def _encode(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, dist = books.assign(matrix(batch.column(2), books.width))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes.tolist(), pa.list_(pa.int32())),
                 pa.array(dist.sum(axis=1))], ["vec_id", "label", "codes", "error"])

    return run


def fit(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> Codebooks | None:
    """Codebooks of ``vec_id, vec`` (integer vectors), None for no rows.

    They start from the rows with the ``entries`` smallest ids (of one id, smaller vectors first; null
    ids last), fewer if there are fewer rows. Each round replaces an entry by the floored mean of
    the parts assigned to it; an entry without parts stays. Shorter vectors count as filled with
    zeros up to the longest one, rounded up to whole parts. Vectors whose distances could
    pass 2**63 raise.
    """
    largest, longest = extent(vectors)
    width = max(1, -(-longest // parts))
    n = 1 << (width - 1).bit_length()
    if n * width * (2 * largest) ** 2 >= 2 ** 63:
        raise ValueError(f"components up to {largest} are too large for exact distances")
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    if not first:
        return None
    start = matrix(pa.array([r.vec for r in first], pa.list_(pa.int64())), parts * width)
    books = Codebooks(start.reshape(len(first), parts, width).transpose(1, 0, 2).copy())
    schema = "part long, entry long, n long, total array<long>"
    for _ in range(rounds):
        sums = (vectors.select("vec").mapInArrow(_sums(books), schema).groupBy("part", "entry")
                .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total")))
        moved = books.books.copy()
        for r in sums.collect():  # parts * entries rows at most
            moved[r.part, r.entry] = [t // r.n for t in r.total]
        books = Codebooks(moved)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, codes, error``: each vector's codes by part and summed squared distance."""
    return vectors.select("vec_id", "label", "vec").mapInArrow(_encode(books), CODES)


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, Codebooks | None]:
    """Fit codebooks on all rows of ``vec_id, label, vec`` and encode them: (codes, codebooks)."""
    kept = cut(vectors)
    books = fit(kept, parts, entries, rounds)
    if books is None:
        return kept.sparkSession.createDataFrame([], CODES), None
    return encode(kept, books), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """Add ``label_error``: the error summed over equal labels, nulls together."""
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")
