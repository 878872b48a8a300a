"""Exact top-k search by block-at-a-time pruning over integer vectors.

Vectors are dealt into chunks of consecutive places of a locality order. Inside a chunk, rows are
cut into blocks of ``BLOCK`` and each block keeps the largest and smallest value of every
dimension. A query's bound for a block is the sum of its values times those extremes (the summed
term maxima; a negative value takes the minimum). Blocks are scored through their forward
index in descending order of bounds until the next bound falls below the k-th best score.

Each chunk's maxima and minima bound it in the same way. A query visits chunks in descending order of their bounds, in
rounds of a few chunks each: the k-th score of one round goes with it to the next, and it is sent to no
chunk whose bound is below it. Queries visit chunks as a stream (sorted
behind the chunk's rows), so a task holds one chunk and one batch of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.frames import cut, shuffle_width

#: Rows of a block, and of a chunk at most (on average).
BLOCK = 64
CHUNK = 65_536
#: Queries scored together.
QUERIES = 256
#: Blocks visited between two looks at the k-th score.
STEP = 4
#: Chunks, by descending bound, that a query has visited after each round but the last, which visits all that are left.
ROUNDS = (2, 10)
OUT = "query_id long, vec_id long, score long"


class Chunk:
    """Block maxima, block minima and forward indexes of one chunk."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.lexsort((ids, *(rows[:, d] for d in range(min(8, rows.shape[1]) - 1, -1, -1) if rows.shape[1])))
        self.ids, self.rows = ids[order], rows[order]
        self.edges = list(range(0, ids.size, BLOCK)) + [ids.size]
        self.high = np.stack([self.rows[i:j].max(axis=0) for i, j in zip(self.edges, self.edges[1:])])
        self.low = np.stack([self.rows[i:j].min(axis=0) for i, j in zip(self.edges, self.edges[1:])])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int):
        """The up to ``k`` best rows of each query with a score of at least ``least``: (query ids, row ids, scores)."""
        n = query_ids.size
        bounds = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        order = np.argsort(-bounds, axis=1, kind="stable")
        score = np.full((n, k), -np.inf)
        ids = np.full((n, k), np.iinfo(np.int64).max)
        floor = least.copy()
        active = np.arange(n)
        for step in range(0, bounds.shape[1], STEP):
            ahead = bounds[active, order[active, step]]
            active = active[ahead >= floor[active]]  # a bound equal to the k-th score may hide a smaller id
            if not active.size:
                break
            visit = order[active, step: step + STEP]
            wanted = bounds[active[:, None], visit] >= floor[active][:, None]
            for block in np.unique(visit[wanted]):
                who = active[((visit == block) & wanted).any(axis=1)]
                i, j = self.edges[block], self.edges[block + 1]
                got = queries[who] @ self.rows[i:j].T
                got[self.ids[i:j][None, :] == query_ids[who][:, None]] = -np.inf
                hit = got.max(axis=1) >= floor[who]
                if hit.any():
                    who, got = who[hit], got[hit]
                    both = np.concatenate([score[who], got], axis=1)
                    names = np.concatenate([ids[who], np.broadcast_to(self.ids[i:j], got.shape)], axis=1)
                    best = np.lexsort((names, -both), axis=1)[:, :k]
                    score[who] = np.take_along_axis(both, best, axis=1)
                    ids[who] = np.take_along_axis(names, best, axis=1)
                    floor[who] = np.maximum(floor[who], score[who, k - 1])
        row, place = np.nonzero(score >= np.maximum(least, np.finfo(float).min)[:, None])
        return query_ids[row], ids[row, place], score[row, place]


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix of doubles (integers below 2**53 are exact)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Largest and smallest value of every dimension of a task's rows, by chunk and length."""
    held: dict[tuple[int, int], list[np.ndarray]] = {}
    for batch in batches:
        chunk, dims = batch.column(0).to_numpy(), batch.column(3).to_numpy()
        for c, d in set(zip(chunk.tolist(), dims.tolist())):
            rows = _matrix(batch.column(2).filter(pa.array((chunk == c) & (dims == d))))
            high, low = rows.max(axis=0), rows.min(axis=0)
            if (c, d) in held:
                high, low = np.maximum(high, held[c, d][0]), np.minimum(low, held[c, d][1])
            held[c, d] = [high, low]
    yield pa.RecordBatch.from_arrays(
        [pa.array([c for c, _ in held], pa.int32()), pa.array([d for _, d in held], pa.int32()),
         *(pa.array([v[i].tolist() for v in held.values()], pa.list_(pa.float64())) for i in (0, 1))], ["chunk", "dims", "high", "low"])


def _ahead(chunk_of: dict, start: int, end: int | None):
    """Each query with the chunks of places ``start .. end`` in its order of bounds that can still offer ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for d in np.unique(dims):
                if d not in chunk_of:
                    continue
                here = batch.filter(pa.array(dims == d))
                names, high, low = chunk_of[d]
                for i in range(0, here.num_rows, QUERIES):
                    rows = here.slice(i, QUERIES)
                    q = _matrix(rows.column(2))
                    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
                    order = np.argsort(-bounds, axis=1, kind="stable")[:, start:end]
                    least = rows.column(3).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                    row, place = np.nonzero(np.take_along_axis(bounds, order, axis=1) >= least[:, None])
                    sent = rows.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([pa.array(names[order[row, place]].astype(np.int32)), *sent.columns],
                                                     ["chunk", *sent.schema.names])

    return run


def _visit(k: int):
    """Rows sorted by chunk, the chunk's vectors (side 0) before its queries (side 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        chunk = None
        for batch in batches:
            place = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if place.size else []
            for i, j in zip(edges, np.append(edges[1:], place.size).astype(int)):
                if place[i] != at:
                    at, parts, chunk = place[i], [], None
                run_ = batch.slice(i, j - i)
                side = run_.column(1).to_numpy()
                ids, rows = run_.column(2).to_numpy(), _matrix(run_.column(3))
                rows_here = side == 0
                if rows_here.any():
                    parts.append((ids[rows_here], rows[rows_here]))
                if not rows_here.all() and parts:
                    if chunk is None:
                        chunk = Chunk(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                    least = run_.column(4).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                    asks = np.flatnonzero(~rows_here)
                    for a in range(0, asks.size, QUERIES):
                        s = asks[a: a + QUERIES]
                        q, v, w = chunk.search(ids[s], rows[s], least[s], k)
                        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(w.astype(np.int64))],
                                                         ["query_id", "vec_id", "score"])

    return run


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def integer_vectors(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 64) -> DataFrame:
    """``vec_id, vec``: ``floor(scale * x)`` of every component as double.

    Left out: null ids, null or empty vectors and vectors with null or non-finite components. Of
    rows with one id the greatest vector counts. A scaled component of 2**53 or more raises.
    """
    rows = table.select(table[vec_id].cast("long").alias("vec_id"), table[embedding].cast("array<double>").alias("raw"))
    sound = (F.col("vec_id").isNotNull() & (F.size("raw") > 0)
             & F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    far = F.raise_error(F.lit(f"a component times {scale} is beyond 2**53")).cast("double")
    scaled = F.transform("raw", lambda x: F.when(F.abs(x * F.lit(float(scale))) < float(2 ** 53), F.floor(x * F.lit(float(scale))).cast("double")).otherwise(far))
    return rows.where(sound).select("vec_id", scaled.alias("vec")).groupBy("vec_id").agg(F.max("vec").alias("vec"))


def topk(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` largest inner products, ties to the smaller id.

    Both inputs hold ``vec_id, vec`` (arrays of integral doubles); vectors whose products could
    pass 2**53 raise, as they would not be exact. A query is not its own candidate. Only vectors of a query's length are
    candidates. Fewer candidates give fewer rows; empty inputs give none.
    """
    spark = vectors.sparkSession
    both = vectors.select("vec").unionByName(queries.select("vec"))
    rows, largest, longest = vectors.count(), *both.agg(F.max(F.array_max(F.transform("vec", F.abs))), F.max(F.size("vec"))).first()
    if rows and int(largest) ** 2 * longest >= 2 ** 53:
        raise ValueError(f"components up to {int(largest)} are too large for exact scores")
    chunks = max(1, min(rows, max(shuffle_width(spark), -(-rows // CHUNK))))
    # places of about equal size: leading values first, so that neighbours share a chunk; ids split equal vectors
    order = [F.size("vec"), *[F.try_element_at("vec", F.lit(d + 1)) for d in range(8)], F.col("vec_id")]
    placed = cut(vectors.repartitionByRange(chunks, *order)
                 .select(F.spark_partition_id().alias("chunk"), "vec_id", "vec", F.size("vec").alias("dims")))
    sides = placed.mapInArrow(_sides, "chunk int, dims int, high array<double>, low array<double>").collect()
    table = {}
    for r in sides:  # a row for each chunk and length
        table.setdefault(r.dims, []).append((r.chunk, r.high, r.low))
    chunk_of = {d: (np.array([x[0] for x in rows_]), np.array([x[1] for x in rows_]), np.array([x[2] for x in rows_]))
                for d, rows_ in table.items()}
    asked = queries.select("vec_id", "vec", F.size("vec").alias("dims"))
    none = F.lit(None).cast("double")
    key = ["chunk", "dims"]

    def search(asks: DataFrame) -> DataFrame:
        both = (placed.select(*key, F.lit(0).alias("side"), "vec_id", "vec", none.alias("least"))
                .unionByName(asks.select(*key, F.lit(1).alias("side"), "vec_id", "vec", "least")))
        return (both.repartition(chunks, *key).sortWithinPartitions(*key, "side", "vec_id")
                .select((F.col("chunk") * F.lit(1 << 20) + F.col("dims")).alias("place"), "side", "vec_id", "vec", "least")
                .mapInArrow(_visit(k), OUT))

    best = None
    for start, end in zip((0, *ROUNDS), (*ROUNDS, None)):
        if best is None:
            asks = asked.withColumn("least", none)
        else:  # with k rows found, no other chunk needs to offer less than the k-th
            kth = best.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).cast("double").alias("least"))
            asks = asked.join(kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
        sent = (asks.select("dims", "vec_id", "vec", "least")
                .mapInArrow(_ahead(chunk_of, start, end), "chunk int, dims int, vec_id long, vec array<double>, least double"))
        found = search(sent)
        if best is not None:
            found = best.select("query_id", "vec_id", "score").unionByName(found)
        best = _best(found, k)
        if end is None or all(len(x[0]) <= end for x in chunk_of.values()):
            break
        best = cut(best)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
