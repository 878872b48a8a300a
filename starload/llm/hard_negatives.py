"""Hard-negative mining with exact scores by the method of the Four Russians.

Candidates are stored as bit planes: plane b of a vector holds bit b of every component (two's
complement), eight dimensions a byte. An anchor gets, for every group of eight dimensions, the
table of all 256 subset sums of its components; a candidate's byte is the index of the subset
that its plane selects. A plane's lookups are summed over the groups, and planes are put together
from the top by shift and add (the sign plane counts negative): the result is the full inner
product, in integers.

Candidates lie in chunks of an order by label, so an anchor meets its own label in a few chunks
(its positives) and skips chunks of its label alone when negatives are sought. Anchors travel as
blocks of about ``ANCHORS``: a chunk gets a row for each block, not for each anchor, and a task
holds one chunk of packed bytes and the tables of one block. A chunk returns only an
anchor's best rows, and the few of all chunks are merged.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.frames import cut, shuffle_width
from starload.llm.intvec import extent, matrix

#: Rows of a chunk at most (on average), anchors of a block, candidates and anchors scored at once.
CHUNK = 1 << 20
ANCHORS = 256
TILE = 8192
COLUMNS = 64

PACKED = "chunk int, dims int, vec_id long, label long, bits binary"
FOUND = "anchor long, anchor_id long, place int, positive_id long, positive_score long, vec_id long, score long"


def pack_bits(rows: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of integer rows, top plane first: (rows, planes, groups of eight dimensions)."""
    wide = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((rows.shape[0], wide), dtype=np.int64)
    padded[:, : rows.shape[1]] = rows
    return np.stack([np.packbits((padded >> b & 1).astype(np.uint8), axis=1, bitorder="little")
                     for b in range(planes - 1, -1, -1)], axis=1)


def unpack_bits(bits: np.ndarray) -> np.ndarray:
    """The integer rows that bit planes stand for (with the padding's zeros)."""
    planes = np.unpackbits(bits, axis=2, bitorder="little").astype(np.int64)
    out = -planes[:, 0]
    for p in range(1, planes.shape[1]):
        out = 2 * out + planes[:, p]
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Table ``[group, byte, anchor]``: the sum of the anchor's components that the byte's bits select."""
    groups = anchors.shape[1] // 8
    table = np.zeros((groups, 256, anchors.shape[0]), dtype=np.int64)
    for i in range(8):
        table[:, 1 << i: 2 << i] = table[:, : 1 << i] + anchors[:, i::8].T[:, None, :]
    return table


def scores(table: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Inner products ``[candidate, anchor]`` by lookups, shifts and additions."""
    out = None
    got = np.empty((bits.shape[0], table.shape[2]), dtype=table.dtype)
    for p in range(bits.shape[1]):
        plane = np.zeros_like(got)
        for g in range(bits.shape[2]):
            np.take(table[g], bits[:, p, g], axis=0, out=got)
            plane += got
        out = -plane if out is None else (out << 1) + plane
    return out


def _bits(column: pa.Array, planes: int) -> np.ndarray:
    """A column of packed vectors of one length."""
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8)
    return raw.reshape(len(column), planes, -1)


def _leading(group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Indexes of each group's first ``k`` rows by descending score, then id."""
    order = np.lexsort((vec_id, -score, group))
    g = group[order]
    rank = np.arange(g.size) - np.searchsorted(g, g)
    return order[rank < k]


class _Best:
    """The first ``k`` rows of each group among all rows offered so far."""

    def __init__(self, k: int):
        self.k, self.group, self.score, self.vec_id = k, *(np.zeros(0, np.int64) for _ in range(3))

    def offer(self, group: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        if group.size:
            group, score, vec_id = (np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.vec_id, vec_id)))
            keep = _leading(group, score, vec_id, self.k)
            self.group, self.score, self.vec_id = group[keep], score[keep], vec_id[keep]


class Chunk:
    """Packed candidates sorted by label."""

    def __init__(self, vec_id: np.ndarray, label: np.ndarray, bits: np.ndarray):
        order = np.lexsort((vec_id, label))
        self.vec_id, self.label, self.bits = vec_id[order], label[order], bits[order]

    def tiles(self, anchors: np.ndarray, start: int, end: int):
        """Scores of rows ``start .. end`` in tiles: (first row, first anchor, scores)."""
        for a in range(0, anchors.shape[0], COLUMNS):
            table = subset_sums(anchors[a: a + COLUMNS])
            for i in range(start, end, TILE):
                yield i, a, scores(table, self.bits[i: min(i + TILE, end)])

    def positives(self, anchor_id: np.ndarray, label: np.ndarray, anchors: np.ndarray, k: int) -> _Best:
        """Each anchor's ``k`` best rows of its label and other ids; groups are anchors."""
        best = _Best(k)
        for one in np.unique(label):
            who = np.flatnonzero(label == one)
            start, end = np.searchsorted(self.label, [one, one + 1])
            for i, a, s in self.tiles(anchors[who], start, end):
                ids = self.vec_id[i: i + s.shape[0]]
                other = ids[:, None] != anchor_id[who[a: a + COLUMNS]][None, :]
                if s.shape[0] > 4 * k:  # only what reaches the column's k-th score can lead
                    s = np.where(other, s, np.iinfo(np.int64).min)
                    other &= s >= np.partition(s, s.shape[0] - k, axis=0)[s.shape[0] - k]
                row, col = np.nonzero(other)
                best.offer(who[a + col], s[row, col], ids[row])
        return best

    def negatives(self, label: np.ndarray, anchors: np.ndarray, positive: np.ndarray, least: int, k: int) -> _Best:
        """For each anchor and positive, the ``k`` best rows of other labels in the positive's score band.

        ``positive`` holds up to ``p`` scores an anchor, -1 for none; groups are ``anchor * p + place``.
        """
        best = _Best(k)
        p = positive.shape[1]
        high = positive.max(axis=1)
        low = np.where(positive >= 0, positive, np.iinfo(np.int64).max // 200).min(axis=1)
        for i, a, s in self.tiles(anchors, 0, self.label.size):
            here = slice(a, a + COLUMNS)
            row, col = np.nonzero((s <= high[here]) & (100 * s >= least * low[here])
                                  & (self.label[i: i + s.shape[0], None] != label[here][None, :]))
            score, vec_id = s[row, col], self.vec_id[i + row]
            for j in range(p):
                top = positive[a + col, j]
                fit = (top >= 0) & (score <= top) & (100 * score >= least * top)
                best.offer((a + col[fit]) * p + j, score[fit], vec_id[fit])
        return best


def _visit(planes: int, k: int, places: int, least: int | None):
    """Rows by chunk and dims: packed candidates first, then blocks of anchors. ``least`` None seeks positives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, chunk = None, [], None
        for batch in batches:
            key = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if key.size else np.zeros(0, np.int64)
            for i, j in zip(edges, np.append(edges[1:], key.size)):
                if key[i] != at:
                    at, parts, chunk = key[i], [], None
                rows = batch.slice(i, j - i)
                here = rows.filter(pa.compute.equal(rows.column(1), 0))
                if here.num_rows:
                    parts.append((here.column(2).to_numpy(), here.column(3).to_numpy(), _bits(here.column(4), planes)))
                blocks = rows.filter(pa.compute.equal(rows.column(1), 1)).column(5)
                if not parts or not len(blocks):
                    continue
                if chunk is None:
                    chunk = Chunk(*(np.concatenate(x) for x in zip(*parts)))
                    parts = [()]
                for block in blocks:
                    yield from answer(chunk, block.values)

    def answer(chunk: Chunk, block: pa.StructArray) -> Iterator[pa.RecordBatch]:
        anchor, anchor_id, label = (block.field(f).to_numpy() for f in ("anchor", "anchor_id", "label"))
        vectors = unpack_bits(_bits(block.field("bits"), planes))
        if least is None:
            best = chunk.positives(anchor_id, label, vectors, k)
            who, place = best.group, np.zeros(best.group.size, np.int64)
            names, tops = best.vec_id, best.score
        else:
            some = block.field("top").value_lengths().to_numpy(zero_copy_only=False)
            tops_of = np.where(np.arange(places) < some[:, None], matrix(block.field("top"), places), -1)
            names_of = matrix(block.field("names"), places)
            best = chunk.negatives(label, vectors, tops_of, least, k)
            who, place = best.group // places, best.group % places
            names, tops = names_of[who, place], tops_of[who, place]
        if best.group.size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (anchor[who], anchor_id[who], place.astype(np.int32), names, tops, best.vec_id, best.score)],
                ["anchor", "anchor_id", "place", "positive_id", "positive_score", "vec_id", "score"])

    return run


def _pack(planes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for d in np.unique(dims):
                rows = batch.filter(pa.array(dims == d))
                bits = pack_bits(matrix(rows.column(4), int(d)), planes)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(i) for i in range(4)), pa.array([x.tobytes() for x in bits], pa.binary())],
                    ["chunk", "dims", "vec_id", "label", "bits"])

    return run


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, least: int = 80) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` holds ``vec_id, label, vec`` (integer vectors) and ``anchors`` is a condition on
    ``vec_id``. An anchor's positives are its best ``positives`` rows of the same label; each
    positive's negatives the best ``negatives`` rows of other labels that score between ``least`` percent
    of the positive and the positive itself (a positive below zero has none). Ties go to the smaller id.

    Rows with a null id or label, or an empty vector, take no part. Rows with an anchor's id are never
    its candidates; otherwise repeated rows each count, as anchors too. Only vectors of an
    anchor's length are its candidates. No rows give none; scores that could pass 2**63 / 100 raise.
    """
    spark = vectors.sparkSession
    whole = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0))
    whole = whole.select("vec_id", "label", "vec", F.size("vec").alias("dims"))
    largest, longest = extent(whole)
    if 200 * longest * largest ** 2 >= 2 ** 63:
        raise ValueError(f"components up to {largest} are too large for exact scores")
    planes = largest.bit_length() + 1
    rows = whole.count()
    chunks = max(1, min(rows, max(shuffle_width(spark), -(-rows // CHUNK))))
    packed = cut(whole.repartitionByRange(chunks, "dims", "label", "vec_id")
                 .select(F.spark_partition_id().alias("chunk"), "dims", "vec_id", "label", "vec")
                 .mapInArrow(_pack(planes), PACKED)
                 .select("*", F.monotonically_increasing_id().alias("anchor")))
    meta = [(r.chunk, r.dims, r.lo, r.hi, r.n) for r in  # a row for each chunk and length
            packed.groupBy("chunk", "dims").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                                F.count_if(anchors).alias("n")).collect()]
    fields = ("chunk", "dims", "lo", "hi", "n")
    table = F.from_json(F.lit(json.dumps([dict(zip(fields, m)) for m in meta])),
                        "array<struct<chunk int, dims int, lo long, hi long, n long>>")
    candidates = packed.select((F.col("chunk") * F.lit(1 << 20).cast("long") + F.col("dims")).alias("key"), F.lit(0).alias("side"),
                               "vec_id", "label", "bits")

    def blocks(asks: DataFrame, wanted) -> DataFrame:
        """Anchors of a chunk and length as blocks, a row for each chunk that satisfies ``wanted(block, chunk)``."""
        own = F.filter(table, lambda m: (m["chunk"] == F.col("chunk")) & (m["dims"] == F.col("dims")))[0]
        one = F.struct("anchor", F.col("vec_id").alias("anchor_id"), "label", "bits", "top", "names")
        block = (asks.withColumn("part", F.pmod(F.xxhash64("anchor"), F.ceil(own["n"] / ANCHORS)))
                 .groupBy("chunk", "dims", "part")
                 .agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.collect_list(one).alias("block")))
        to = F.filter(table, lambda m: (m["dims"] == F.col("dims")) & wanted(m))
        return (block.select("dims", "block", F.explode(to).alias("to"))
                .select((F.col("to.chunk") * F.lit(1 << 20).cast("long") + F.col("dims")).alias("key"), F.lit(1).alias("side"),
                        F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("long").alias("label"),
                        F.lit(None).cast("binary").alias("bits"), "block"))

    def search(asks: DataFrame, wanted, k: int, share: int | None) -> DataFrame:
        sent = blocks(asks, wanted)
        both = candidates.withColumn("block", F.lit(None).cast(sent.schema["block"].dataType)).unionByName(sent)
        found = (both.repartition(chunks, "key").sortWithinPartitions("key", "side")
                 .mapInArrow(_visit(planes, k, positives, share), FOUND))
        order = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    none = F.array().cast("array<long>")
    asked = packed.where(anchors)
    same = search(asked.withColumns({"top": none, "names": none}),
                  lambda m: (m["lo"] <= F.col("hi")) & (F.col("lo") <= m["hi"]), positives, None)
    tops = same.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("best"))
    asks = asked.join(tops.where(F.exists("best", lambda b: b["score"] >= 0)), "anchor").select(
        *asked.columns, F.col("best.score").alias("top"), F.col("best.vec_id").alias("names"))
    other = search(asks, lambda m: ~((m["lo"] == m["hi"]) & (F.col("lo") == F.col("hi")) & (m["lo"] == F.col("lo"))),
                   negatives, least)
    return other.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
