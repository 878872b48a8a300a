"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersections, connected groups.

A text's set holds the 64-bit hashes of its distinct word shingles. Sets are placed in size bands,
and each band is cut into tiles by signatures that any two linked sets of the band share
(``shingles.Bands``). Within a tile, hashed bitmaps bound each pair's overlap from
above; pairs that can reach the threshold are compared exactly, by intersecting their
sorted arrays.

Equal texts are one node from the start. Groups of near copies are not expanded into all pairs:
first a node is compared with the least of its tiles' smallest nodes, then each tile compares its smallest
node with the others it is not connected with yet, at last all pairs of nodes that are not connected
yet are compared. So every link is either found or lies within a component.

Scale: signatures travel as packed arrays, equal ones are combined per task first (a hot
tile sends one row per task to be matched), tiles of the same nodes are paired once, tiles over ``TILE`` nodes are cut into
blocks that are paired, and arrays are only built for nodes with a pair left after the bitmaps. The many steps
on small tables run in as many tasks as documents and texts make shares, whatever the shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.components import components
from starload.llm.frames import TASK_ROWS, binary_column, cut, shares, shuffle_width
from starload.llm.shingles import Bands, bitmap, bitmap_words, overlap, set_hash, shingle_sets
from starload.llm.textbytes import U64, mix, slices

#: Nodes of a tile that are paired in one step.
TILE = 1024
#: Signatures matched in one task, and held before they are sent on.
MATCHED = 3_000_000
HELD = 1_000_000
#: Places of the bounded filter that spares the shuffle of unneeded texts.
PLACES = 1 << 20
#: Bytes of text whose tiles, bitmaps and pairs make one task's share.
SHARE = 1 << 22

SIGNED = "bucket int, kind int, x binary, y binary, doc_id long, node long, n int, bits binary"
FOUND = "kind int, sig long, doc_id long, node long, n int, bits binary"


def _signed_batch(bucket: list[int], kind: int, x: list, y: list) -> pa.RecordBatch:
    n = len(bucket)
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array([kind] * n, pa.int32()), pa.array(x, pa.binary()), pa.array(y, pa.binary()),
         none, none, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
        ["bucket", "kind", "x", "y", "doc_id", "node", "n", "bits"])


def _narrow(values: np.ndarray) -> np.ndarray:
    """The low 40 bits of each value, five bytes a row."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :5])


def _widen(packed: pa.Buffer) -> np.ndarray:
    low = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    wide = np.zeros((len(low), 8), np.uint8)
    wide[:, :5] = low
    return wide.view(U64).ravel()


def _pack(sig: np.ndarray, node: np.ndarray, kind: int, buckets: int) -> pa.RecordBatch:
    """One row of packed arrays per bucket; with its bucket, a signature keeps 40 bits (more tiles meet by chance, none is lost)."""
    place = (sig % U64(buckets)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    sig, node, place = _narrow((sig // U64(buckets))[order]), node[order], place[order]
    at = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if place.size else np.zeros(0, np.int64)
    to = np.append(at[1:], place.size)
    return _signed_batch(place[at].tolist(), kind, [sig[i:j].tobytes() for i, j in zip(at, to)],
                         [node[i:j].tobytes() for i, j in zip(at, to)])


def _groups(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (sig, node) rows in order, the first row of each sig, and which rows' sig has more than one node."""
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    new = np.append(True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])) if sig.size else np.zeros(0, bool)
    sig, node = sig[new], node[new]
    first = np.append(True, sig[1:] != sig[:-1]) if sig.size else np.zeros(0, bool)
    group = np.cumsum(first) - 1
    several = (np.bincount(group) > 1)[group] if sig.size else np.zeros(0, bool)
    return sig, node, first, several


def _sign(percent: int, width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        sigs: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            sig, node, first, several = _groups(np.concatenate(sigs), np.concatenate(nodes))
            yield _pack(sig[first], node[first], 0, buckets)
            if several.any():
                yield _pack(sig[several], node[several], 1, buckets)

        for batch in batches:
            ids = batch.column(0)
            for i, j, data, offs in slices(binary_column(batch, "text")):
                sets = shingle_sets(data, offs, width)
                own = [set_hash(s) if s.size else None for s in sets]
                none = pa.nulls(j - i, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(h or k) % buckets for k, h in enumerate(own)], pa.int32()), pa.array([2] * (j - i), pa.int32()),
                     none, none, ids[i:j], pa.array(own, pa.int64()), pa.array([s.size for s in sets], pa.int32()),
                     pa.array([bitmap(s, bitmap_words(s.size)).tobytes() if s.size else None for s in sets], pa.binary())],
                    ["bucket", "kind", "x", "y", "doc_id", "node", "n", "bits"])
                done = set()
                for s, h in zip(sets, own):
                    if h is not None and h not in done:
                        done.add(h)
                        sigs.append(bands.signatures(s))
                        nodes.append(np.full(sigs[-1].size, h, dtype=np.int64))
                        held += sigs[-1].size
                if held > HELD:
                    yield from flush()
                    sigs, nodes, held = [], [], 0
        if sigs:
            yield from flush()

    return run


def _match(buckets: int):
    """Pass documents and tiles found on the way; find the tiles among all tasks' signatures."""

    def tiles(sig: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        n = sig.size
        return pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(n, np.int32)), pa.array(sig.view(np.int64)), pa.nulls(n, pa.int64()), pa.array(node),
             pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], ["kind", "sig", "doc_id", "node", "n", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, nodes = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for batch in batches:
            kind = batch.column(1).to_numpy()
            docs = batch.filter(pa.array(kind == 2))
            if docs.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(docs.num_rows, np.int32)), pa.nulls(docs.num_rows, pa.int64()), *docs.columns[4:]],
                    ["kind", "sig", "doc_id", "node", "n", "bits"])
            for bucket, k, x, y in zip(batch.column(0).to_pylist(), kind.tolist(), batch.column(2), batch.column(3)):
                if k != 2:
                    sig, node = _widen(x.as_buffer()) * U64(buckets) + U64(bucket), np.frombuffer(y.as_buffer(), np.int64)
                    if k == 1:
                        yield tiles(sig, node)
                    else:
                        sigs.append(sig)
                        nodes.append(node.copy())
        sig, node, _, several = _groups(np.concatenate(sigs), np.concatenate(nodes))
        if several.any():
            yield tiles(sig[several], node[several])

    return run


def _may_link(na, nb, differ, percent: int):
    """Whether sets of these sizes that differ in at least so many elements can reach the threshold."""
    most = (na + nb - differ) // 2
    return 100 * most >= percent * (na + nb - most)


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def _tile_pairs(node, comp, n, bits, side, percent: int) -> np.ndarray:
    """Pairs of a tile that are not connected yet and that sizes and bitmaps do not rule out."""
    words = min(b.size for b in bits)
    rows = np.stack([_fold(b, words) for b in bits])
    out = []
    for i in range(node.size):
        rest = np.flatnonzero((comp[i + 1:] != comp[i]) & ((side[i + 1:] != side[i]) | (side[i] == 0))) + i + 1
        if rest.size:
            differ = np.bitwise_count(rows[rest] ^ rows[i]).sum(axis=1, dtype=np.int64)
            fit = rest[_may_link(n[i], n[rest], differ, percent)]
            if fit.size:
                out.append(np.stack([np.full(fit.size, node[i]), node[fit]], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _pairs_of_tiles(percent: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        found: list[np.ndarray] = []
        held = 0

        def emit() -> pa.RecordBatch:
            pairs = np.sort(np.concatenate(found), axis=1)
            pairs = np.unique(pairs, axis=0)
            place = (mix(np.ascontiguousarray(pairs[:, 0]).view(U64) + mix(np.ascontiguousarray(pairs[:, 1]).view(U64))) % U64(buckets)).astype(np.int32)
            order = np.argsort(place, kind="stable")
            pairs, place = pairs[order], place[order]
            at = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            return pa.RecordBatch.from_arrays(
                [pa.array(place[at]), pa.array([pairs[i:j].tobytes() for i, j in zip(at, np.append(at[1:], len(pairs)))], pa.binary())],
                ["bucket", "pairs"])

        def work(table: pa.Table) -> int:
            key = np.stack([table.column(c).to_numpy() for c in ("sig", "lo", "hi")])
            at = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
            node, comp, n, block, lo, hi = (table.column(c).to_numpy() for c in ("node", "comp", "n", "block", "lo", "hi"))
            bits = [np.frombuffer(b.as_buffer(), U64) for b in table.column("bits")]
            new = 0
            for i, j in zip(at, np.append(at[1:], key.shape[1])):
                # within a block all rows are on side 0; between two blocks only pairs across are new
                side = np.where(lo[i:j] == hi[i:j], 0, 1 + (block[i:j] == hi[i:j]))
                pairs = _tile_pairs(node[i:j], comp[i:j], n[i:j], bits[i:j], side, percent)
                if pairs.size:
                    found.append(pairs)
                    new += len(pairs)
            return new

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            key = np.stack([table.column(c).to_numpy() for c in ("sig", "lo", "hi")])
            change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
            full = int(change[-1]) + 1 if change.size else 0
            if full:
                held += work(table.slice(0, full).combine_chunks())
            rest = table.slice(full).combine_chunks()
            if held > HELD:
                yield emit()
                found.clear()
                held = 0
        if rest is not None and rest.num_rows:
            work(rest)
        if found:
            yield emit()

    return run


def _distinct_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of the packed ones that meet in a task."""
    held = [np.zeros((0, 2), np.int64)]
    for batch in batches:
        held.extend(np.frombuffer(p.as_buffer(), np.int64).reshape(-1, 2).copy() for p in batch.column(1))
        if len(held) > 256:
            held = [np.unique(np.concatenate(held), axis=0)]
    pairs = np.unique(np.concatenate(held), axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k])) for k in (0, 1)], ["a", "b"])


def _pass_bitmaps(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(c).to_numpy().astype(np.int64) for c in ("na", "nb"))
            keep = np.zeros(batch.num_rows, dtype=bool)
            for k, (x, y) in enumerate(zip(batch.column("xa"), batch.column("xb"))):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                words = min(x.size, y.size)
                keep[k] = _may_link(na[k], nb[k], int(np.bitwise_count(_fold(x, words) ^ _fold(y, words)).sum()), percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _arrays(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in slices(binary_column(batch, "text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.array([s.tobytes() for s in shingle_sets(data, offs, width)], pa.binary())],
                    ["node", "shingles"])

    return run


def _link(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = overlap(x, y)
                keep.append(100 * both >= percent * (x.size + y.size - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class NgramJoin:
    """The steps of one join over ``docs``; see ``jaccard_groups``."""

    def __init__(self, docs: DataFrame, width: int, percent: int):
        self.spark = docs.sparkSession
        self.docs, self.width, self.percent = docs, width, percent

    def labelled(self, pairs: DataFrame, comps: DataFrame) -> DataFrame:
        """``a, b, x, y``: pairs with the components of their ends; a node without one is its own."""
        x = comps.select(F.col("node").alias("a"), F.col("comp").alias("x"))
        y = comps.select(F.col("node").alias("b"), F.col("comp").alias("y"))
        return pairs.join(x, "a", "left").coalesce(self.wide).join(y, "b", "left").select(
            "a", "b", F.coalesce("x", "a").alias("x"), F.coalesce("y", "b").alias("y")).coalesce(self.wide)

    def extended(self, comps: DataFrame, links: DataFrame) -> DataFrame:
        """``node, comp`` after further links: only the components that they join are walked again, one node each."""
        up = cut(components(self.labelled(links, comps).select(F.col("x").alias("a"), F.col("y").alias("b"))))
        known = comps.join(up.select(F.col("node").alias("comp"), F.col("comp").alias("up")), "comp", "left").select(
            "node", F.coalesce("up", "comp").alias("comp"))
        return known.unionByName(up.join(comps.select("node"), "node", "left_anti")).coalesce(self.narrow)

    def sign(self) -> tuple[DataFrame, DataFrame]:
        """Documents ``doc_id, node, n, bits`` and tiles ``sig, node`` of at least two nodes."""
        # a set of n words signs about 0.4 n classes, and a word takes some five bytes
        rows, size = self.docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
        self.narrow, self.wide = shares(rows, TASK_ROWS), shares(size, SHARE)
        self.parts = max(shuffle_width(self.spark), -(-size // (12 * MATCHED)))
        buckets = 16 * self.parts
        signed = self.docs.mapInArrow(_sign(self.percent, self.width, buckets), SIGNED)
        found = cut(signed.repartition(self.parts, "bucket").mapInArrow(_match(buckets), FOUND).coalesce(self.wide))
        return (found.where("kind = 1").select("doc_id", "node", "n", "bits"),
                found.where("kind = 0").select("sig", "node"))

    def passing(self, pairs: DataFrame) -> DataFrame:
        """Pairs that bitmaps do not rule out."""
        a = self.nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa"))
        b = self.nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb"))
        near = ((F.col("na") * 100 >= F.col("nb") * self.percent) & (F.col("nb") * 100 >= F.col("na") * self.percent))
        met = pairs.join(a, "a").coalesce(self.wide).join(b, "b").where(near)
        return met.mapInArrow(_pass_bitmaps(self.percent), "a long, b long").coalesce(self.wide)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose similarity reaches the threshold, by exact intersection."""
        pairs = cut(pairs)
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = cut(self.nodes.join(ends, "node").select("node", F.col("rep").alias("doc_id")).coalesce(self.narrow))
        place = F.pmod(F.xxhash64("doc_id"), F.lit(PLACES))
        # at most PLACES rows, whatever is wanted: spares the shuffle of most other texts
        places = F.broadcast(wanted.select(place.alias("place")).distinct())
        texts = self.docs.withColumn("place", place).join(places, "place", "left_semi").join(wanted, "doc_id").select("node", "text")
        arrays = cut(texts.mapInArrow(_arrays(self.width), "node long, shingles binary").coalesce(self.wide))
        a = arrays.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
        b = arrays.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        met = pairs.join(a, "a").coalesce(self.wide).join(b, "b")
        return cut(met.mapInArrow(_link(self.percent), "a long, b long").coalesce(self.wide))

    def first_pairs(self) -> DataFrame:
        """Each tile's smallest node with the others."""
        least = self.tiles.groupBy("sig").agg(F.min("node").alias("a"))
        return (self.tiles.join(least, "sig").where("node <> a")
                .select("a", F.col("node").alias("b")).coalesce(self.wide).distinct().coalesce(self.wide))

    def starred(self) -> DataFrame:
        """``node, comp`` of the nodes linked by ``first_pairs``, in two rounds.

        Copies meet in many tiles, whose smallest nodes differ. So a node is first compared with the least of them only,
        one pair a node; of the other pairs, those not connected by then are compared.
        """
        pairs = cut(self.first_pairs())
        one = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b").coalesce(self.narrow)
        comps = cut(components(self.verified(self.passing(one))))
        rest = pairs.join(one, ["a", "b"], "left_anti").coalesce(self.wide)
        apart = self.labelled(rest, comps).where("x <> y").select("a", "b")
        return cut(self.extended(comps, self.verified(self.passing(apart))))

    def other_pairs(self, comps: DataFrame) -> DataFrame:
        """Pairs of nodes of a tile that are not connected yet and that bitmaps do not rule out."""
        known = cut(self.tiles.distinct().coalesce(self.wide).join(comps, "node", "left")
                    .select("sig", "node", F.coalesce("comp", "node").alias("comp")).coalesce(self.wide))
        # texts alike in part meet in many tiles: of tiles with the same nodes (128 bits and their number), one is enough
        mixed = (known.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("rows"),
                                          F.bit_xor("node").alias("u"), F.bit_xor(F.xxhash64("node")).alias("v"))
                 .where("x <> y").coalesce(self.wide).groupBy("rows", "u", "v").agg(F.min("sig").alias("sig"))
                 .select("sig", F.ceil(F.col("rows") / TILE).cast("int").alias("blocks")).coalesce(self.wide))
        rows = (known.join(mixed, "sig").coalesce(self.wide).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
                .join(self.nodes.select("node", "n", "bits"), "node").coalesce(self.wide)
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .select("sig", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block",
                        "node", "comp", F.col("n").cast("long").alias("n"), "bits"))
        return (rows.repartition("sig", "lo", "hi").sortWithinPartitions("sig", "lo", "hi", "node")
                .mapInArrow(_pairs_of_tiles(self.percent, self.parts), "bucket int, pairs binary").coalesce(self.wide)
                # a pair meets in several tiles: packed, pairs are brought together and told apart
                .repartition(self.parts, "bucket").mapInArrow(_distinct_pairs, "a long, b long").coalesce(self.wide))

    def run(self) -> tuple[DataFrame, DataFrame]:
        """Documents ``doc_id, node, n`` and ``node, comp`` of the linked nodes."""
        members, self.tiles = self.sign()
        shared = self.tiles.select("node").distinct()
        self.nodes = cut(members.join(shared, "node", "left_semi").groupBy("node")
                         .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits")).coalesce(self.wide))
        comps = self.starred()
        second = self.verified(self.other_pairs(comps))
        return members.select("doc_id", "node", "n"), self.extended(comps, second)


def jaccard_groups(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document.

    Texts are split at blanks after lower-casing A-Z; two documents link when
    ``100 * |intersection| >= percent * |union|`` of their sets of ``width``-word shingles. A text of fewer words
    has one shingle, all its words; a null or blank text has none and links with nothing.
    ``component_id`` is the smallest id reachable by links, the document's own included.
    Repeated rows count as copies of each other; a null id belongs to no group (null component),
    and does not link others. Empty tables give no rows; further columns are not read.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    join = NgramJoin(rows.where("doc_id is not null"), width, percent)
    members, comps = join.run()
    labelled = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")).coalesce(join.narrow)
    least = labelled.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id")).coalesce(join.narrow)
    # a text without words has no node: it is a group of its own
    grouped = (labelled.join(least, "comp", "left").coalesce(join.narrow)
               .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))
    lost = NgramJoin(rows.where("doc_id is null"), width, percent)
    return grouped.unionByName(lost.docs.mapInArrow(_sizes(width), "doc_id long, n_shingles long, component_id long"))


def _sizes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in slices(binary_column(batch, "text")):
                sizes = [s.size for s in shingle_sets(data, offs, width)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(sizes, pa.int64()), pa.nulls(j - i, pa.int64())],
                                                 ["doc_id", "n_shingles", "component_id"])

    return run
