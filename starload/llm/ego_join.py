"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with a cosine of at least ``t`` lie within ``eps = sqrt(2 - 2 t)`` of each other. Vectors are rotated
to principal dimensions (an orthonormal basis fitted on a bounded sample; any basis gives the
same result), a grid of side ``eps`` is laid over the leading ones, and vectors are sorted by their
cells. The sequence is cut into intervals; two intervals are skipped if their boxes in the leading
dimensions are more than ``eps`` apart, else they are halved and compared again, down to short
intervals whose cosines are computed in double precision.

Equal vectors of a label are one row with a weight from the start. Blocks of the sequence bound a
task's memory; a pair of blocks yields link counts and a spanning forest of its links, never
the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.components import components
from starload.llm.frames import cut, shuffle_width

#: Rows of the sequence in a block (on average), leading dimensions with a grid, and the shortest interval.
BLOCK = 16_384
LEADING = 4
SHORT = 128
#: Vectors the principal dimensions are fitted on (those with the smallest id hashes).
SAMPLE = 4096
#: Links held before they are reduced to a forest.
HELD = 1_000_000
OUT = "node long, links long, a long, b long"


def linkable():
    """Whether a row ``vec_id, label, vec`` can link."""
    return (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0)
            & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vec", lambda x: x != 0))


def principal_axes(sample: np.ndarray, leading: int) -> np.ndarray:
    """The leading principal directions of a sample of unit vectors, as rows."""
    if not len(sample):
        return np.zeros((0, sample.shape[1] if sample.ndim == 2 else 0))
    _, _, axes = np.linalg.svd(sample - sample.mean(axis=0), full_matrices=False)
    return axes[:leading]


def _norm(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that very large and very small ones neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cells(axes: dict[int, np.ndarray], eps: float, leading: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array(batch.column(batch.schema.get_field_index("dims")))
            cells = np.zeros((batch.num_rows, leading))
            vec = batch.column(batch.schema.get_field_index("vec"))
            for dims in np.unique(size):
                mine = np.flatnonzero(size == dims)
                x = _norm(vec.take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False).reshape(mine.size, dims))
                own = axes.get(int(dims), np.zeros((0, dims)))
                cells[mine, : len(own)] = np.floor(x @ own.T / eps) if eps else 0
            out = [pa.array(cells[:, d].astype(np.int32)) for d in range(leading)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], [*batch.schema.names, *[f"c{d}" for d in range(leading)]])

    return run


class _Block:
    def __init__(self, table: pa.Table, axes: np.ndarray, eps: float):
        self.node = table.column("node").to_numpy()
        self.weight = table.column("weight").to_numpy().astype(np.float64)
        raw = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(self.node), -1)
        self.unit = _norm(raw)
        self.place = self.unit @ axes.T if len(axes) else np.zeros((len(self.node), 1))
        cell = np.floor(self.place / eps) if eps else self.place
        order = np.lexsort((self.node, *cell.T[::-1]))
        self.node, self.weight, self.unit, self.place = (v[order] for v in (self.node, self.weight, self.unit, self.place))
        self.links = np.zeros(len(self.node))


def _apart(x: np.ndarray, y: np.ndarray, eps: float) -> bool:
    """Whether the boxes of two intervals are provably more than ``eps`` apart (with room for rounding)."""
    gap = np.maximum(0, np.maximum(x.min(axis=0) - y.max(axis=0), y.min(axis=0) - x.max(axis=0)))
    return bool((gap * gap).sum() > eps * eps + 1e-9)


def _join(x: _Block, y: _Block, i: int, j: int, k: int, m: int, eps: float, least: float, edges: list) -> None:
    """Join interval ``[i, j)`` of ``x`` with ``[k, m)`` of ``y``; the same interval with itself counts each pair once."""
    if i == j or k == m or _apart(x.place[i:j], y.place[k:m], eps):
        return
    if j - i <= SHORT and m - k <= SHORT:
        hit = x.unit[i:j] @ y.unit[k:m].T >= least
        if x is y and i == k:
            hit = np.triu(hit, 1)
        if hit.any():
            x.links[i:j] += hit @ y.weight[k:m]
            y.links[k:m] += hit.T @ x.weight[i:j]
            a, b = np.nonzero(hit)
            edges.append(np.stack([x.node[i:j][a], y.node[k:m][b]], axis=1))
            if sum(map(len, edges)) > HELD:
                edges[:] = [_forest(np.concatenate(edges))]
        return
    s, t = (i + j) // 2, (k + m) // 2
    if x is y and i == k:
        _join(x, x, i, s, i, s, eps, least, edges)
        _join(x, x, s, j, s, j, eps, least, edges)
        _join(x, x, i, s, s, j, eps, least, edges)
        return
    for p, q in ((i, s), (s, j)) if j - i > SHORT else ((i, j),):
        for u, v in ((k, t), (t, m)) if m - k > SHORT else ((k, m),):
            _join(x, y, p, q, u, v, eps, least, edges)


def _forest(edges: np.ndarray) -> np.ndarray:
    """A spanning forest of the edges: each node with the smallest node it is connected with here."""
    names, flat = np.unique(edges, return_inverse=True)
    ends = flat.reshape(-1, 2)
    root = np.arange(names.size)
    while True:
        least = np.minimum(root[ends[:, 0]], root[ends[:, 1]])
        new = root.copy()
        np.minimum.at(new, ends[:, 0], least)
        np.minimum.at(new, ends[:, 1], least)
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    more = root != np.arange(names.size)
    return np.stack([names[more], names[root[more]]], axis=1)


def _join_blocks(axes: dict[int, np.ndarray], eps: float, least: float):
    """Rows sorted by pair of blocks, the first block (side 0) before the second (side 1)."""

    def pair(table: pa.Table) -> Iterator[pa.RecordBatch]:
        dims = int(table.column("dims")[0].as_py())
        own = axes.get(dims, np.zeros((0, dims)))
        side = table.column("side").to_numpy()
        x = _Block(table.filter(pa.array(side == 0)), own, eps)
        y = _Block(table.filter(pa.array(side == 1)), own, eps) if (side == 1).any() else x
        edges: list[np.ndarray] = []
        _join(x, y, 0, x.node.size, 0, y.node.size, eps, least, edges)
        for b in (x, y) if y is not x else (x,):
            some = np.flatnonzero(b.links)
            if some.size:
                yield pa.RecordBatch.from_arrays([pa.array(b.node[some]), pa.array(b.links[some].astype(np.int64)),
                                                  pa.nulls(some.size, pa.int64()), pa.nulls(some.size, pa.int64())],
                                                 ["node", "links", "a", "b"])
        if edges:
            ends = _forest(np.concatenate(edges))
            n = len(ends)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(ends[:, 0]),
                                              pa.array(ends[:, 1])], ["node", "links", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in (0, 1)])
            edges = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))) if batch.num_rows else []
            for i, j in zip(edges, np.append(edges[1:], batch.num_rows).astype(int)):
                if at != tuple(key[:, i]) and held:
                    yield from pair(pa.Table.from_batches(held))
                    held = []
                at = tuple(key[:, i])
                held.append(batch.slice(i, j - i))
        if held:
            yield from pair(pa.Table.from_batches(held))

    return run


def near_duplicates(table: DataFrame, least: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding",
                    label: str = "label", leading: int = LEADING) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row: cosine links of at least ``least`` within a label.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id reachable by
    links, ``kept`` tells whether that is the row's own. Null, zero or empty vectors, vectors
    with null or non-finite components, and null labels link with nothing; neither do vectors of
    different lengths. Rows with one id count as rows of their own; a null id links with
    nothing and has a null component. Empty tables give no rows.
    """
    spark = table.sparkSession
    eps = float(np.sqrt(max(0.0, 2 - 2 * least)))
    sound = table.select(table[vec_id].cast("long").alias("vec_id"), table[label].alias("label"),
                         table[embedding].cast("array<double>").alias("vec")).where(linkable())
    # equal vectors of a label are one node; a hot vector is combined before the shuffle
    nodes = cut(sound.groupBy("label", "vec").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"))
                .withColumn("dims", F.size("vec")))
    axes = {}
    for row in nodes.select("dims").distinct().limit(64).collect():  # other lengths are joined without a grid
        picked = (nodes.where(F.col("dims") == row["dims"]).orderBy(F.xxhash64("node"), "node").limit(SAMPLE)
                  .select("vec").toPandas()["vec"])
        axes[row["dims"]] = principal_axes(_norm(np.array(picked.tolist(), dtype=float)), leading)
    cells = [f"c{d}" for d in range(leading)]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema) + ", " + ", ".join(f"{c} int" for c in cells)
    gridded = nodes.mapInArrow(_cells(axes, eps, leading), schema)
    count = nodes.count()
    parts = max(1, min(count, max(shuffle_width(spark), -(-count // BLOCK))))
    # consecutive intervals of the epsilon grid order; a label or length that ends inside one splits it
    ordered = cut(gridded.repartitionByRange(parts, "label", "dims", *cells, "node")
                  .withColumn("part", F.spark_partition_id()))
    shapes = (ordered.groupBy("label", "dims", "part").agg(F.min("c0").alias("from0"), F.max("c0").alias("to0"),
                                                           *[F.min(c).alias(f"l{c}") for c in cells[1:]],
                                                           *[F.max(c).alias(f"h{c}") for c in cells[1:]]))
    numbered = cut(shapes.withColumn("block", F.xxhash64("label", "dims", "part")))
    reach = F.explode(F.sequence(F.col("from0") - 1, F.col("to0") + 1))
    one = numbered.withColumn("cell", F.explode(F.sequence("from0", "to0"))).drop("part")
    two = numbered.withColumn("cell", reach).drop("part")
    meets = [F.col("x.label") == F.col("y.label"), F.col("x.dims") == F.col("y.dims"), F.col("x.cell") == F.col("y.cell"),
             F.col("x.block") <= F.col("y.block")]
    for c in cells[1:]:  # cells more than one apart in a dimension are more than eps apart
        meets += [F.col(f"x.l{c}") <= F.col(f"y.h{c}") + 1, F.col(f"y.l{c}") <= F.col(f"x.h{c}") + 1]
    pairs = cut(one.alias("x").join(two.alias("y"), [*meets])
             .select(F.col("x.block").alias("one"), F.col("y.block").alias("two")).distinct())
    with_block = ordered.withColumn("block", F.xxhash64("label", "dims", "part")).select("block", "node", "weight", "vec", "dims")
    left = with_block.join(pairs.withColumnRenamed("one", "block"), "block").select(
        F.col("block").alias("one"), "two", F.lit(0).alias("side"), "node", "weight", "vec", "dims")
    right = (with_block.join(pairs.where("one <> two").withColumnRenamed("two", "block"), "block").select(
        "one", F.col("block").alias("two"), F.lit(1).alias("side"), "node", "weight", "vec", "dims"))
    # the place in the sequence within a block follows the grid order again
    joined = cut(left.unionByName(right).repartition("one", "two").sortWithinPartitions("one", "two", "side")
                 .mapInArrow(_join_blocks(axes, eps, least), OUT))
    links = joined.where("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    comps = components(joined.where("a is not null").select("a", "b"))
    # a node is named by its smallest id, so the smallest node of a component is its smallest id
    per_vector = (nodes.join(links, "node", "left").join(comps, "node", "left")
                  .select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                          F.coalesce("comp", "node").alias("component_id")))
    linked = (sound.join(per_vector, ["label", "vec"])
              .select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")))
    alone = (table.select(table[vec_id].cast("long").alias("vec_id"), table[label].alias("label"),
                          table[embedding].cast("array<double>").alias("vec"))
             .where(~F.coalesce(linkable(), F.lit(False)))
             .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                     F.col("vec_id").isNotNull().alias("kept")))
    return linked.unionByName(alone)
