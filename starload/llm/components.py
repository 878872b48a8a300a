"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.frames import TASK_ROWS, cut, shares


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of ``a, b`` (64-bit ids): the smallest node it is connected with.

    Each step takes the smallest neighbour per node by a partial aggregate and joins it back, so
    no neighbourhood is gathered and a hot node's join can be split. Steps double the reach,
    and each one's edges are cut into the shared checkpoint folder; steps run in as many tasks
    as the edges, whose number never grows, make shares. Loops and repeated edges are harmless;
    null ends are left out; no edges give no rows.
    """
    given = cut(edges.where("a is not null and b is not null and a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    parts = shares(given.count(), TASK_ROWS)
    now = cut(given.coalesce(parts).distinct().coalesce(parts))
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").where("b > a and b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(parts).distinct().coalesce(parts))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a")
                 .select(F.inline(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                          F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")))))
                 .where("a <> b").coalesce(parts).distinct().coalesce(parts))
        then = cut(small)
        after = _state(then)
        now = then
        if after == state:
            break
        state = after
    return (now.select(F.col("a").alias("node"), F.col("b").alias("comp"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("comp")))
            .groupBy("node").agg(F.min("comp").alias("comp")).coalesce(parts))
