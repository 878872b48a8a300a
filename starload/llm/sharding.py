"""Sharding by sampled splitters, with DataFrame functions only.

Rows are ordered by a hash of their text, then of their id, then of their place in the input, so
that equal texts are neighbours and even one text or id that holds a third of all rows can be
divided. A sample in which a row's chance grows with its size gives quantile boundaries of
about equal weight; sizes are then counted exactly per range, and a range above its share is
divided again by splitters sampled within it. The ranges' sums, a few numbers each, give every range
its first byte and first row, so windows over single ranges suffice to place all rows exactly: no
task holds more than one range, and only sampled keys and range sums reach the driver.
"""

from __future__ import annotations

import json
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.frames import written

#: Ranges of a shard (and of a block of ``RANGE_BYTES``, whichever are more), sampled rows of a range.
RANGES = 64
RANGE_BYTES = 256 << 20
SAMPLES = 16
#: A range above this many times the mean is divided again, with twice the sample each time, in at most so many rounds.
OVERFULL = 2.0
ROUNDS = 7
#: Boundaries compared per step of the search for a row's range.
FANOUT = 32

KEY = ("text_hash", "id_hash", "row_hash")
KEY_TYPE = "struct<text_hash:bigint,id_hash:bigint,row_hash:bigint>"
LEAST = -2 ** 63


def keyed(docs: DataFrame, carry: list[str], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``carry`` columns of every row with ``size`` (UTF-8 bytes and 1; a null text has none), ``text_crc32`` and its key.

    Columns of ``carry`` come back as the struct ``row``, so that their names clash with nothing. Written to the shared folder:
    a row keeps its key in all passes.
    """
    body = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"),
                       (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
                       F.xxhash64(docs[text]).alias("text_hash"), F.xxhash64(docs[doc_id]).alias("id_hash"),
                       F.xxhash64(F.monotonically_increasing_id()).alias("row_hash"))
    return written(rows, "shard-rows")


def range_of(bounds: list[tuple]) -> Column:
    """The number of ``bounds`` (ascending keys) at or below a row's key, by a search of ``FANOUT`` comparisons a level."""
    key = F.struct(*KEY)
    levels = [bounds]
    while len(levels[-1]) > FANOUT:
        levels.append(levels[-1][FANOUT - 1:: FANOUT])
    place = F.lit(0)
    for level in reversed(levels):
        listed = F.from_json(F.lit(json.dumps([dict(zip(KEY, b)) for b in level])), f"array<{KEY_TYPE}>")
        place = place * FANOUT
        place = place + F.size(F.filter(F.slice(listed, place + 1, FANOUT), lambda b: b <= key))
    return place


def sample(pairs: DataFrame, wanted: int, total: int) -> list[tuple]:
    """About ``wanted`` (text, id) pairs in key order, each drawn with a chance in proportion to its bytes.

    ``((text_hash, id_hash), rows, weight)``. A pair's draw is a hash of its key, so that the sample follows from
    the rows alone. ``total`` is the sum of the bytes.
    """
    draw = (F.shiftrightunsigned(F.xxhash64("text_hash", "id_hash", F.lit("draw")), 11) + 0.5) / float(2 ** 53)
    step = total / wanted
    drawn = pairs.where(draw * step < F.col("bytes")).select("text_hash", "id_hash", "n", "bytes")
    return [((r.text_hash, r.id_hash), r.n, max(r.bytes, step)) for r in drawn.orderBy("text_hash", "id_hash").collect()]


def quantiles(drawn: list[tuple], parts: int) -> list[tuple]:
    """Boundaries that cut a weighted sample into ``parts`` of about equal weight.

    A boundary inside one text moves to the text's first key, unless the one before is already there;
    the next one to the first row of its id; further ones divide the rows of that id evenly. So only
    a text of more than a part's weight is divided, and only then its ids.
    """
    total, seen, out = sum(w for *_, w in drawn), 0.0, [(LEAST, LEAST, LEAST)]
    for (text, one), n, weight in drawn:
        while seen + weight > (target := total * len(out) / parts) and len(out) < parts:
            inside = LEAST + int(max(0.0, target - seen) / weight * 2 ** 64)
            ways = [(text, LEAST, LEAST), (text, one, LEAST)] + [(text, one, inside)] * (n > 1)
            out.append(next((b for b in ways if b > out[-1]), out[-1]))
        seen += weight
    return sorted(set(out))[1:]


def ranges(rows: DataFrame, shards: int) -> tuple[list[tuple], dict[int, tuple[int, int]]]:
    """Boundaries of the ranges and each range's exact (bytes, rows).

    The number of ranges follows the number of shards and the bytes, never the rows of one key.
    """
    pairs = written(rows.groupBy("text_hash", "id_hash").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-keys")
    total = pairs.agg(F.sum("bytes")).first()[0]
    if not total:
        return [], {}
    parts = max(RANGES * shards, -(-total // RANGE_BYTES))
    bounds = quantiles(sample(pairs, SAMPLES * parts, total), parts)
    for again in range(1, ROUNDS + 1):
        sums = {r.range: (r.bytes, r.n, r.most) for r in rows.withColumn("range", range_of(bounds)).groupBy("range").agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("size").alias("most")).collect()}
        # a single row cannot be divided, nor can what it fills
        over = {i: b for i, (b, n, most) in sums.items() if n > 1 and b - most > OVERFULL * total / parts}
        if not over or again == ROUNDS:
            break
        weight = sum(over.values())
        inside = pairs.withColumn("row_hash", F.lit(LEAST)).withColumn("range", range_of(bounds)).where(F.col("range").isin(sorted(over)))
        drawn: dict[int, list] = {i: [] for i in over}
        for one in sample(inside, (SAMPLES << again) * -(-weight * parts // total), weight):
            drawn[bisect_right(bounds, (*one[0], LEAST))].append(one)
        bounds = sorted({*bounds, *(b for i, keys in drawn.items() for b in quantiles(keys, -(-over[i] * parts // total)))})
    return bounds, {i: s[:2] for i, s in sums.items()}


def place_rows(rows: DataFrame, shards: int) -> DataFrame:
    """Add ``shard`` and ``slot`` to rows of ``keyed``: shards of nearly equal bytes, slots gapless from 0.

    A row's shard is the place of its first byte among all bytes; rows of one text go with the first of
    them, unless the text is so large that its range was divided. So a shard misses the mean by the
    largest row or text of a range, whichever is more. Within a shard, slots follow the key. No rows give none.
    """
    bounds, sums = ranges(rows, shards)
    total = max(1, sum(b for b, _ in sums.values()))
    base, done = {}, (0, 0)
    for i in sorted(sums):
        base[i] = done
        done = (done[0] + sums[i][0], done[1] + sums[i][1])
    apart = [any(b[1] != LEAST for b in bounds[max(i - 1, 0): i + 1]) for i in range(len(bounds) + 1)]
    known = [base.get(i) and {"b": base[i][0], "n": base[i][1], "apart": apart[i]} for i in range(len(bounds) + 1)]
    start = F.from_json(F.lit(json.dumps(known)), "array<struct<b:bigint,n:bigint,apart:boolean>>")[F.col("range")]
    order = Window.partitionBy("range").orderBy(*KEY)
    text = Window.partitionBy("range", "text_hash").orderBy(*KEY)
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (rows.withColumn("range", range_of(bounds))
              .select("*", (upto - F.col("size") + start["b"]).alias("byte"), (F.row_number().over(order) - 1 + start["n"]).alias("nth"))
              .withColumn("byte", F.when(start["apart"], F.col("byte")).otherwise(F.first("byte").over(text)))
              .withColumn("shard", F.expr(f"cast(byte * {shards}L div {total}L as int)")))
    # a shard's first row is in the range that holds its first byte, or opens the next one
    held = sorted(base)
    at = [bisect_right(held, s * total // shards, key=lambda i: base[i][0]) for s in range(shards)]
    opening = {i for k in at for i in held[max(k - 1, 0): k + 1]}
    first = {r.shard: r.nth for r in placed.where(F.col("range").isin(sorted(opening)))
             .groupBy("shard").agg(F.min("nth").alias("nth")).collect()}
    first_of = F.from_json(F.lit(json.dumps([first.get(s) for s in range(shards)])), "array<bigint>")
    return placed.withColumn("slot", F.col("nth") - first_of[F.col("shard")]).drop("range", "byte", "nth", *KEY)


def assign(docs: DataFrame, shards: int = 16, carry: list[str] | None = None, text: str = "text",
           doc_id: str = "doc_id") -> DataFrame:
    """``row, size, text_crc32, shard, slot``: every row (its ``carry`` columns, all by default, in a struct) in a shard.

    Null and empty texts have size 1. Rows may repeat, and their ids repeat or be null: each row has a
    slot of its own. Texts and ids decide the order and the shards, a row's place in the input only the
    order of rows equal in both: reruns agree, whatever the input's partitions.
    """
    return place_rows(keyed(docs, docs.columns if carry is None else carry, text, doc_id), shards)


def write_shards(placed: DataFrame, path: str) -> None:
    """Write rows of ``assign`` as a directory a shard, its files ascending by slot."""
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .select("row.*", "shard", "slot").write.partitionBy("shard").parquet(path))
