"""Training-order materialisation of token sequences into fixed-stride shards.

Sequences are numbered densely (partition by partition, as the input is laid out), a
keyed Feistel permutation with cycle-walking sends each number to a global slot, and
a range shuffle by slot writes shards of ``shard_records`` records. A record has a fixed
stride: 8 bytes doc id, 4 bytes sequence number, 4 bytes token count (big-endian), the
tokens (zero-padded) and one closing LF. So slot ``k`` lies in shard ``k // shard_records`` at byte
``(k % shard_records) * stride``, and a reader can go on from any slot.

Shards are written by Spark's text sink (records are its lines), hence on any file system
Spark can write to, with its commit protocol: a lost task leaves no partial shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.bpe import codec
from starload.llm.frames import binary_column, shuffle_width
from starload.llm.textbytes import mix, slices

HEADER = 16
#: Tokens in a sequence and records in a shard of the registered query.
LENGTH = 512
SHARD_RECORDS = 4096
ROUNDS = 6
#: The document id that stands for a null one.
NO_ID = -2 ** 63
#: Bytes of tokens written by one task.
TASK_BYTES = 256 << 20


SEQUENCE = "doc_id long, seq_no int, n_tokens int, tokens binary"
#: Cuts batches of ``doc_id, text`` into batches of sequences.
Cutter = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def bpe_cutter(path: str, pattern: str, length: int = LENGTH) -> Cutter:
    """A cutter into sequences of at most ``length`` byte-level BPE ids: ``doc_id, seq_no, n_tokens, tokens``.

    Every whole text is encoded and cut into stretches of ``length`` ids, the last one
    shorter; ``tokens`` holds them as little-endian 16-bit (32-bit for vocabularies over
    65,536) integers. Null and empty texts give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        kind = np.dtype("<u2" if len(own.tokens) <= 1 << 16 else "<u4")
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, offs in slices(binary_column(batch, "text")):
                tokens, at = own.encode_rows(data, offs)
                n = -(-np.diff(at) // length)
                seq = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                begin = np.repeat(at[:-1], n) + seq * length
                size = np.minimum(length, np.repeat(at[1:], n) - begin)
                # the stretches lie one after the other
                cells = pa.Array.from_buffers(pa.large_binary(), seq.size, [None, pa.py_buffer(
                    np.append(begin, at[-1]).astype(np.int64) * kind.itemsize), pa.py_buffer(tokens.astype(kind))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[i:j], n), pa.int64()), pa.array(seq.astype(np.int32)),
                     pa.array(size.astype(np.int32)), cells.cast(pa.binary())], ["doc_id", "seq_no", "n_tokens", "tokens"])

    return run


def permute(index: np.ndarray, total: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of ``[0, total)``: a balanced Feistel network over the next power of four,
    walked along its cycle until the value is below ``total``."""
    half = np.uint64(max(1, (max(total - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) + np.uint64(key % 2 ** 63) * np.uint64(2654435761))
    value = index.astype(np.uint64)
    todo = np.arange(value.size)
    while todo.size:
        left, right = value[todo] >> half, value[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        value[todo] = left << half | right
        todo = todo[value[todo] >= total]
    return value.astype(np.int64)


def assign_slots(docs: DataFrame, cutter: Cutter, key: int, doc_id: str = "doc_id",
                 text: str = "text") -> tuple[DataFrame, int]:
    """The documents' sequences with ``slot``, a keyed permutation of their dense numbers, and their number.

    The plan runs twice: once to count each partition's sequences (one number per partition
    goes to the driver), once to number them. So ``docs`` must give the same rows in the
    same partitions each time, as map-only plans over files do; cut the lineage of any other
    input first. Null and empty texts give no sequence; repeated rows give sequences of their
    own; an empty table gives none. A null id is ``NO_ID`` here and in the shards, and null again when they are read.
    """
    rows = docs.select(F.coalesce(docs[doc_id].cast("long"), F.lit(NO_ID)).alias("doc_id"), docs[text].alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(b.num_rows for b in cutter(batches))
        yield pa.RecordBatch.from_pydict({"pid": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                          "n": pa.array([n], pa.int64())})

    counts = {r["pid"]: r["n"] for r in rows.mapInArrow(count, "pid int, n long").collect()}
    bases, total = {}, 0
    for pid in sorted(counts):
        bases[pid] = total
        total += counts[pid]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = bases.get(TaskContext.get().partitionId(), 0)
        for b in cutter(batches):
            slot = permute(np.arange(at, at + b.num_rows), total, key)
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(slot)], [*b.schema.names, "slot"])

    return rows.mapInArrow(number, SEQUENCE + ", slot long"), total


def write_shards(slotted: DataFrame, total: int, path: str, token_bytes: int = 2 * LENGTH,
                 shard_records: int = SHARD_RECORDS) -> None:
    """Write ``doc_id, seq_no, n_tokens, tokens, slot`` as fixed-stride shards below ``path``.

    ``token_bytes`` is the room for a sequence's tokens; shorter ones are padded with zeros. One
    shuffle by equal ranges of ``total`` slots: a shard's records meet in one task, sorted by slot.
    """
    shards = max(1, -(-total // shard_records))
    parts = min(shards, max(shuffle_width(slotted.sparkSession), -(-total * token_bytes // TASK_BYTES)))
    zeros = F.lit(bytes(token_bytes))
    head = [F.unhex(F.lpad(F.hex("doc_id"), 16, "0")), F.unhex(F.lpad(F.hex("seq_no"), 8, "0")),
            F.unhex(F.lpad(F.hex("n_tokens"), 8, "0"))]
    body = F.concat(F.col("tokens"), F.substring(zeros, F.lit(1), F.lit(token_bytes) - F.octet_length("tokens")))
    (slotted.withColumn("shard", F.floor(F.col("slot") / F.lit(shard_records)).cast("long"))
     .repartitionById(parts, F.floor(F.col("shard") * F.lit(parts) / F.lit(shards)).cast("int"))
     .sortWithinPartitions("shard", "slot")
     .select(F.concat(*head, body).cast("string").alias("value"), "shard")
     .write.partitionBy("shard").option("lineSep", "\n").text(path))


def read_shards(spark: SparkSession, path: str, token_bytes: int = 2 * LENGTH, shard_records: int = SHARD_RECORDS,
                from_slot: int = 0, id_bytes: int = 2) -> DataFrame:
    """Read the records from ``from_slot`` on: ``slot, shard, doc_id, seq_no, n_tokens, tokens`` (without padding).

    Earlier shards are not opened (a partition filter). A task holds the files of its split.
    """
    stride = HEADER + token_bytes + 1
    files = (spark.read.format("binaryFile").load(path)
             .where(F.col("shard") >= F.lit(from_slot // shard_records)).select("shard", "content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(content.as_buffer(), np.uint8)
                records = data[: data.size // stride * stride].reshape(-1, stride)
                slot = shard * shard_records + np.arange(len(records))
                records, slot = records[slot >= from_slot], slot[slot >= from_slot]
                number = [np.ascontiguousarray(records[:, i:j]).view(kind).ravel() for i, j, kind in
                          ((0, 8, ">i8"), (8, 12, ">i4"), (12, 16, ">i4"))]
                tokens = [r[HEADER: HEADER + id_bytes * n].tobytes() for r, n in zip(records, number[2].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(np.full(slot.size, shard)), pa.array(number[0].astype(np.int64)),
                     pa.array(number[1].astype(np.int32)), pa.array(number[2].astype(np.int32)), pa.array(tokens, pa.binary())],
                    ["slot", "shard", "doc_id", "seq_no", "n_tokens", "tokens"])

    return (files.mapInArrow(run, "slot long, shard long, doc_id long, seq_no int, n_tokens int, tokens binary")
            .withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID))))
