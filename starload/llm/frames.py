"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starload.session import ensure_checkpoint_dir

#: Words of a text: maximal runs of bytes other than space, tab, LF, VT, FF and CR.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Rows of a few numbers that make one task's share.
TASK_ROWS = 50_000


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's source to the Python workers (as ``--py-files`` would), once per application."""
    sc = spark.sparkContext
    if not getattr(sc, "_starload_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="starload-src-"), "starload_src.zip")
        with zipfile.ZipFile(target, "w") as out:
            for folder, _, names in os.walk(root):
                for name in sorted(n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("starload", os.path.relpath(path, root)))
        sc.addPyFile(target)
        sc._starload_shipped = True
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again, so that the planner knows its size."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shares(amount: int, each: int) -> int:
    """Tasks that so much takes. ``coalesce`` to it between steps: a small table's tasks, shuffle files and checkpoint
    files then follow its size and not the square of the shuffle partitions; a table of more shares than
    partitions is left alone."""
    return max(1, -(-amount // each))


def crc_mod(column: str, mod: int):
    """crc32 of an id as text, modulo ``mod`` (the folds the contracts name)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(mod)


def word_count(text: str):
    """Number of words of a text column (runs of anything but the six ASCII blanks), 0 for null."""
    return F.coalesce(F.size(F.array_remove(F.split(F.col(text), WORD_GAP), "")), F.lit(0)).cast("long")


def spread(column: str):
    """A fixed pseudo-random place of an id in ``[0, 2**60)``, the same in any SQL engine that has md5."""
    return F.conv(F.substring(F.md5(F.col(column).cast("string")), 1, 15), 16, 10).cast("long")


def prefix_sums(df: DataFrame, group: str, order: str, value: str, name: str, block_rows: int = 4096) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same ``group`` that come earlier.

    Rows are ordered by ``spread(order)``, ``order``, ``value``. Two levels keep a hot group
    out of one task: a group is dealt into ranges of places of about ``block_rows`` rows,
    sums per range are ranked (one row per range), and only the rows of one range meet in
    a window. ``df`` is read three times: cut its lineage first if it is dear.
    """
    blocks = max(1, -(-df.count() // block_rows))
    keyed = df.withColumn("__place", F.coalesce(spread(order), F.lit(0))).withColumn(
        "__block", F.floor(F.col("__place") / F.lit(2 ** 60 // blocks + 1)).cast("long"))
    sums = keyed.groupBy(group, "__block").agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.col(group).alias("__g"), F.col("__block").alias("__b"),
                        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    inner = (Window.partitionBy(group, "__block").orderBy("__place", order, value)
             .rowsBetween(Window.unboundedPreceding, -1))
    return (keyed.join(bases, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__block") == F.col("__b")))
            .withColumn(name, F.col("__base") + F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .drop("__g", "__b", "__base", "__place", "__block"))


def binary_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string or binary column as large binary, nulls as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    return col.cast(pa.large_binary() if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type)
                    else pa.large_string()).cast(pa.large_binary()).fill_null(b"")
