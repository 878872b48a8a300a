"""Surrogate key assignment (K15): dense, unique, ascending from a base.

Rows are written once, range-sorted by the given order, as Parquet files in the shared scratch
folder. A row's number is then a property of those files: ``_metadata.row_index`` is its place in its
file, and the rows of the files before it (one count a file, files in the order of their
partitions) are added. Nothing is computed twice, and a task that is run again after a lost executor
reads the same files and gives the same keys. No step gathers the rows into one partition: only
the counts per file are ranked together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from starload.session import scratch


def current_max(df: DataFrame, key: str) -> int:
    """Largest existing key, 0 for an empty table (one aggregated scalar to the driver)."""
    value = df.agg(F.max(key)).first()[0]
    return int(value) if value is not None else 0


def _file_order() -> tuple[Column, Column]:
    """A written file's place: its partition's number, then its number within the partition."""
    name = F.col("__file")
    return tuple(F.regexp_extract(name, rf"part-(\d+)-.*-c(\d+)", i).cast("long") for i in (1, 2))


def write_sorted(df: DataFrame, order_by: list[str | Column], observed: Observation | None = None,
                 *metrics: Column) -> DataFrame:
    """``df`` written once in ``order_by`` order, with ``__file`` and ``__row`` of each row; ``observed`` gets ``metrics``."""
    spark = df.sparkSession
    path = scratch(spark).path("sorted")
    ordered = df.orderBy(*order_by)
    (ordered if observed is None else ordered.observe(observed, *metrics)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))


def number_rows(rows: DataFrame, key_col: str, base: int, key_type: str, counted: Column | None = None) -> DataFrame:
    """Number the rows of ``write_sorted`` from ``base + 1`` in their order into ``key_col``.

    ``counted`` names the rows that are numbered; they must come first in the order, so that a row's
    place in its file counts numbered rows only. The others keep their ``key_col``.
    """
    files = rows.groupBy("__file").agg((F.count(F.lit(1)) if counted is None else F.count_if(counted)).alias("__n"))
    before = Window.orderBy(*_file_order()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    key = (F.lit(base).cast("long") + F.col("__off") + F.col("__row") + F.lit(1)).cast(key_type)
    numbered = rows.join(F.broadcast(offsets), "__file")  # a row for each file
    if counted is not None:
        key = F.when(counted, key).otherwise(F.col(key_col))
    return numbered.withColumn(key_col, key).drop("__file", "__row", "__off")


def assign_surrogate_keys(df: DataFrame, key_col: str, order_by: list[str | Column], base: int = 0,
                          key_type: str = "long") -> DataFrame:
    """Number the rows ``base + 1 ..`` in ``order_by`` order into ``key_col``.

    Equal to ``base + row_number() over (order by ...)`` when the order is unique,
    but without the single-partition window.
    """
    numbered = number_rows(write_sorted(df, order_by), key_col, base, key_type)
    return numbered.select(key_col, *[c for c in df.columns if c != key_col])
