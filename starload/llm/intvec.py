"""Integer vectors: sound rows of a table of embeddings, scaled and floored, and their Arrow batches as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sound(vec: str):
    """A vector that is not null and holds only finite components."""
    return F.col(vec).isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def integer_rows(table: DataFrame, scale: int, vec_id: str = "vec_id", embedding: str = "embedding",
                 label: str = "label") -> DataFrame:
    """``vec_id, label, vec``: every row with a sound vector, its components ``floor(scale * x)`` with x as double.

    Ids and labels may be null or repeat. A scaled component of 2**53 or more raises: past it
    products would no longer be exact.
    """
    rows = table.select(table[vec_id].cast("long").alias("vec_id"), table[label].cast("long").alias("label"),
                        table[embedding].cast("array<double>").alias("raw")).where(sound("raw"))

    def whole(x):
        y = x * F.lit(float(scale))
        far = F.raise_error(F.lit(f"a component times {scale} is beyond 2**53"))
        return F.when(F.abs(y) < float(2 ** 53), F.floor(y)).otherwise(far.cast("long")).cast("long")

    return rows.select("vec_id", "label", F.transform("raw", whole).alias("vec"))


def extent(vectors: DataFrame) -> tuple[int, int]:
    """The largest absolute component and the longest vector (0, 0 for no rows)."""
    most = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    row = vectors.agg(F.max(most), F.max(F.size("vec"))).first()
    return int(row[0] or 0), int(row[1] or 0)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of longs as a matrix of ``width`` columns, shorter ones filled with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if sizes.size and (sizes == width).all():
        return flat.reshape(sizes.size, width)
    out = np.zeros((sizes.size, width), dtype=np.int64)
    row = np.repeat(np.arange(sizes.size), sizes)
    out[row, np.arange(flat.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out
