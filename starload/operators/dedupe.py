"""Keep one row per key (R5 first occurrence wins, P6 last occurrence wins).

``row_number() = 1`` over ``partitionBy(keys)``: Spark plans a partial
``WindowGroupLimit`` before the shuffle, so a hot key is cut to one row per map
partition before it is exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.functions import expr as X


def dedupe(df: DataFrame, keys: list[str], order: list[str | Column], keep: str = "last",
           text: str = "binary") -> DataFrame:
    """One row per ``keys``: the highest ``order`` (``keep='last'``) or the lowest (``'first'``).

    ``text='host'`` takes texts that differ in case or trailing blanks as one key.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    cols = [c.desc() if keep == "last" else c.asc() for c in cols]
    w = Window.partitionBy(*[X.comparable(df, k, text) for k in keys]).orderBy(*cols)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
