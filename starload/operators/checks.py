"""Key and reference checks run before a table version is published.

All are aggregations with partial (map-side) combine, so a hot key is reduced to
one row per map partition before any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions import expr as X
from starload.operators.joins import missing_from


def duplicate_keys(df: DataFrame, keys: list[str], count_col: str = "n", text: str = "binary") -> DataFrame:
    """Keys present more than once, with their counts (GROUP BY .. HAVING COUNT(*) > 1).

    ``text='host'`` takes texts that differ in case or trailing blanks as one key; its smallest form is returned.
    """
    n = F.count(F.lit(1)).alias(count_col)
    if text == "binary":
        return df.groupBy(*keys).agg(n).filter(F.col(count_col) > 1)
    grouped = df.groupBy(*[X.comparable(df, c, text).alias(f"__k{i}") for i, c in enumerate(keys)])
    return grouped.agg(*[F.min(c).alias(c) for c in keys], n).filter(F.col(count_col) > 1).select(*keys, count_col)


def duplicate_key_count(df: DataFrame, keys: list[str], out: str = "duplicate_count") -> DataFrame:
    """Number of keys present more than once (one row)."""
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias(out))


def fk_violations(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Child rows whose non-null reference has no parent row."""
    nonnull = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    return missing_from(child.filter(nonnull), parent, on)


def reference_violations(tables: dict[str, DataFrame], references) -> DataFrame:
    """C3 for several references: (child_table, column_name, violations), one row per reference.

    ``references`` holds (child table, column, parent table, parent key); a NULL reference is no violation.
    Each child is read once: its reference columns are unpivoted, counted per value, and met with the stacked keys
    of all parents in one anti join. Keys are integers (K15).
    """
    spark = next(iter(tables.values())).sparkSession
    used = []
    for child in dict.fromkeys(r[0] for r in references):
        refs = [F.struct(F.lit(child).alias("child_table"), F.lit(column).alias("column_name"),
                         F.lit(f"{parent}.{key}").alias("parent"), F.col(column).cast("long").alias("value"))
                for c, column, parent, key in references if c == child]
        used.append(tables[child].select(F.inline(F.array(*refs))).filter(F.col("value").isNotNull())
                    .groupBy("child_table", "column_name", "parent", "value").agg(F.count(F.lit(1)).alias("violations")))
    known = [tables[parent].select(F.lit(f"{parent}.{key}").alias("parent"), F.col(key).cast("long").alias("value"))
             for parent, key in dict.fromkeys(r[2:] for r in references)]
    broken = missing_from(reduce(DataFrame.unionByName, used), reduce(DataFrame.unionByName, known),
                          {"parent": "parent", "value": "value"})
    none = spark.createDataFrame([(child, column, 0) for child, column, _, _ in references],
                                 "child_table string, column_name string, violations long")
    return (broken.select(none.columns).unionByName(none).groupBy("child_table", "column_name")
            .agg(F.sum("violations").alias("violations")))


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """C4: (column_name, null_count) for each column, from one aggregation pass."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, null_count)")


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """(column_name, length_limit, max_length, violations) for each limited text column."""
    aggs = []
    for c, n in limits.items():
        aggs += [F.max(F.length(c)).alias(f"{c}__max"), F.count_if(F.length(c) > n).alias(f"{c}__bad")]
    agg = df.agg(*aggs)
    rows = ", ".join(f"'{c}', {n}, `{c}__max`, `{c}__bad`" for c, n in limits.items())
    return agg.selectExpr(f"stack({len(limits)}, {rows}) as (column_name, length_limit, max_length, violations)")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def date_range(df: DataFrame, col: str, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Min and max of a date column, NULLs excluded (one row)."""
    return df.filter(F.col(col).isNotNull()).agg(F.min(col).alias(start), F.max(col).alias(end))


def latest_batch(df: DataFrame, batch_col: str, ts_col: str, out: str = "batch_id") -> DataFrame:
    """The batch with the latest ``max(ts)``, ties to the smallest id (top 1)."""
    return (df.groupBy(batch_col).agg(F.max(ts_col).alias("__last"))
            .orderBy(F.col("__last").desc(), F.col(batch_col).asc()).limit(1)
            .select(F.col(batch_col).alias(out)))


@dataclass
class LoadResult:
    """Outcome of one source load."""
    load_batch_id: str
    staged: int
    rows_before: int
    rows_after: int
    inserted: int
    updated: int
    duplicates: int

    @property
    def ok(self) -> bool:
        return self.duplicates == 0
