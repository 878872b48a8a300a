"""Key resolution joins (J3, J4), existence tests and anti joins.

No side is counted or hinted here: the planner broadcasts a side its statistics show to be
small, and AQE converts or splits joins at run time by the sizes it has seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions import expr as X


def resolve_key(df: DataFrame, dim: DataFrame, on: dict[str, str], key: str, as_: str | None = None,
                how: str = "inner", text: str = "binary") -> DataFrame:
    """Attach ``dim.key`` (renamed ``as_``) to ``df`` by natural key ``on = {df_col: dim_col}``.

    ``how='inner'`` drops unresolved rows silently (J3); ``how='left'`` keeps them
    with a NULL key (J4). ``text='host'`` compares text keys without case and trailing blanks.
    """
    out_name = as_ or key
    tmp = {c: f"__rk_{i}" for i, c in enumerate(on)}
    lookup = dim.select(*[F.col(d).alias(tmp[c]) for c, d in on.items()], F.col(key).alias(out_name))
    cond = [X.comparable(df, c, text) == X.comparable(lookup, tmp[c], text) for c in on]
    return df.join(lookup, cond, how).drop(*tmp.values())


def lookup_attrs(df: DataFrame, dim: DataFrame, on: dict[str, str], attrs: dict[str, str],
                 how: str = "inner") -> DataFrame:
    """Like ``resolve_key`` but attaches several dimension columns ``attrs = {out: dim_col}`` in one join."""
    tmp = {c: f"__la_{i}" for i, c in enumerate(on)}
    lookup = dim.select(*[F.col(d).alias(tmp[c]) for c, d in on.items()],
                        *[F.col(d).alias(o) for o, d in attrs.items()])
    return df.join(lookup, [df[c] == lookup[tmp[c]] for c in on], how).drop(*tmp.values())


def exists_in(df: DataFrame, other: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``df`` with a match in ``other`` (``left_semi``); the existence test of J3."""
    tmp = {c: f"__ex_{i}" for i, c in enumerate(on)}
    right = other.select(*[F.col(d).alias(tmp[c]) for c, d in on.items()])
    return df.join(right, [df[c] == right[tmp[c]] for c in on], "left_semi")


def missing_from(df: DataFrame, other: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``df`` without a match in ``other`` (``left_anti``); NOT EXISTS."""
    tmp = {c: f"__mi_{i}" for i, c in enumerate(on)}
    right = other.select(*[F.col(d).alias(tmp[c]) for c, d in on.items()])
    return df.join(right, [df[c] == right[tmp[c]] for c in on], "left_anti")
