"""Deletes expressed as the rows to keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from starload.operators.joins import missing_from


def delete_by_join(rows: DataFrame, selected: DataFrame, on: dict[str, str]) -> DataFrame:
    """``rows`` minus those joined to ``selected`` (DELETE .. FROM .. JOIN)."""
    return missing_from(rows, selected, on)


def guarded_delete(parents: DataFrame, key: str, candidate: Column,
                   guards: list[tuple[DataFrame, str]]) -> DataFrame:
    """Remove candidate parents that no child refers to; returns the rows kept.

    ``guards`` is a list of ``(child, child_column)``. A guard with ``a = k OR b = k``
    is given as two guards, so each is an equi anti join rather than a nested loop.
    """
    deletable = parents.filter(candidate).select(key)
    for child, col in guards:
        deletable = missing_from(deletable, child, {key: col})
    return missing_from(parents, deletable, {key: key})
