"""The source text of JSON array elements, exactly as it was written (P5).

Spark's parsers read values: ``1.50`` becomes ``1.5``, keys are sorted, escapes and blanks are gone. An
element's own text has to be cut out of its document, which no built-in function does, so this is
an Arrow-batched UDF: each document is walked once, values that are not asked for are skipped by the
standard library's C scanner.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_value = json.JSONDecoder(strict=False).scan_once
_blank = re.compile(r"[ \t\n\r]*").match


def _skip(text: str, at: int) -> int:
    return _blank(text, at).end()


def members(text: str, at: int) -> Iterator[tuple[str, int, int]]:
    """(key, start, end) of the members of the object that opens at ``at``."""
    at = _skip(text, at + 1)
    while text[at] != "}":
        key, at = _value(text, at)
        start = _skip(text, _skip(text, at) + 1)  # past the colon
        end = _value(text, start)[1]
        yield key, start, end
        at = _skip(text, end)
        if text[at] == ",":
            at = _skip(text, at + 1)


def elements(text: str, at: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the elements of the array that opens at ``at``."""
    at = _skip(text, at + 1)
    while text[at] != "]":
        end = _value(text, at)[1]
        yield at, end
        at = _skip(text, end)
        if text[at] == ",":
            at = _skip(text, at + 1)


def array_texts(text: str, path: tuple[str, ...]) -> list[str] | None:
    """The texts of the elements of the array at ``path``; None if there is no array."""
    at = _skip(text, 0)
    for key in path:
        at = next((s for k, s, _ in members(text, at) if k == key), None) if text[at] == "{" else None
        if at is None:
            return None
    return [text[s:e] for s, e in elements(text, at)] if text[at] == "[" else None


def element_texts(raw: str | Column, paths: list[tuple[str, ...]]) -> Column:
    """For each of ``paths``, the texts of the array's elements (null if there is none): ``array<array<string>>``.

    A null document gives null. Documents must be valid JSON (``parse_envelope`` fails on others first).
    """
    @F.pandas_udf("array<array<string>>")
    def cut(docs: pd.Series) -> pd.Series:
        return pd.Series([None if doc is None else [array_texts(doc, p) for p in paths] for doc in docs], dtype=object)

    return cut(raw)
