"""Scalar rules of the warehouse as Column expressions.

All are compositions of built-in functions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.schemas import ERROR_MESSAGE_LIMIT, GAME_IDS_PER_SEASON, SEASON_START_MONTH

__all__ = [
    "timestamp_literal",
    "isnull_typed", "nullif_blank", "concat_name", "full_name_or_parts", "localized_text", "variant_int",
    "to_int", "toi_to_seconds", "to_date_prefix", "date_key", "date_parts", "month_name", "day_name",
    "is_weekend", "next_day", "winner_label", "points", "truncate_message", "normalize_code",
    "season_start_year", "season_start", "is_object",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def timestamp_literal(value) -> Column:
    """A wall-clock time as a ``TIMESTAMP_NTZ`` literal, independent of the session time zone."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def isnull_typed(a, b, max_length: int | None = None) -> Column:
    """First non-null of ``a`` and ``b``, typed as ``a`` (text cut to ``a``'s length)."""
    out = F.coalesce(_c(a), _c(b))
    return F.substring(out, 1, max_length) if max_length else out


def nullif_blank(x) -> Column:
    """S3: NULL when the text is empty once trailing blanks are ignored, else the text unchanged."""
    x = _c(x)
    return F.when(F.rtrim(x) != F.lit(""), x)


def concat_name(first, last) -> Column:
    """Trimmed ``first + ' ' + last`` where NULL parts count as empty; never NULL."""
    return F.trim(F.concat(F.coalesce(_c(first), F.lit("")), F.lit(" "), F.coalesce(_c(last), F.lit(""))))


def full_name_or_parts(full, first, last, max_length: int = 200) -> Column:
    """Dimension full name: the staged full name unless blank, else the trimmed parts (S1+S3+S4)."""
    return isnull_typed(nullif_blank(full), concat_name(first, last), max_length)


def is_object(v) -> Column:
    """True when a variant holds a JSON object.

    Tested as "casts to an empty struct": constant work per value, where
    ``schema_of_variant`` would walk and render the whole value.
    """
    return F.try_variant_get(_c(v), "$", "struct<>").isNotNull()


def localized_text(v) -> Column:
    """An object yields its ``default`` member as text, a scalar its text, null stays null."""
    v = _c(v)
    return F.when(is_object(v), F.try_variant_get(v, "$.default", "string")).otherwise(
        F.try_variant_get(v, "$", "string"))


def variant_int(v, path: str = "$") -> Column:
    """Integer at ``path`` of a variant; a value that does not parse as an int gives NULL."""
    return F.try_variant_get(_c(v), path, "int")


def to_int(x) -> Column:
    """S6 for text: '' and NULL give NULL, unparseable text gives NULL."""
    return _c(x).try_cast("int")


def toi_to_seconds(x) -> Column:
    """S7: 'MM:SS' to seconds; anything but exactly two numeric parts gives NULL."""
    x = _c(x)
    colons = F.length(x) - F.length(F.replace(x, F.lit(":"), F.lit("")))
    return F.when(colons == 1, F.substring_index(x, ":", 1).try_cast("int") * 60
                  + F.substring_index(x, ":", -1).try_cast("int"))


def to_date_prefix(x, lenient: bool = False) -> Column:
    """Date from the first ten characters of ISO date or datetime text; '' gives NULL.

    Malformed text raises (ANSI), as the reference does; ``lenient`` gives NULL instead.
    """
    x = _c(x)
    head = F.substring(x, 1, 10)
    parsed = F.try_to_date(head, F.lit("yyyy-MM-dd")) if lenient else F.to_date(head, "yyyy-MM-dd")
    return F.when(x != F.lit(""), parsed)


def date_key(d) -> Column:
    """Integer ``yyyymmdd`` key of a date."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_parts(d) -> dict[str, Column]:
    """Calendar parts; weekday number has Sunday = 1."""
    d = _c(d)
    return {
        "calendar_year": F.year(d).cast("int"),
        "calendar_quarter": F.quarter(d).cast("int"),
        "calendar_month": F.month(d).cast("int"),
        "day_of_month": F.dayofmonth(d).cast("int"),
        "day_of_week": F.dayofweek(d).cast("int"),
    }


def month_name(d) -> Column:
    """English month name."""
    return F.date_format(_c(d), "MMMM")


def day_name(d) -> Column:
    """English weekday name."""
    return F.date_format(_c(d), "EEEE")


def is_weekend(d) -> Column:
    """Saturday or Sunday (by weekday number, so locale-proof)."""
    return F.dayofweek(_c(d)).isin(1, 7)


def next_day(d, days: int = 1) -> Column:
    """Date plus ``days`` days."""
    return F.date_add(_c(d), days)


def winner_label(home_goals, away_goals, home_name, away_name, tie: str = "Tie") -> Column:
    """The winning side's name; equal or NULL scores give 'Tie'."""
    h, a = _c(home_goals), _c(away_goals)
    return F.when(h > a, _c(home_name)).when(a > h, _c(away_name)).otherwise(F.lit(tie))


def points(goals, assists) -> Column:
    """Stored points = goals + assists."""
    return _c(goals) + _c(assists)


def truncate_message(m, limit: int = ERROR_MESSAGE_LIMIT) -> Column:
    """Message cut to ``limit`` characters."""
    return F.substring(_c(m), 1, limit)


def normalize_code(c) -> Column:
    """Trimmed, upper-cased code."""
    return F.upper(F.trim(_c(c)))


def host_text(c) -> Column:
    """Text that compares as on the reference's host: case and trailing blanks do not count (a Spark collation)."""
    return F.collate(_c(c), "UTF8_LCASE_RTRIM")


def comparable(df: DataFrame, c: str, text: str) -> Column:
    """Column ``c`` as a join, group or duplicate key: text in the host's comparison if ``text`` is ``'host'``."""
    if text not in ("binary", "host"):
        raise ValueError("text must be 'binary' or 'host'")
    return host_text(df[c]) if text == "host" and dict(df.dtypes)[c] == "string" else df[c]


def season_start_year(d) -> Column:
    """The season of a date starts in September of this year, else of the previous year."""
    d = _c(d)
    return (F.year(d) - F.when(F.month(d) < SEASON_START_MONTH, 1).otherwise(0)).cast("int")


def season_start(d) -> Column:
    """First day of the season containing ``d``."""
    return F.make_date(season_start_year(d), F.lit(SEASON_START_MONTH), F.lit(1))


def id_season(game_id) -> Column:
    """The season a game id opens with (``2024020001`` -> 2024), the partition of both facts.

    A function of the natural key alone, so that a game never changes its partition, whatever
    season its payload names.
    """
    return F.call_function("div", _c(game_id).cast("long"), F.lit(GAME_IDS_PER_SEASON))
