"""Row filters of the loads."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.schemas import SEASON_START_MONTH


def valid_rows(df: DataFrame, required: list[str]) -> DataFrame:
    """rows whose natural key and name are present; the others are ignored silently."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required]))


def date_window(df: DataFrame, col: str, start: date, end: date) -> DataFrame:
    """inclusive date range (``start <= d <= end``); reaches the scan as two bounds."""
    return df.filter(F.col(col).between(F.lit(start), F.lit(end)))


def season_opening(today: date) -> date:
    """The last season opening that is not after ``today``."""
    opening = date(today.year, SEASON_START_MONTH, 1)
    return opening if opening <= today else opening.replace(year=opening.year - 1)


def default_game_window(today: date) -> tuple[date, date]:
    """games from the start of the active season to today."""
    return season_opening(today), today


def default_stats_window(today: date, days: int = 7) -> tuple[date, date]:
    """stats for the last ``days`` days up to today."""
    return today - timedelta(days=days), today
