"""Dimension and fact loads as DataFrame functions.

Nothing is updated in place: each load returns the new version of the target
(kept + updated + inserted rows) or the rows to append, and the store writes it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from starload.functions import expr as X
from starload.operators.dedupe import dedupe
from starload.operators.joins import exists_in, missing_from, resolve_key
from starload.operators.keys import assign_surrogate_keys, current_max, number_rows, write_sorted
from starload.schemas import CALENDAR_ERROR


class LoadError(RuntimeError):
    """A load broke a rule the host would enforce (unique key, calendar range, ...)."""


def change_predicate(compare: dict[str, object], t: str = "__t_", s: str = "__s_",
                     active: str | None = "is_active", text_compare: str = "binary") -> Column:
    """OR over ``ISNULL(t.c, sentinel) <> ISNULL(s.c, sentinel)``, plus "target inactive".

    A sentinel of ``None`` compares the columns as they are (NULL is never a change).
    NULL and the sentinel are equal on purpose: NULL -> '' is not a change.
    ``text_compare='ci_rtrim'`` compares text columns (those with a text sentinel) ignoring
    case and trailing blanks, as a case-insensitive host collation would; the default is binary.
    """
    if text_compare not in ("binary", "ci_rtrim"):
        raise ValueError("text_compare must be 'binary' or 'ci_rtrim'")
    terms = []
    for c, sentinel in compare.items():
        tc, sc = F.col(t + c), F.col(s + c)
        if text_compare == "ci_rtrim" and isinstance(sentinel, str):
            tc, sc = F.lower(F.rtrim(tc)), F.lower(F.rtrim(sc))
        if sentinel is None:
            terms.append(tc != sc)
        else:
            terms.append(F.coalesce(tc, F.lit(sentinel)) != F.coalesce(sc, F.lit(sentinel)))
    if active:
        terms.append(~F.col(t + active))
    return reduce(lambda a, b: a | b, terms)


def changed_rows(target: DataFrame, source: DataFrame, *, key: str, compare: dict[str, object],
                 order: list[str] | None = None, active: str = "is_active", text_compare: str = "binary") -> DataFrame:
    """Target keys that a source row changes (F2 over the inner join on ``key``), with the new values.

    When several source rows change one key, the last in ``order`` wins (H4); without an
    ``order`` the highest source values win.
    Columns: ``key``, ``__s_<attr>`` for each compared attribute.
    """
    attrs = list(compare)
    t = target.select(key, *[F.col(c).alias("__t_" + c) for c in attrs], F.col(active).alias("__t_" + active))
    order_cols = order or []
    s = source.select(key, *[F.col(c).alias("__s_" + c) for c in attrs], *order_cols)
    changed = t.join(s, key).filter(change_predicate(compare, active=active, text_compare=text_compare))
    # one row per key, so the update never multiplies a target row; without an order the
    # source values themselves break the tie (deterministic, unlike the host's arbitrary pick)
    changed = dedupe(changed, [key], order_cols or ["__s_" + c for c in attrs], keep="last")
    return changed.select(key, *[F.col("__s_" + c) for c in attrs])


@dataclass
class UpsertResult:
    frame: DataFrame      # new version of the target
    inserted: DataFrame   # rows inserted (with surrogate keys)
    changed: DataFrame    # natural keys of updated rows
    rows_inserted: int    # counted as the rows were written
    rows_updated: int


NEW, UPDATED, KEPT = 0, 1, 2


def classify_type1(target: DataFrame, source: DataFrame, *, key: str, compare: dict[str, object], surrogate: str,
                   load_ts: datetime | None, order: list[str] | None, active: str, created: str | None,
                   modified: str | None, text_compare: str) -> DataFrame:
    """One row per key of either side, in the target's columns, with ``__state`` (new, updated or kept).

    One full outer join on the key. Of the source rows that meet one target row the last changing
    one counts; ``__times`` is the number of source rows of a new key. New rows have no surrogate key yet.
    """
    ts = X.timestamp_literal(load_ts)
    staged = [c for c in target.columns if c in source.columns and c not in (key, surrogate)]
    order_cols = order or ["__s_" + c for c in compare]
    t = target.select(*[F.col(c).alias("__t_" + c) for c in target.columns], F.lit(True).alias("__old"))
    s = source.select(F.col(key).alias("__key"), *[F.col(c).alias("__s_" + c) for c in staged],
                      *[F.col(c) for c in order or []], F.lit(True).alias("__staged"))
    both = t.join(s, F.col("__t_" + key) == F.col("__key"), "full_outer")
    old, staged_here = F.col("__old").isNotNull(), F.col("__staged").isNotNull()
    changes = change_predicate(compare, active=active, text_compare=text_compare)
    both = both.withColumn("__key", F.coalesce("__t_" + key, "__key")).withColumn(
        "__state", F.when(~old, NEW).when(staged_here & changes, UPDATED).otherwise(KEPT))
    # the surrogate key keeps target rows apart, should the target repeat a key
    one = Window.partitionBy("__key", "__t_" + surrogate)
    pick = one.orderBy("__state", *[F.col(c).desc() for c in order_cols])
    both = both.select("*", F.row_number().over(pick).alias("__nth"), F.count("__staged").over(one).alias("__times"))
    both = both.filter((F.col("__nth") == 1) | F.col("__key").isNull())

    is_new, is_updated = F.col("__state") == NEW, F.col("__state") == UPDATED
    cols = []
    for c, dtype in target.dtypes:
        value = F.col("__t_" + c)
        if c == key:
            value = F.col("__key")
        elif c in compare:
            value = F.when(is_new | is_updated, F.col("__s_" + c).cast(dtype)).otherwise(value)
        elif c in staged:
            value = F.when(is_new, F.col("__s_" + c).cast(dtype)).otherwise(value)
        elif c == active:
            value = F.when(is_new | is_updated, F.lit(True)).otherwise(value)
        elif c == modified:
            value = F.when(is_updated, ts).otherwise(value)
        elif c == created:
            value = F.when(is_new, ts).otherwise(value)
        cols.append(value.cast(dtype).alias(c))
    return both.select(*cols, "__state", "__times")


def upsert_type1(target: DataFrame, source: DataFrame, *, key: str, compare: dict[str, object],
                 surrogate: str, load_ts: datetime | None = None, order: list[str] | None = None,
                 active: str = "is_active", created: str | None = "created_date",
                 modified: str | None = "modified_date", check_unique: bool = True,
                 text_compare: str = "binary") -> UpsertResult:
    """Type-1 upsert of ``source`` into ``target`` on natural key ``key`` (K3, K4).

    * updated: target rows whose key is in ``source`` and for which F2 holds get the
      source attributes, ``active = true`` and ``modified = load_ts``. When several
      source rows change the same key, the one last in ``order`` wins.
    * inserted: source rows whose key is absent from the target, numbered from the
      current largest surrogate key; a key twice among them raises ``LoadError``.
    ``source`` must already hold only valid rows (F1).

    Both sides are read once: the classified rows are written in one pass, new ones first, which also
    counts them, finds repeated new keys and the largest surrogate key; numbering reads what was written.
    """
    rows = classify_type1(target, source, key=key, compare=compare, surrogate=surrogate, load_ts=load_ts, order=order,
                          active=active, created=created, modified=modified, text_compare=text_compare)
    seen = Observation()
    is_new = F.col("__state") == NEW
    written = write_sorted(rows, [F.col("__state") != NEW, key], seen, F.count_if(is_new).alias("inserted"),
                           F.count_if(F.col("__state") == UPDATED).alias("updated"),
                           F.count_if(is_new & (F.col("__times") > 1)).alias("repeated"), F.max(surrogate).alias("top"))
    counts = seen.get
    if check_unique and counts["repeated"]:
        raise LoadError(f"duplicate key {key} in the new rows")
    numbered = number_rows(written, surrogate, counts["top"] or 0, dict(target.dtypes)[surrogate], counted=is_new)
    return UpsertResult(numbered.select(*target.columns), numbered.filter(is_new).select(*target.columns),
                        numbered.filter(F.col("__state") == UPDATED).select(key), counts["inserted"], counts["updated"])


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str] | dict[str, str]) -> DataFrame:
    """Source rows with no target row on ``keys`` (NOT EXISTS), ready to append."""
    on = keys if isinstance(keys, dict) else {k: k for k in keys}
    return missing_from(source, target, on)


# ---- facts (K6, K7, S15, K14) ---------------------------------------------------------------

def history_for(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The part of a (large) fact history that a batch can collide with.

    A semi join with the batch's distinct keys; the planner and AQE broadcast them when
    they are few, so the history is then not shuffled. A load hands in only the history's partitions
    that can hold the batch's keys (``id_seasons``).
    """
    return existing.join(batch.select(*keys).distinct(), keys, "left_semi")


def id_seasons(batch: DataFrame, game_id: str = "game_id") -> list[int]:
    """The fact partitions that hold a batch's games: one value a season, from a partial aggregate."""
    found = batch.select(X.id_season(game_id).alias("id_season")).filter(F.col("id_season").isNotNull()).distinct()
    return sorted(r.id_season for r in found.collect())


GAME_MEASURES = ("home_goals", "away_goals", "home_shots", "away_shots")
STAT_MEASURES = ("goals", "assists", "shots", "hits", "blocks", "penalty_minutes")


def load_game_fact(staged: DataFrame, teams: DataFrame, dates: DataFrame, existing: DataFrame, *,
                   load_ts: datetime | None = None, base: int | None = None) -> DataFrame:
    """K6: new game fact rows from staged games (insert-only).

    Home and away team keys are resolved by inner joins (unresolved games vanish,
    J3), the game date must exist in the calendar (semi join; the key itself is
    recomputed, S9), games already in the fact are skipped (J5), and new rows are
    numbered from the fact's largest key (K15).
    """
    g = staged.filter(F.col("game_id").isNotNull())
    history = history_for(existing, g, ["game_id"])  # keyed by the staged ids: a superset of those inserted
    g = resolve_key(g, teams, {"home_team_id": "team_id"}, "team_key", "home_team_key")
    g = resolve_key(g, teams, {"away_team_id": "team_id"}, "team_key", "away_team_key")
    g = exists_in(g, dates, {"game_date": "full_date"})
    g = missing_from(g, history, {"game_id": "game_id"})
    g = g.select("game_id", X.date_key("game_date").alias("date_key"), "season", "game_type", "home_team_key",
                 "away_team_key", *GAME_MEASURES)
    base = current_max(existing, "game_key") if base is None else base
    out = assign_surrogate_keys(g, "game_key", ["game_id"], base=base, key_type="long")
    if load_ts is not None:
        out = out.withColumn("created_date", X.timestamp_literal(load_ts))
    return out


def load_stats_fact(staged: DataFrame, games: DataFrame, players: DataFrame, teams: DataFrame,
                    existing: DataFrame | None = None, *, load_ts: datetime | None = None,
                    base: int | None = None, with_season: bool = False) -> DataFrame:
    """K7: new player-game stats fact rows (insert-only); ``with_season`` adds the partition they belong to.

    Game, player and team keys are resolved by inner joins (J3); rows already in
    the fact on (game, player, team) are skipped (J6); NULL measures become 0
    except ice time (S1); points = goals + assists (S15); keys follow K15.
    """
    if existing is not None:  # the batch's games, from the staged ids alone
        batch_games = exists_in(games.select("game_id", "game_key"), staged, {"game_id": "game_id"})
        history = history_for(existing, batch_games, ["game_key"])
    s = resolve_key(staged, games, {"game_id": "game_id"}, "game_key")
    s = resolve_key(s, players, {"player_id": "player_id"}, "player_key")
    s = resolve_key(s, teams, {"team_id": "team_id"}, "team_key")
    keys = ["game_key", "player_key", "team_key"]
    if existing is not None:
        s = missing_from(s, history, {k: k for k in keys})
    zero = {c: X.isnull_typed(c, F.lit(0)) for c in STAT_MEASURES}
    season = [X.id_season("game_id").alias("id_season")] if with_season else []
    s = s.select(*keys, *[zero[c].alias(c) for c in STAT_MEASURES],
                 X.points(zero["goals"], zero["assists"]).alias("points"), "time_on_ice_seconds", *season)
    if base is None:
        base = current_max(existing, "player_game_stats_key") if existing is not None else 0
    out = assign_surrogate_keys(s, "player_game_stats_key", keys, base=base, key_type="long")
    out = out.select("player_game_stats_key", *keys, "goals", "assists", "points", "shots", "hits", "blocks",
                     "penalty_minutes", "time_on_ice_seconds", *(["id_season"] if with_season else []))
    if load_ts is not None:
        out = out.withColumn("created_date", X.timestamp_literal(load_ts))
    return out


# ---- calendar (K5, U2, S9-S13) -----------------------------------------------------------

def calendar_rows(dates: DataFrame, date_col: str = "full_date") -> DataFrame:
    """Calendar dimension rows for a column of dates."""
    d = F.col(date_col)
    parts = X.date_parts(d)
    return dates.select(
        X.date_key(d).alias("date_key"), d.alias("full_date"), parts["calendar_year"].alias("calendar_year"),
        parts["calendar_quarter"].alias("calendar_quarter"), parts["calendar_month"].alias("calendar_month"),
        X.month_name(d).alias("month_name"), parts["day_of_month"].alias("day_of_month"),
        parts["day_of_week"].alias("day_of_week"), X.day_name(d).alias("day_name"),
        X.is_weekend(d).alias("is_weekend"))


def dates_between(bounds: DataFrame, start: str = "start_date", end: str = "end_date",
                  out: str = "full_date") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive, per bounds row.

    A NULL bound or ``start > end`` raises the calendar error, as the host does.
    """
    s, e = F.col(start), F.col(end)
    checked = F.when(s.isNull() | e.isNull() | (s > e), F.raise_error(F.lit(CALENDAR_ERROR)))
    return (bounds.select(F.coalesce(checked.cast("date"), s).alias("__s"), e.alias("__e"))
            .select(F.explode(F.sequence(F.col("__s"), F.col("__e"), F.expr("interval 1 day"))).alias(out)))


def populate_calendar(spark: SparkSession, start: date | None, end: date | None,
                      existing: DataFrame | None = None) -> DataFrame:
    """K5: calendar rows from ``start`` to ``end`` inclusive that ``existing`` lacks."""
    if start is None or end is None or start > end:
        raise LoadError(CALENDAR_ERROR)
    bounds = spark.range(1).select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"))
    rows = calendar_rows(dates_between(bounds))
    return rows if existing is None else missing_from(rows, existing, {"full_date": "full_date"})


def calendar_for_range(bounds: DataFrame, existing: DataFrame | None = None, start: str = "start_date",
                       end: str = "end_date") -> DataFrame:
    """K5 with the range taken lazily from a one-row DataFrame (e.g. the staged date range, A7)."""
    rows = calendar_rows(dates_between(bounds, start, end))
    return rows if existing is None else missing_from(rows, existing, {"full_date": "full_date"})
