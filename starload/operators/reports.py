"""Reporting views: role-playing star joins and season summaries.

Each view is a function over DataFrames whose key columns are parameters, so it
runs on the warehouse tables (surrogate keys) as well as on any mapped tables.
Output columns carry the business names of the reference's views.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions import expr as X
from starload.operators.joins import lookup_attrs, resolve_key


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unpivot_roles(df: DataFrame, keep: list[str], roles: list[dict[str, str | Column]]) -> DataFrame:
    """One output row per role per input row (UNION ALL of the roles, in one scan).

    ``roles`` maps output column -> input column for each role; all roles must map
    the same output names to columns of the same types.
    """
    structs = [F.struct(*[_c(src).alias(out) for out, src in role.items()]) for role in roles]
    return df.select(*keep, F.inline(F.array(*structs)))


def team_games(games: DataFrame, *, season="season", home="home_team_key", away="away_team_key",
               team_col="team_key", home_goals="home_goals", away_goals="away_goals",
               home_shots="home_shots", away_shots="away_shots") -> DataFrame:
    """Games seen from each side: (season, team, goals/shots for/against)."""
    return unpivot_roles(games, [season], [
        {team_col: home, "goals_for": home_goals, "goals_against": away_goals,
         "shots_for": home_shots, "shots_against": away_shots},
        {team_col: away, "goals_for": away_goals, "goals_against": home_goals,
         "shots_for": away_shots, "shots_against": home_shots},
    ])


_TEAM_SUMS = [("Goals For", "goals_for"), ("Goals Against", "goals_against"),
              ("Shots For", "shots_for"), ("Shots Against", "shots_against")]


def team_season_summary(games: DataFrame, teams: DataFrame, *, season="season", home="home_team_key",
                        away="away_team_key", team_key="team_key", team_name="team_name",
                        home_goals="home_goals", away_goals="away_goals", home_shots="home_shots",
                        away_shots="away_shots", text: str = "binary") -> DataFrame:
    """A1: per (season, team name): games, wins, losses, goals and shots for/against.

    NULL scores count as 0 goals but still as a game; ties count neither way; equal
    team names merge (``text='host'``: whatever their case and trailing blanks; the smallest form is shown). Games are aggregated per team key before the join, so the
    fact is never shuffled for it and only one row per season and team is joined.
    """
    tg = team_games(games, season=season, home=home, away=away, team_col="__team", home_goals=home_goals,
                    away_goals=away_goals, home_shots=home_shots, away_shots=away_shots)
    tg = tg.select(F.col(season).alias("__season"), "__team", "goals_for", "goals_against", "shots_for",
                   "shots_against",
                   F.when(F.col("goals_for") > F.col("goals_against"), 1).otherwise(0).alias("win"),
                   F.when(F.col("goals_for") < F.col("goals_against"), 1).otherwise(0).alias("loss"))
    dim = teams.select(F.col(team_key).alias("__team"), F.col(team_name).alias("__name"))
    pre = tg.groupBy("__season", "__team").agg(
        F.count(F.lit(1)).alias("g"), F.sum("win").alias("w"), F.sum("loss").alias("l"),
        *[F.sum(F.coalesce(F.col(src), F.lit(0))).alias(src) for _, src in _TEAM_SUMS])
    named = pre.join(dim, "__team")
    out = named.groupBy("__season", X.comparable(named, "__name", text).alias("__same")).agg(
        F.min("__name").alias("__name"),
        F.sum("g").cast("long").alias("Games Played"), F.sum("w").cast("long").alias("Wins"),
        F.sum("l").cast("long").alias("Losses"),
        *[F.sum(src).cast("long").alias(name) for name, src in _TEAM_SUMS])
    return out.select(F.col("__season").alias("Season"), F.col("__name").alias("Team"), "Games Played", "Wins",
                      "Losses", *[name for name, _ in _TEAM_SUMS])


def _game_date(games: DataFrame, dates: DataFrame | None, date_key: str, game_date: str) -> DataFrame:
    """Attach ``__game_date``: from the calendar by date key, or straight from the games."""
    if dates is None:
        return games.withColumn("__game_date", F.col(game_date))
    return resolve_key(games, dates, {date_key: "date_key"}, "full_date", "__game_date")


def team_game_results(games: DataFrame, teams: DataFrame, dates: DataFrame | None = None, *,
                      home="home_team_key", away="away_team_key", team_key="team_key", team_name="team_name",
                      date_key="date_key", game_date="game_date") -> DataFrame:
    """J2 + S14: each game with both team names (team dimension in two roles) and the winner."""
    g = _game_date(games, dates, date_key, game_date)
    g = resolve_key(g, teams, {home: team_key}, team_name, "__home")
    g = resolve_key(g, teams, {away: team_key}, team_name, "__away")
    return g.select(
        F.col("game_id").alias("Game ID"), F.col("__game_date").alias("Game Date"), F.col("season").alias("Season"),
        F.col("game_type").alias("Game Type"), F.col("__home").alias("Home Team"),
        F.col("__away").alias("Away Team"), F.col("home_goals").alias("Home Goals"),
        F.col("away_goals").alias("Away Goals"), F.col("home_shots").alias("Home Shots"),
        F.col("away_shots").alias("Away Shots"),
        X.winner_label("home_goals", "away_goals", "__home", "__away").alias("Winning Team"))


_STAT_COLS = [("Goals", "goals"), ("Assists", "assists"), ("Points", "points"), ("Shots", "shots"),
              ("Hits", "hits"), ("Blocks", "blocks"), ("Penalty Minutes", "penalty_minutes")]


def _star(stats: DataFrame, games: DataFrame, players: DataFrame, teams: DataFrame, dates: DataFrame | None,
          game_key: str, player_key: str, team_key: str, date_key: str, game_date: str) -> DataFrame:
    """Stats fact joined to game, (date), player and team."""
    g = _game_date(games, dates, date_key, game_date).select(
        F.col(game_key).alias("__gk"), F.col("game_id").alias("__game_id"), "__game_date",
        F.col("season").alias("__season"))
    # the planner broadcasts the games when they are few; otherwise AQE splits a hot game
    s = lookup_attrs(stats, g, {game_key: "__gk"}, {"__game_id": "__game_id", "__game_date": "__game_date",
                                                    "__season": "__season"})
    s = lookup_attrs(s, players, {player_key: player_key}, {"__player": "full_name", "__position": "position_code"})
    return resolve_key(s, teams, {team_key: team_key}, "team_name", "__team")


def player_game_stats(stats: DataFrame, games: DataFrame, players: DataFrame, teams: DataFrame,
                      dates: DataFrame | None = None, *, game_key="game_key", player_key="player_key",
                      team_key="team_key", date_key="date_key", game_date="game_date") -> DataFrame:
    """J1 + P8: one row per player per game with game, date, team and player attributes."""
    s = _star(stats, games, players, teams, dates, game_key, player_key, team_key, date_key, game_date)
    return s.select(
        F.col("__game_id").alias("Game ID"), F.col("__game_date").alias("Game Date"),
        F.col("__season").alias("Season"), F.col("__team").alias("Team"), F.col("__player").alias("Player"),
        F.col("__position").alias("Position"), *[F.col(src).alias(name) for name, src in _STAT_COLS],
        F.col("time_on_ice_seconds").alias("Time On Ice Seconds"))


def player_season_summary(stats: DataFrame, games: DataFrame, players: DataFrame, teams: DataFrame, *,
                          game_key="game_key", player_key="player_key", team_key="team_key") -> DataFrame:
    """A2: per (season, team, player, position): games and sums; NULL ice time counts as 0.

    Stats are summed per season, team key and player key right after the game join, so the
    dimensions are joined with one row per player, team and season; equal names merge afterwards.
    """
    g = games.select(F.col(game_key).alias("__gk"), F.col("season").alias("__season"))
    sums = [*_STAT_COLS, ("Time On Ice Seconds", "__toi")]
    s = lookup_attrs(stats, g, {game_key: "__gk"}, {"__season": "__season"})
    s = (s.withColumn("__toi", F.coalesce(F.col("time_on_ice_seconds"), F.lit(0)))
         .groupBy("__season", team_key, player_key)
         .agg(F.count(F.lit(1)).alias("__games"), *[F.sum(src).alias(src) for _, src in sums]))
    s = lookup_attrs(s, players, {player_key: player_key}, {"__player": "full_name", "__position": "position_code"})
    s = resolve_key(s, teams, {team_key: team_key}, "team_name", "__team")
    return s.groupBy(F.col("__season").alias("Season"), F.col("__team").alias("Team"),
                     F.col("__player").alias("Player"), F.col("__position").alias("Position")).agg(
        F.sum("__games").cast("long").alias("Games Played"),
        *[F.sum(src).cast("long").alias(name) for name, src in sums])


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Register the four reports over warehouse tables as temporary views."""
    games, teams, players = tables["game_fact"], tables["team_dim"], tables["player_dim"]
    stats, dates = tables["player_game_stats_fact"], tables["date_dim"]
    views = {
        "v_team_game_results": team_game_results(games, teams, dates),
        "v_player_game_stats": player_game_stats(stats, games, players, teams, dates),
        "v_team_season_summary": team_season_summary(games, teams),
        "v_player_season_summary": player_season_summary(stats, games, players, teams),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
