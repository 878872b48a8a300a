"""The sample run (L7): stage fixed sample rows (R13, K11), calendar, four loads, audit read-back (T3),
and its cleanup (K12).
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions import expr as X

from starload.operators import deletes as D
from starload.operators.joins import missing_from
from starload.operators.keys import assign_surrogate_keys, current_max
from starload.operators.loads import id_seasons
from starload.plans import audit as A
from starload.plans import jobs as J
from starload.plans.store import Warehouse
from starload.schemas import SOURCE_SYSTEM
from starload.session import scratch_scope

# ---- fixed values: the reference's sample data --------------------------------------------------
SAMPLE_SOURCE_SYSTEM = "Sample Data"
TEAM_BATCH = "11111111-1111-1111-1111-111111111111"
PLAYER_BATCH = "22222222-2222-2222-2222-222222222222"
GAME_BATCH = "33333333-3333-3333-3333-333333333333"
STATS_BATCH = "44444444-4444-4444-4444-444444444444"
SAMPLE_CALENDAR = (date(2024, 10, 1), date(2024, 10, 31))
SAMPLE_SEASON = "20242025"
SAMPLE_GAME_TYPE = "Regular"
# team_id, team_name, team_abbreviation, conference, division
SAMPLE_TEAMS = [
    (6, "Boston Bruins", "BOS", "Eastern", "Atlantic"),
    (10, "Toronto Maple Leafs", "TOR", "Eastern", "Atlantic"),
    (3, "New York Rangers", "NYR", "Eastern", "Metropolitan"),
    (14, "Tampa Bay Lightning", "TBL", "Eastern", "Atlantic"),
]
# player_id, team_id, first_name, last_name, position_code, shoots_catches, birth_date
SAMPLE_PLAYERS = [
    (8478403, 6, "David", "Pastrnak", "RW", "R", "1996-05-25"),
    (8473419, 6, "Brad", "Marchand", "LW", "L", "1988-05-11"),
    (8479318, 10, "Auston", "Matthews", "C", "R", "1997-09-17"),
    (8478483, 10, "Mitch", "Marner", "RW", "R", "1997-05-05"),
    (8478048, 3, "Artemi", "Panarin", "LW", "R", "1991-10-30"),
    (8480069, 3, "Adam", "Fox", "D", "R", "1998-02-17"),
    (8476453, 14, "Nikita", "Kucherov", "RW", "L", "1993-06-17"),
    (8475167, 14, "Victor", "Hedman", "D", "L", "1990-12-18"),
]
# game_id, game_date, home_team_id, away_team_id, home_goals, away_goals, home_shots, away_shots
SAMPLE_GAMES = [
    (2024020001, "2024-10-05", 6, 10, 4, 2, 32, 28),
    (2024020002, "2024-10-08", 3, 14, 3, 5, 29, 34),
    (2024020003, "2024-10-12", 10, 3, 2, 3, 31, 27),
]
# game_id, player_id, team_id, goals, assists, shots, hits, blocks, penalty_minutes, time_on_ice_seconds
SAMPLE_STATS = [
    (2024020001, 8478403, 6, 2, 1, 6, 1, 0, 0, 1210),
    (2024020001, 8473419, 6, 1, 1, 4, 2, 0, 2, 1165),
    (2024020001, 8479318, 10, 1, 0, 5, 1, 1, 0, 1198),
    (2024020001, 8478483, 10, 0, 1, 3, 0, 1, 0, 1180),
    (2024020002, 8478048, 3, 1, 1, 5, 0, 0, 0, 1225),
    (2024020002, 8480069, 3, 0, 2, 2, 1, 3, 0, 1440),
    (2024020002, 8476453, 14, 2, 2, 7, 0, 0, 0, 1264),
    (2024020002, 8475167, 14, 1, 1, 3, 1, 4, 2, 1512),
    (2024020003, 8479318, 10, 1, 0, 6, 1, 0, 0, 1205),
    (2024020003, 8478483, 10, 0, 2, 4, 0, 1, 0, 1176),
    (2024020003, 8478048, 3, 1, 2, 5, 1, 0, 0, 1248),
    (2024020003, 8480069, 3, 0, 1, 2, 1, 2, 0, 1422),
]
# ----------------------------------------------------------------------------------------------------

BATCHES = {"team_raw": TEAM_BATCH, "player_raw": PLAYER_BATCH, "game_raw": GAME_BATCH,
           "player_game_stats_raw": STATS_BATCH}


def sample_rows(spark: SparkSession) -> dict[str, tuple[DataFrame, list[str]]]:
    """Staging rows of each sample batch with their natural keys; raw JSON is a small object of the ids."""
    teams = spark.createDataFrame(SAMPLE_TEAMS, "team_id int, team_name string, team_abbreviation string, "
                                                "conference string, division string")
    teams = teams.withColumn("raw_json", F.to_json(F.struct(F.col("team_id").alias("teamId"),
                                                            F.col("team_name").alias("name"))))
    players = spark.createDataFrame(SAMPLE_PLAYERS, "player_id int, team_id int, first_name string, "
                                                    "last_name string, position_code string, "
                                                    "shoots_catches string, birth_date string")
    players = players.withColumns({
        "full_name": F.concat_ws(" ", "first_name", "last_name"), "birth_date": F.to_date("birth_date"),
        "raw_json": F.to_json(F.struct(F.col("player_id").alias("playerId"),
                                       F.concat_ws(" ", "first_name", "last_name").alias("fullName")))})
    games = spark.createDataFrame(SAMPLE_GAMES, "game_id long, game_date string, home_team_id int, "
                                                "away_team_id int, home_goals int, away_goals int, "
                                                "home_shots int, away_shots int")
    games = games.withColumns({"game_date": F.to_date("game_date"), "season": F.lit(SAMPLE_SEASON),
                               "game_type": F.lit(SAMPLE_GAME_TYPE),
                               "raw_json": F.to_json(F.struct(F.col("game_id").alias("gameId")))})
    stats = spark.createDataFrame(SAMPLE_STATS, "game_id long, player_id int, team_id int, goals int, assists int, "
                                                "shots int, hits int, blocks int, penalty_minutes int, "
                                                "time_on_ice_seconds int")
    stats = stats.withColumn("raw_json", F.to_json(F.struct(F.col("game_id").alias("gameId"),
                                                            F.col("player_id").alias("playerId"))))
    return {"team_raw": (teams, ["team_id"]), "player_raw": (players, ["player_id"]),
            "game_raw": (games, ["game_id"]), "player_game_stats_raw": (stats, ["game_id", "player_id"])}


def stage_sample(spark: SparkSession, wh: Warehouse, load_ts: datetime) -> None:
    """001: reset the four sample batches (K11) and stage each row unless already staged."""
    with scratch_scope(spark), wh.transaction() as tx:
        A.record(tx, [A.start_event(b, SAMPLE_SOURCE_SYSTEM, load_ts) for b in BATCHES.values()])
        for table, (rows, keys) in sample_rows(spark).items():
            batch = BATCHES[table]
            existing = tx.read(table)
            new = missing_from(rows, existing.filter(F.col("load_batch_id") == batch), {k: k for k in keys})
            new = new.withColumns({"load_batch_id": F.lit(batch), "source_system": F.lit(SOURCE_SYSTEM),
                                   "created_date": X.timestamp_literal(load_ts)})
            new = assign_surrogate_keys(new, "raw_id", keys, base=current_max(existing, "raw_id"))
            tx.append(table, J.conform(new, table))


def run_sample(spark: SparkSession, wh: Warehouse, load_ts: datetime | None = None) -> DataFrame:
    """003: calendar for October 2024, the four loads of the sample batches, then the audit read-back."""
    load_ts = load_ts or A.utc_now()
    stage_sample(spark, wh, load_ts)
    J.populate_date_dim(wh, *SAMPLE_CALENDAR)
    for table, batch in BATCHES.items():
        J.run_step(wh, batch, lambda tx, s=J.STEPS[table], b=batch: s(tx, b, load_ts), SAMPLE_SOURCE_SYSTEM)
    state = A.current_state(wh.read("load_batch")).filter(F.col("load_batch_id").isin(list(BATCHES.values())))
    return A.readback(state)


def cleanup_sample(spark: SparkSession, wh: Warehouse) -> None:
    """002 (K12): remove the sample rows in reverse dependency order, all in one commit."""
    game_ids = [g[0] for g in SAMPLE_GAMES]
    player_ids = [p[0] for p in SAMPLE_PLAYERS]
    team_ids = [t[0] for t in SAMPLE_TEAMS]
    with wh.transaction() as tx:
        # only the partitions of the sample's games hold rows to delete: the others are not touched
        parts = id_seasons(spark.createDataFrame([(i,) for i in game_ids], "game_id long"))
        games = tx.read("game_fact", parts, with_part=True)
        sample_games = games.filter(F.col("game_id").isin(game_ids))
        stats = D.delete_by_join(tx.read("player_game_stats_fact", parts, with_part=True), sample_games, {"game_key": "game_key"})
        games = games.filter(~F.col("game_id").isin(game_ids))
        tx.keep("player_game_stats_fact", stats, parts)
        tx.keep("game_fact", games, parts)
        stats, games = tx.read("player_game_stats_fact"), tx.read("game_fact")  # the guards need the whole facts
        players = D.guarded_delete(tx.read("player_dim"), "player_key", F.col("player_id").isin(player_ids),
                                   [(stats, "player_key")])
        teams = D.guarded_delete(tx.read("team_dim"), "team_key", F.col("team_id").isin(team_ids),
                                 [(players, "team_key"), (games, "home_team_key"), (games, "away_team_key"),
                                  (stats, "team_key")])
        tx.keep("player_dim", players)
        tx.keep("team_dim", teams)
        for table, batch in BATCHES.items():
            tx.keep(table, tx.read(table).filter(F.col("load_batch_id") != batch))
        tx.keep("load_batch", tx.read("load_batch").filter(~F.col("load_batch_id").isin(list(BATCHES.values()))))
        start, end = SAMPLE_CALENDAR
        tx.keep("date_dim", D.guarded_delete(tx.read("date_dim"), "date_key",
                                             F.col("full_date").between(F.lit(start), F.lit(end)),
                                             [(games, "date_key")]))
