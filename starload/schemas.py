"""Target table schemas of the league warehouse, sentinels and fixed values.

Times are ``TIMESTAMP_NTZ`` (the host's DATETIME2 carries no zone); the load
time is always passed in as a literal so that a plan re-evaluated after an
executor loss writes the same value.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import types as T

# ---- fixed values that must equal the reference's ------------------------------------
SOURCE_SYSTEM = "NHL API"
STATUS_STARTED = "Started"
STATUS_SUCCEEDED = "Succeeded"
STATUS_FAILED = "Failed"
FINAL_GAME_STATES = ("FINAL", "OFF")
ROSTER_GROUPS = ("forwards", "defensemen", "goalies")
BOXSCORE_GROUPS = ("forwards", "defense", "goalies")
BOXSCORE_SIDES = ("awayTeam", "homeTeam")
STAGING_TABLES = ("team_raw", "player_raw", "game_raw", "player_game_stats_raw")
ERROR_MESSAGE_LIMIT = 4000
SEASON_START_MONTH = 9
GAME_IDS_PER_SEASON = 1_000_000
CALENDAR_ERROR = "calendar needs a start date and an end date not before it"
NULL_TEXT_SENTINEL = ""
NULL_KEY_SENTINEL = -1
NULL_DATE_SENTINEL = date(1900, 1, 1)
# --------------------------------------------------------------------------------------

_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.BooleanType()
_TS = T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


_STAGE_HEAD = (("raw_id", _L, False), ("source_system", _S, False), ("load_batch_id", _S, False), ("raw_json", _S, True))

TEAM_RAW = _schema(*_STAGE_HEAD, ("team_id", _I, True), ("team_name", _S, True), ("team_abbreviation", _S, True),
                   ("conference", _S, True), ("division", _S, True), ("created_date", _TS, False))
PLAYER_RAW = _schema(*_STAGE_HEAD, ("player_id", _I, True), ("team_id", _I, True), ("first_name", _S, True),
                     ("last_name", _S, True), ("full_name", _S, True), ("position_code", _S, True),
                     ("shoots_catches", _S, True), ("birth_date", _D, True), ("created_date", _TS, False))
GAME_RAW = _schema(*_STAGE_HEAD, ("game_id", _L, True), ("game_date", _D, True), ("season", _S, True),
                   ("game_type", _S, True), ("home_team_id", _I, True), ("away_team_id", _I, True),
                   ("home_goals", _I, True), ("away_goals", _I, True), ("home_shots", _I, True),
                   ("away_shots", _I, True), ("created_date", _TS, False))
PLAYER_GAME_STATS_RAW = _schema(*_STAGE_HEAD, ("game_id", _L, True), ("player_id", _I, True), ("team_id", _I, True),
                                ("goals", _I, True), ("assists", _I, True), ("shots", _I, True), ("hits", _I, True),
                                ("blocks", _I, True), ("penalty_minutes", _I, True),
                                ("time_on_ice_seconds", _I, True), ("created_date", _TS, False))

TEAM_DIM = _schema(("team_key", _I, False), ("team_id", _I, False), ("team_name", _S, False),
                   ("team_abbreviation", _S, True), ("conference", _S, True), ("division", _S, True),
                   ("is_active", _B, False), ("created_date", _TS, False), ("modified_date", _TS, True))
PLAYER_DIM = _schema(("player_key", _I, False), ("player_id", _I, False), ("team_key", _I, True),
                     ("first_name", _S, True), ("last_name", _S, True), ("full_name", _S, False),
                     ("position_code", _S, True), ("shoots_catches", _S, True), ("birth_date", _D, True),
                     ("is_active", _B, False), ("created_date", _TS, False), ("modified_date", _TS, True))
DATE_DIM = _schema(("date_key", _I, False), ("full_date", _D, False), ("calendar_year", _I, False),
                   ("calendar_quarter", _I, False), ("calendar_month", _I, False), ("month_name", _S, False),
                   ("day_of_month", _I, False), ("day_of_week", _I, False), ("day_name", _S, False),
                   ("is_weekend", _B, False))
GAME_FACT = _schema(("game_key", _L, False), ("game_id", _L, False), ("date_key", _I, False), ("season", _S, True),
                    ("game_type", _S, True), ("home_team_key", _I, False), ("away_team_key", _I, False),
                    ("home_goals", _I, True), ("away_goals", _I, True), ("home_shots", _I, True),
                    ("away_shots", _I, True), ("created_date", _TS, False))
PLAYER_GAME_STATS_FACT = _schema(("player_game_stats_key", _L, False), ("game_key", _L, False),
                                 ("player_key", _I, False), ("team_key", _I, False), ("goals", _I, False),
                                 ("assists", _I, False), ("points", _I, True), ("shots", _I, False),
                                 ("hits", _I, False), ("blocks", _I, False), ("penalty_minutes", _I, False),
                                 ("time_on_ice_seconds", _I, True), ("created_date", _TS, False))
LOAD_BATCH = _schema(("load_batch_id", _S, False), ("source_system", _S, False), ("load_start_date", _TS, True),
                     ("load_end_date", _TS, True), ("status", _S, False), ("rows_inserted", _L, True),
                     ("rows_updated", _L, True), ("error_message", _S, True), ("event_seq", _L, False))

# VARCHAR(n) limits of the target tables
LENGTH_LIMITS = {
    "team_raw": {"team_name": 100, "team_abbreviation": 10, "conference": 50, "division": 50},
    "player_raw": {"first_name": 100, "last_name": 100, "full_name": 200, "position_code": 10, "shoots_catches": 10},
    "game_raw": {"season": 10, "game_type": 20},
    "team_dim": {"team_name": 100, "team_abbreviation": 10, "conference": 50, "division": 50},
    "player_dim": {"first_name": 100, "last_name": 100, "full_name": 200, "position_code": 10, "shoots_catches": 10},
    "date_dim": {"month_name": 20, "day_name": 20},
    "game_fact": {"season": 10, "game_type": 20},
    "load_batch": {"source_system": 50, "status": 20},
}

# NOT NULL columns of the target tables (C4); the audit log holds events, whose start time is set
# only on start events, so its state table (audit.current_state) carries the NOT NULL start
NOT_NULL = {name: [f.name for f in schema.fields if not f.nullable] for name, schema in {
    "team_raw": TEAM_RAW, "player_raw": PLAYER_RAW, "game_raw": GAME_RAW,
    "player_game_stats_raw": PLAYER_GAME_STATS_RAW, "team_dim": TEAM_DIM, "player_dim": PLAYER_DIM,
    "date_dim": DATE_DIM, "game_fact": GAME_FACT, "player_game_stats_fact": PLAYER_GAME_STATS_FACT,
    "load_batch": LOAD_BATCH}.items()}

SCHEMAS = {
    "team_raw": TEAM_RAW, "player_raw": PLAYER_RAW, "game_raw": GAME_RAW,
    "player_game_stats_raw": PLAYER_GAME_STATS_RAW, "team_dim": TEAM_DIM, "player_dim": PLAYER_DIM,
    "date_dim": DATE_DIM, "game_fact": GAME_FACT, "player_game_stats_fact": PLAYER_GAME_STATS_FACT,
    "load_batch": LOAD_BATCH,
}

#: Facts are stored by partition of this column; reports do not see it.
PARTITIONS = {"game_fact": "id_season", "player_game_stats_fact": "id_season"}
#: The surrogate key of each table that has one.
SURROGATES = {"team_dim": "team_key", "player_dim": "player_key", "game_fact": "game_key",
              "player_game_stats_fact": "player_game_stats_key"}

#: Foreign keys of the warehouse (fixed values of the data model): child table, column, parent table, parent key.
REFERENCES = (
    ("player_dim", "team_key", "team_dim", "team_key"),
    ("game_fact", "date_key", "date_dim", "date_key"),
    ("game_fact", "home_team_key", "team_dim", "team_key"),
    ("game_fact", "away_team_key", "team_dim", "team_key"),
    ("player_game_stats_fact", "game_key", "game_fact", "game_key"),
    ("player_game_stats_fact", "player_key", "player_dim", "player_key"),
    ("player_game_stats_fact", "team_key", "team_dim", "team_key"),
)
