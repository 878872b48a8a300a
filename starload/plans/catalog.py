"""Catalog of checked queries: one per operator of the inventory, over the role-mapped tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed by the
library's operators; ``starload.plans.oracle.ORACLE`` holds the DuckDB statement
each is compared with.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions import expr as X
from starload.operators import checks as C
from starload.operators import deletes as D
from starload.operators import filters as Fl
from starload.operators import joins as J
from starload.operators import loads as L
from starload.operators import reports as R
from starload.operators.dedupe import dedupe
from starload.plans import audit as A
from starload.schemas import LENGTH_LIMITS, REFERENCES, SOURCE_SYSTEM
from starload.session import kept
from starload.sources import payloads as P
from starload.sources.roles import Roles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- reports (J1, J2, A1-A3, U1, P8) ------------------------------------------------------

@query
def v_team_season_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return R.team_season_summary(m.game, m.team, home="home_team_id", away="away_team_id", team_key="team_id")


@query
def v_team_game_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return R.team_game_results(m.game, m.team, None, home="home_team_id", away="away_team_id", team_key="team_id")


@query
def v_player_game_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return R.player_game_stats(m.stats_fact, m.game, m.player, m.team, None, game_key="game_id",
                               player_key="player_id", team_key="team_id")


@query
def v_player_season_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return R.player_season_summary(m.stats_fact, m.game, m.player, m.team, game_key="game_id",
                                   player_key="player_id", team_key="team_id")


@query
def team_games_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return R.team_games(m.game, home="home_team_id", away="away_team_id", team_col="team_id").select(
        "season", "team_id", "goals_for", "goals_against", "shots_for", "shots_against")


# ---- loads (K3-K7, F1, F2, J3-J7, U3, K15) ------------------------------------------------

TEAM_COMPARE = {"team_name": "", "conference": ""}


@query
def scd1_change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    src = m.team_src.filter(F.col("team_id").isNotNull() & F.col("team_name").isNotNull())
    return L.changed_rows(m.team_tgt, src, key="team_id", compare=TEAM_COMPARE).select("team_id")


@query
def scd1_upsert_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    src = m.team_src.filter(F.col("team_id").isNotNull() & F.col("team_name").isNotNull())
    return L.upsert_type1(m.team_tgt, src, key="team_id", compare=TEAM_COMPARE, surrogate="team_key",
                          created=None, modified=None).frame


@query
def scd1_upsert_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    staged = m.player_src.filter(F.col("player_id").isNotNull())
    src = J.resolve_key(staged, m.team_tgt, {"team_id": "team_id"}, "team_key", how="left").select(
        "player_id", "team_key", X.full_name_or_parts("full_name", "first_name", "last_name").alias("full_name"),
        "position_code")
    src = src.filter(F.col("full_name").isNotNull())
    compare = {"team_key": -1, "full_name": None, "position_code": ""}
    return L.upsert_type1(m.player_tgt, src, key="player_id", compare=compare, surrogate="player_key",
                          created=None, modified=None).frame


@query
def insert_missing_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    loaded = m.table("orders").filter(F.col("o_orderstatus") == "F")
    return L.insert_missing(loaded, m.game, {"game_id": "o_orderkey"}).select("game_id")


@query
def insert_missing_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    loaded = m.stats_all.filter(F.col("l_returnflag") == "R")
    return L.insert_missing(loaded, m.stats, ["game_id", "player_id"]).select("game_id", "player_id")


@query
def game_fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    calendar = L.calendar_for_range(C.date_range(m.game, "game_date"))
    return L.load_game_fact(m.game, m.team_tgt, calendar, m.game_fact_existing)


@query
def stats_fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    # the batch's games, its rows, the history and its largest key all come from the staged rows
    with kept(m.stats_staged) as staged:
        return L.load_stats_fact(staged, m.game, m.player, m.team_tgt, m.stats_fact_existing)


@query
def player_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return J.resolve_key(m.player, m.team_tgt, {"team_id": "team_id"}, "team_key", how="left").select(
        "player_id", "team_key")


# ---- checks (C1-C5, A4-A8, T1) --------------------------------------------------------------

@query
def dup_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.duplicate_keys(Roles(spark, sf_dir).stats_all, ["raw_id"])


@query
def dup_composite_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.duplicate_key_count(Roles(spark, sf_dir).stats_all, ["game_id", "player_id"])


@query
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return C.fk_violations(m.game, m.team_tgt, {"home_team_id": "team_id"}).select("game_id", "home_team_id")


@query
def reference_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven references; the teams and players of the dimensions before the load, so some have no parent."""
    m = Roles(spark, sf_dir)
    calendar = L.calendar_for_range(C.date_range(m.game.filter(F.col("game_state") == "FINAL"), "game_date"))
    player = m.player.withColumn("team_key", F.col("team_id") + 1000)
    game = m.game.select("game_key", X.date_key("game_date").alias("date_key"),
                         (F.col("home_team_id") + 1000).alias("home_team_key"),
                         (F.col("away_team_id") + 1000).alias("away_team_key"))
    stats = m.stats_staged.select((F.col("game_id") + 1000).alias("game_key"),
                                  (F.col("player_id") + 1000).alias("player_key"),
                                  (F.col("team_id") + 1000).alias("team_key"))
    violations = [C.reference_violations({"player_dim": player, "team_dim": m.team_tgt, "game_fact": game,
                                          "date_dim": calendar}, REFERENCES[:4]),
                  C.reference_violations({"player_game_stats_fact": stats, "game_fact": m.game_fact_existing,
                                          "player_dim": m.player_tgt, "team_dim": m.team_tgt}, REFERENCES[4:])]
    return violations[0].unionByName(violations[1])


@query
def staged_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.date_range(Roles(spark, sf_dir).game, "game_date")


@query
def latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.latest_batch(Roles(spark, sf_dir).table("events"), "event_type", "ts")


# ---- the host's text comparison (A1, C1, J3, R5) -----------------------------------------------

def _varied(name: str, key: str):
    """A text in several spellings that the host takes as one: by key in upper or lower case, with trailing blanks."""
    k = F.col(key)
    spelled = F.when(k % 3 == 0, F.upper(name)).when(k % 3 == 1, F.lower(name)).otherwise(F.col(name))
    return F.concat(spelled, F.when(k % 2 == 0, F.lit("  ")).otherwise(F.lit("")))


@query
def v_team_season_summary_host_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams named after their conference, spelled in several ways: one row per conference and season."""
    m = Roles(spark, sf_dir)
    teams = m.team.select("team_id", _varied("conference", "team_id").alias("team_name"))
    return R.team_season_summary(m.game, teams, home="home_team_id", away="away_team_id", team_key="team_id", text="host")


@query
def dup_host_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = Roles(spark, sf_dir).table("part").select(_varied("p_brand", "p_partkey").alias("name"))
    return C.duplicate_keys(parts, ["name"], text="host")


@query
def key_lookup_host_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts spell the nation they come from in their own way; the lookup finds its key all the same."""
    m = Roles(spark, sf_dir)
    nation = m.table("nation").select("n_nationkey", "n_name")
    parts = m.table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    parts = parts.select("s_suppkey", _varied("n_name", "s_suppkey").alias("nation"))
    return J.resolve_key(parts, nation, {"nation": "n_name"}, "n_nationkey", text="host").select("s_suppkey", "n_nationkey")


@query
def first_wins_host_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = Roles(spark, sf_dir).table("part").select("p_partkey", _varied("p_brand", "p_partkey").alias("code"))
    return dedupe(parts, ["code"], ["p_partkey"], keep="first", text="host")


# ---- deletes (J8, J9, K12) --------------------------------------------------------------------

@query
def delete_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    final = m.game.filter(F.col("game_state") == "FINAL")
    return D.delete_by_join(m.stats, final, {"game_id": "game_id"}).select("game_id", "player_id")


@query
def guarded_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    kept = D.guarded_delete(m.table("documents"), "doc_id", F.col("n_chars") < 5000, [
        (m.table("labels"), "doc_id"), (m.table("pages"), "page_id"), (m.table("benchmark"), "item_id")])
    return kept.select("doc_id")


@query
def guarded_delete_either(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A guard that holds a parent by either of two columns (``home = k OR away = k``): two anti joins."""
    m = Roles(spark, sf_dir)
    lines = m.table("lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 45))
    return D.guarded_delete(m.table("part"), "p_partkey", F.col("p_size") < 30,
                            [(lines, "l_partkey"), (lines, "l_suppkey")]).select("p_partkey")


# ---- dedupe and selection (R5, R9, P6, T2, F3) -------------------------------------------------

@query
def final_game_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.final_game_ids(Roles(spark, sf_dir).game, id_col="game_id", state_col="game_state")


@query
def last_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return dedupe(m.stats_all, ["game_id", "player_id"], ["raw_id", "l_partkey", "qty"], keep="last").select(
        "game_id", "player_id", "l_partkey", "qty")


@query
def first_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return dedupe(m.stats_all, ["game_id", "player_id"], ["raw_id", "l_partkey", "qty"], keep="first").select(
        "game_id", "player_id", "l_partkey", "qty")


# ---- payloads: envelope, flattening, projection (R1-R12, P1-P7, F5, F6) ----------------------------

BATCH_ID = "11111111-1111-1111-1111-111111111111"
LOAD_TS = datetime(2024, 10, 1, 12, 0, 0)
CODE_ARG = " t01, t03 ,,T05, t18 ,T08,t08 "
GAME_ID_ARG = "1, 2, 3, 4, 5, 6, 7, 32, 33, 34, 35, 36, 37, 38, 39, 64, 7, , 99999999"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Roles(spark, sf_dir).table("events")


@query
def payload_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    docs = P.parse_envelope(ev, raw="props", source=F.concat(F.lit("events/"), F.col("event_id").cast("string")))
    return docs.select("event_id", X.variant_int("doc", "$.k").alias("k"))


@query
def raw_json_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.select("event_id", P.canonical_text("props").alias("raw_json"))


@query
def raw_json_verbatim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: elements keep their own text: nested, in any order, with blanks, ``1.50`` and non-ASCII letters as written."""
    part = Roles(spark, sf_dir).table("part")
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    raw = F.concat(F.lit('{"total": 2, "data" : [ {"price" : '), price, F.lit(', "fullName":"Zürich \\u00e9 ✓ '), "p_brand",
                   F.lit('", "more":{"b":[1 , 2.50],"a":null}, "id":'), F.col("p_partkey").cast("string"), F.lit("} ,\n 7, [1], {}]}"))
    docs = P.parse_envelope(part.select("p_partkey", raw.alias("raw"), F.lit("part").alias("path")))
    rows = P.flatten_teams(docs, keep=["p_partkey"], raw="raw")
    return rows.select("p_partkey", "team_pos", P.raw_json(rows, "team").alias("raw_json"))


@query
def player_raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 for players: the roster element's text as landed."""
    docs = P.parse_envelope(Roles(spark, sf_dir).roster_payloads)
    return P.player_to_staging(P.flatten_rosters(docs, keep=["team_id"], raw="raw")).select("player_id", "raw_json")


def _teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.flatten_teams(P.parse_envelope(Roles(spark, sf_dir).teams_payload), keep=["path"])


@query
def team_payload_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _teams(spark, sf_dir)
    return t.select(F.try_variant_get("team", "$.id", "int").alias("team_id"),
                    F.try_variant_get("team", "$.fullName", "string").alias("team_name"))


@query
def team_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.team_reference(_teams(spark, sf_dir)).select("team_id", "team_abbrev")


@query
def team_to_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.team_to_staging(_teams(spark, sf_dir))


@query
def roster_team_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.roster_targets(P.team_reference(_teams(spark, sf_dir), keep=["path"]), path="path")


@query
def code_list_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.roster_targets(P.team_reference(_teams(spark, sf_dir), keep=["path"]), P.parse_codes(CODE_ARG), path="path")


def _roster_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = P.parse_envelope(Roles(spark, sf_dir).roster_payloads)
    return P.flatten_rosters(docs, keep=["team_id"])


@query
def roster_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _roster_rows(spark, sf_dir)
    return r.select("team_id", "roster_group", F.try_variant_get("player", "$.id", "int").alias("player_id"))


@query
def player_to_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.player_to_staging(_roster_rows(spark, sf_dir)).drop("raw_json")


def _schedule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = P.parse_envelope(Roles(spark, sf_dir).schedule_payloads)
    return P.flatten_schedule(docs, keep=["request_seq"])


@query
def schedule_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _schedule_rows(spark, sf_dir)
    return s.select("request_seq", F.try_variant_get("game", "$.id", "bigint").alias("game_id"), "game_date",
                    F.try_variant_get("game", "$.gameState", "string").alias("game_state"))


@query
def game_to_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = P.latest_games(_schedule_rows(spark, sf_dir), ["request_seq"])
    return P.game_to_staging(latest)


def _boxscore_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.flatten_boxscores(P.parse_envelope(Roles(spark, sf_dir).boxscore_payloads), game_col="game_id")


@query
def boxscore_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _boxscore_rows(spark, sf_dir)
    return b.select("game_id", "side", "team_id", "roster_group",
                    F.try_variant_get("stat", "$.playerId", "int").alias("player_id"))


@query
def stats_to_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.stats_to_staging(_boxscore_rows(spark, sf_dir))


@query
def missing_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    requested = P.final_game_ids(m.game)
    landed = m.boxscore_payloads.filter(F.col("game_id") % 10 != 0).select("game_id")
    return P.missing_payloads(requested, landed, {"game_id": "game_id"})


@query
def explicit_ids_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return P.select_ids(m.game, P.parse_game_ids(GAME_ID_ARG)).select("game_id", "game_state")


@query
def stage_batch_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _events(spark, sf_dir).select("event_id", "user_id", "value", F.col("event_type").alias("load_batch_id"))
    return P.stage_batch(staged, "click").select("event_id", "user_id", "value")


@query
def batch_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Roles(spark, sf_dir).game.select("game_id", "game_date", "season")
    return P.batch_stamp(g, BATCH_ID, LOAD_TS, ["game_id"]).select(
        "raw_id", "source_system", "load_batch_id", "game_id", "created_date")


# ---- filters (F1, F4) --------------------------------------------------------------------------------

@query
def valid_stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return Fl.valid_rows(m.player_src, ["player_id", "full_name"]).select("player_id", "full_name")


@query
def date_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return Fl.date_window(m.game, "game_date", date(1995, 1, 1), date(1995, 12, 31)).select("game_id", "game_date")


# ---- calendar (R11, K5, U2, S9-S13) ---------------------------------------------------------------------

@query
def date_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.dates_between(C.date_range(Roles(spark, sf_dir).game, "game_date"), out="request_date")


@query
def date_dim_populate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.calendar_for_range(C.date_range(Roles(spark, sf_dir).game, "game_date"))


@query
def date_dim_insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    existing = m.game.select(F.col("game_date").alias("full_date")).distinct()
    return L.calendar_for_range(C.date_range(m.game, "game_date"), existing=existing)


# ---- audit (K8-K11, T3) ------------------------------------------------------------------------------

def _audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as audit events: batch = user, sequence = event id, status = event type."""
    ev = _events(spark, sf_dir)
    is_start = F.col("event_type") == "view"
    return ev.select(F.col("user_id").cast("string").alias("load_batch_id"), F.lit(SOURCE_SYSTEM).alias("source_system"),
                     F.when(is_start, F.col("ts")).alias("load_start_date"), F.col("ts").alias("load_end_date"),
                     F.col("event_type").alias("status"), F.floor("value").cast("int").alias("rows_inserted"),
                     F.lit(0).alias("rows_updated"), F.lit(None).cast("string").alias("error_message"),
                     F.col("event_id").alias("event_seq"))


@query
def batch_audit_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.current_state(_audit_events(spark, sf_dir)).select(
        "load_batch_id", "load_start_date", "load_end_date", "status", "rows_inserted", "event_seq")


@query
def audit_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.readback(A.current_state(_audit_events(spark, sf_dir))).select(
        "load_batch_id", "load_start_date", "status")


# ---- counts and constraint checks (A6, C4, C5) -------------------------------------------------------------

@query
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Roles(spark, sf_dir)
    return C.row_counts({"team": m.team, "player": m.player, "game": m.game, "stats": m.stats_all})


@query
def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["game_id", "game_date", "season", "home_team_id", "away_team_id", "home_goals", "away_goals"]
    return C.not_null_violations(Roles(spark, sf_dir).game, cols)


@query
def length_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = {c: n for c, n in LENGTH_LIMITS["player_raw"].items() if c != "shoots_catches"}
    return C.length_violations(Roles(spark, sf_dir).player_src, limits)


# ---- scalar rules (S1-S15, S17-S19), one projection each ------------------------------------------

@query
def fn_isnull_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = Roles(spark, sf_dir).player, F.col("player_id")
    name = F.when(k % 3 != 0, F.col("full_name"))
    return p.select("player_id", X.isnull_typed(name, F.repeat("full_name", 12), 200).alias("name"))


@query
def fn_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Roles(spark, sf_dir).game
    return g.select("game_id", F.coalesce("home_goals", F.lit(0)).alias("home_goals"),
                    F.coalesce("away_goals", F.lit(0)).alias("away_goals"))


@query
def fn_nullif_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = Roles(spark, sf_dir).player, F.col("player_id")
    x = F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit("   ")).otherwise(F.col("full_name"))
    return p.select("player_id", X.nullif_blank(x).alias("value"))


@query
def fn_full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = Roles(spark, sf_dir).player_src, F.col("player_id")
    first = F.when(k % 3 != 0, F.col("first_name"))
    last = F.when(k % 4 != 0, F.col("last_name"))
    return p.select("player_id", X.concat_name(first, last).alias("full_name"))


@query
def fn_localized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = Roles(spark, sf_dir).player, F.col("player_id")
    first = F.split_part("full_name", F.lit("#"), F.lit(1))
    text = (F.when(k % 4 == 0, F.to_json(F.struct(first.alias("default"))))
            .when(k % 4 == 1, F.to_json(F.array(first)).substr(F.lit(2), F.length(F.to_json(F.array(first))) - 2))
            .when(k % 4 == 2, F.lit("null")).otherwise(k.cast("string")))
    return p.select("player_id", X.localized_text(F.parse_json(text)).alias("value"))


@query
def fn_int_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev, k = _events(spark, sf_dir), F.col("event_id")
    text = F.when(k % 5 == 0, F.lit("n/a")).when(k % 5 == 1, F.lit("")).otherwise(F.col("user_id").cast("string"))
    return ev.select("event_id", X.to_int(text).alias("value"))


@query
def fn_toi_to_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Roles(spark, sf_dir).stats_all
    toi = F.concat((F.col("l_linenumber") * 7).cast("string"), F.lit(":"),
                   F.lpad((F.col("l_partkey") % 60).cast("string"), 2, "0"))
    return s.select("raw_id", "l_partkey", X.toi_to_seconds(toi).alias("seconds"))


@query
def fn_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, k = Roles(spark, sf_dir).game, F.col("game_id")
    day = F.date_format("game_date", "yyyy-MM-dd")
    text = F.when(k % 3 == 0, F.concat(day, F.lit("T12:34:56Z"))).when(k % 3 == 1, day).otherwise(F.lit(""))
    return g.select("game_id", X.to_date_prefix(text).alias("value"))


@query
def fn_date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Roles(spark, sf_dir).game.select("game_id", X.date_key("game_date").alias("date_key"))


@query
def fn_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = X.date_parts("game_date")
    return Roles(spark, sf_dir).game.select("game_id", *[c.alias(n) for n, c in parts.items()])


@query
def fn_day_month_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Roles(spark, sf_dir).game.select("game_id", X.month_name("game_date").alias("month_name"),
                                            X.day_name("game_date").alias("day_name"))


@query
def fn_is_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Roles(spark, sf_dir).game.select("game_id", X.is_weekend("game_date").alias("is_weekend"))


@query
def fn_date_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Roles(spark, sf_dir).game.select("game_id", X.next_day("game_date").alias("next_date"))


@query
def fn_winner_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Roles(spark, sf_dir).game
    return g.select("game_id", X.winner_label("home_goals", "away_goals", F.col("home_team_id").cast("string"),
                                              F.col("away_team_id").cast("string")).alias("winner"))


@query
def fn_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Roles(spark, sf_dir).stats.select("game_id", "player_id", X.points("goals", "assists").alias("points"))


@query
def fn_truncate_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Roles(spark, sf_dir).game
    cut = X.truncate_message(F.repeat(F.concat("game_type", F.lit(" ")), 400))
    return g.select("game_id", F.length(cut).alias("msg_length"), F.substring(cut, 3991, 10).alias("msg_tail"))


@query
def fn_normalize_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Roles(spark, sf_dir).player
    raw = F.concat(F.lit("  "), F.lower(F.substring("full_name", 1, 3)), F.col("position_code"), F.lit(" "))
    return p.select("player_id", X.normalize_code(raw).alias("code"))


@query
def fn_season_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Roles(spark, sf_dir).game.select("game_id", X.season_start("game_date").alias("season_start"))


@query
def season_start_of_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Roles(spark, sf_dir).game.select("game_id", X.season_start_year("game_date").alias("season_start_year"))
