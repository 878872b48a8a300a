"""Load jobs (L1-L6): payloads -> staging batch -> warehouse load, each step atomic and audited.

Order of commits per source load, as in the reference: (1) start the batch and
refresh its staging table together (K8, K1, K2); (2) run the warehouse load and
record its outcome together (K3-K7 + K9); on failure only a ``Failed`` event is
committed (K10, K13) and the error is raised again. The driver only orchestrates
and reads counts; all row work runs in Spark.
"""

from __future__ import annotations

import logging
from datetime import date, datetime
from functools import partial, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions import expr as X
from starload.operators import checks as C
from starload.operators import loads as L
from starload.operators import reports as R
from starload.operators.filters import default_game_window, default_stats_window, valid_rows
from starload.operators.dedupe import dedupe
from starload.operators.joins import exists_in, resolve_key
from starload.plans import audit as A
from starload.plans.store import Transaction, Warehouse
from starload.schemas import LENGTH_LIMITS, NOT_NULL, NULL_DATE_SENTINEL, PARTITIONS, REFERENCES, SCHEMAS, SOURCE_SYSTEM
from starload.session import scratch_scope, written
from starload.sources import payloads as P

log = logging.getLogger("starload")

TEAM_COMPARE = {"team_name": "", "team_abbreviation": "", "conference": "", "division": ""}
PLAYER_COMPARE = {"team_key": -1, "first_name": "", "last_name": "", "full_name": None, "position_code": "",
                  "shoots_catches": "", "birth_date": NULL_DATE_SENTINEL}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``table`` in DDL order and types; absent columns are NULL.

    The table's constraints are enforced as the rows are written, as the host does
    on insert: a NULL in a NOT NULL column (C4) or a text longer than its VARCHAR
    limit (C5) raises, which fails the write, so the load never commits.
    """
    limits = LENGTH_LIMITS.get(table, {})
    not_null = set(NOT_NULL.get(table, []))
    cols = []
    for f in SCHEMAS[table].fields:
        c = (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType)
        if f.name in limits:
            c = F.when(F.length(c) > limits[f.name], F.raise_error(F.lit(
                f"value longer than {limits[f.name]} characters in {table}.{f.name}"))).otherwise(c)
        if f.name in not_null:
            c = F.when(c.isNull(), F.raise_error(F.lit(
                f"NULL in NOT NULL column {table}.{f.name}"))).otherwise(c)
        cols.append(c.alias(f.name))
    part = PARTITIONS.get(table)
    if part:  # a fact's partition: given with the rows, or that of their game id
        cols.append(F.col(part) if part in df.columns else X.id_season("game_id").alias(part))
    return df.select(*cols)


# ---- commit 1: start batch + staging ----------------------------------------------------------

def stage(wh: Warehouse, table: str, rows: DataFrame, batch_id: str, load_ts: datetime, order: list[str],
          source_system: str = SOURCE_SYSTEM) -> int:
    """K8 + K1 + K2 + P7: start the batch and replace the staging table with the stamped rows."""
    with scratch_scope(wh.spark), wh.transaction() as tx:
        stamped = conform(P.batch_stamp(rows, batch_id, load_ts, order, source_system), table)
        tx.refresh_staging(table, stamped)
        A.record(tx, [A.start_event(batch_id, source_system, load_ts)])
    return wh.rows(table)


# ---- commit 2: one audited, atomic load step ------------------------------------------------------

def run_step(wh: Warehouse, batch_id: str, step, source_system: str = SOURCE_SYSTEM) -> tuple[int, int]:
    """``step(tx) -> (inserted, updated)``; data and the Succeeded event commit together.

    On error nothing of the step is committed, a Failed event with the (cut) message
    is committed instead, and the error is raised again.
    """
    try:
        with scratch_scope(wh.spark), wh.transaction() as tx:
            inserted, updated = step(tx)
            A.record(tx, [A.succeeded_event(batch_id, inserted, updated, source_system)])
        return inserted, updated
    except Exception as exc:
        with wh.transaction() as tx:
            A.record(tx, [A.failed_event(batch_id, str(exc), source_system)])
        raise


def check_references(tx: Transaction, table: str, path: str, parts: list | None = None) -> DataFrame:
    """Every reference of the rows just written to ``path``; one without its parent row fails the load.

    ``parts`` are the partitions of a fact that can hold the parents.
    """
    references = [r for r in REFERENCES if r[0] == table]
    rows = tx.store.spark.read.parquet(path)
    tables = {parent: tx.read(parent, parts if parent in PARTITIONS else None) for _, _, parent, _ in references}
    broken = C.reference_violations(tables | {table: rows}, references).filter(F.col("violations") > 0)
    for r in broken.collect():  # at most one row per reference
        raise L.LoadError(f"{r.violations} rows of {table} have a {r.column_name} without a parent row")
    return rows


def load_team_dim(tx: Transaction, batch_id: str, load_ts: datetime) -> tuple[int, int]:
    """K3 from staging batch ``batch_id``."""
    src = valid_rows(P.stage_batch(tx.read("team_raw"), batch_id), ["team_id", "team_name"])
    res = L.upsert_type1(tx.read("team_dim"), src, key="team_id", compare=TEAM_COMPARE, surrogate="team_key",
                         load_ts=load_ts, order=["raw_id"])
    tx.replace("team_dim", conform(res.frame, "team_dim"))
    return res.rows_inserted, res.rows_updated


def load_player_dim(tx: Transaction, batch_id: str, load_ts: datetime) -> tuple[int, int]:
    """K4 from staging batch ``batch_id``: team key by left lookup (J4), full-name fallback."""
    staged = P.stage_batch(tx.read("player_raw"), batch_id).filter(F.col("player_id").isNotNull())
    src = resolve_key(staged, tx.read("team_dim"), {"team_id": "team_id"}, "team_key", how="left")
    src = src.withColumn("full_name", X.full_name_or_parts("full_name", "first_name", "last_name"))
    src = src.filter(F.col("full_name").isNotNull())
    res = L.upsert_type1(tx.read("player_dim"), src, key="player_id", compare=PLAYER_COMPARE,
                         surrogate="player_key", load_ts=load_ts, order=["raw_id"])
    check_references(tx, "player_dim", tx.replace("player_dim", conform(res.frame, "player_dim")))
    return res.rows_inserted, res.rows_updated


def append_fact(tx: Transaction, table: str, new: DataFrame, history: DataFrame, keys: list[str], parts: list) -> int:
    """Write a fact's new rows once, then test what was written: unique keys (C1, C2, also against ``history``)
    and references (C3). Only partitions ``parts`` are read besides; returns the rows inserted."""
    before = tx.table(table).rows
    path = tx.append(table, conform(new, table))
    inserted = tx.table(table).rows - before
    if inserted:
        rows = check_references(tx, table, path, parts)
        clash = C.duplicate_keys(rows, keys).limit(1).count() or \
            exists_in(rows, history, {k: k for k in keys}).limit(1).count()
        if clash:
            raise L.LoadError(f"duplicate key {table}({', '.join(keys)}) in the new rows")
    return inserted


def load_game_fact(tx: Transaction, batch_id: str, load_ts: datetime) -> tuple[int, int]:
    """K6 from staging batch ``batch_id``; a game id twice among the new rows fails the load."""
    staged = P.stage_batch(tx.read("game_raw"), batch_id)
    parts = L.id_seasons(staged)
    history = tx.read("game_fact", parts)
    new = L.load_game_fact(staged, tx.read("team_dim"), tx.read("date_dim"), history, load_ts=load_ts,
                           base=tx.table("game_fact").top_key)
    return append_fact(tx, "game_fact", new, history, ["game_id"], parts), 0


def load_stats_fact(tx: Transaction, batch_id: str, load_ts: datetime) -> tuple[int, int]:
    """K7 from staging batch ``batch_id``; (game, player) must stay unique in the fact."""
    staged = P.stage_batch(tx.read("player_game_stats_raw"), batch_id)
    parts = L.id_seasons(staged)
    history = tx.read("player_game_stats_fact", parts)
    new = L.load_stats_fact(staged, tx.read("game_fact", parts), tx.read("player_dim"), tx.read("team_dim"), history,
                            load_ts=load_ts, base=tx.table("player_game_stats_fact").top_key, with_season=True)
    return append_fact(tx, "player_game_stats_fact", new, history, ["game_key", "player_key"], parts), 0


def populate_date_dim(wh: Warehouse, start: date | None, end: date | None) -> int:
    """K5: add the missing calendar days of [start, end] (not audited, as in the reference)."""
    before = wh.rows("date_dim")
    with wh.transaction() as tx:
        rows = L.populate_calendar(wh.spark, start, end, existing=tx.read("date_dim"))
        tx.append("date_dim", conform(rows, "date_dim"))
    return wh.rows("date_dim") - before


STEPS = {"team_raw": load_team_dim, "player_raw": load_player_dim, "game_raw": load_game_fact,
         "player_game_stats_raw": load_stats_fact}
TARGETS = {"team_raw": "team_dim", "player_raw": "player_dim", "game_raw": "game_fact",
           "player_game_stats_raw": "player_game_stats_fact"}


def _fail(error: Exception, tx: Transaction) -> None:
    raise error


def _load(wh: Warehouse, staging: str, rows: DataFrame, order: list[str], load_ts: datetime | None,
          batch_id: str | None = None, before_step=None) -> C.LoadResult:
    """Stage ``rows`` as a new batch, run the warehouse step, validate.

    The counts are those seen as the rows were written. A duplicate key among the rows a step wrote
    fails the step before it commits, so a load that returns has none.
    """
    load_ts = load_ts or A.utc_now()
    batch_id = batch_id or A.new_batch_id()
    target = TARGETS[staging]
    before = wh.rows(target)
    staged = stage(wh, staging, rows, batch_id, load_ts, order)
    if before_step is not None:
        try:
            before_step(batch_id)
        except Exception as error:  # the step fails with it, so that the batch is marked Failed
            run_step(wh, batch_id, partial(_fail, error))
    inserted, updated = run_step(wh, batch_id, lambda tx: STEPS[staging](tx, batch_id, load_ts))
    return C.LoadResult(batch_id, staged, before, wh.rows(target), inserted, updated, 0)


# ---- source loads ----------------------------------------------------------------------------------

def _in_scope(load):
    """A source load that removes its temporary data at its end."""
    @wraps(load)
    def run(spark: SparkSession, *args, **kwargs):
        with scratch_scope(spark):
            return load(spark, *args, **kwargs)
    return run


def _teams(spark: SparkSession, landing: str, payloads: DataFrame | None = None) -> DataFrame:
    payloads = P.read_payloads(spark, f"{landing}/teams") if payloads is None else payloads
    flat = P.flatten_teams(P.parse_envelope(payloads), keep=["path"], raw="raw")
    return P.newest_entries(flat, F.try_variant_get("team", "$.id", "int"))


def load_teams(spark: SparkSession, wh: Warehouse, landing: str, load_ts: datetime | None = None,
               payloads: DataFrame | None = None) -> C.LoadResult:
    """L1: teams payloads -> team_raw -> team_dim (``payloads`` overrides the landing folder); a team that
    several payloads hold is taken from the last of them."""
    rows = P.team_to_staging(_teams(spark, landing, payloads), keep=["path", "team_pos"])
    return _load(wh, "team_raw", rows, ["path", "team_pos"], load_ts)


@_in_scope
def load_players(spark: SparkSession, wh: Warehouse, landing: str, codes: str | None = None,
                 load_ts: datetime | None = None) -> C.LoadResult:
    """L2: team reference (R3) -> first team per code (R5) -> code filter (F5) -> rosters (R4, R6) -> player_dim."""
    ref = P.team_reference(_teams(spark, landing), keep=["path"])
    targets = P.roster_targets(ref, P.parse_codes(codes), path="path")
    targets = targets.join(ref.select("team_id", "team_pos"), "team_id")
    targets = written(targets.withColumnRenamed("team_abbrev", "key"))
    rosters = P.Landing(spark, landing, "roster")
    for r in rosters.missing(targets.select("key")).orderBy("key").toLocalIterator():
        log.warning("no roster payload for team code %s: team skipped", r.key)
    docs = P.parse_envelope(rosters.read(targets.select("key")).join(targets, "key"))
    flat = P.flatten_rosters(docs, keep=["team_id", "team_pos"], raw="raw")
    rows = P.player_to_staging(flat, keep=["team_pos", "group_pos", "player_pos"])
    return _load(wh, "player_raw", rows, ["team_pos", "team_id", "group_pos", "player_pos"], load_ts)


def load_games(spark: SparkSession, wh: Warehouse, landing: str, start: date | None = None,
               end: date | None = None, load_ts: datetime | None = None, today: date | None = None) -> C.LoadResult:
    """L3: schedules of each requested date (R11, R7) -> last occurrence per game (P6) -> game_raw ->
    calendar over the staged range (K5, taken before the fact load) -> game_fact (K6)."""
    d_start, d_end = default_game_window(today or date.today())
    start, end = start or d_start, end or d_end
    return load_schedules(spark, wh, _schedules(spark, landing, start, end), load_ts)


def _schedules(spark: SparkSession, landing: str, start: date, end: date, must: bool = True) -> DataFrame:
    """(path, request_date, raw) of the schedules of a window of days; ``must``: each of them has to be there."""
    bounds = spark.range(1).select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"))
    days = L.dates_between(bounds, out="day").select(F.date_format("day", "yyyy-MM-dd").alias("key"))
    landed = P.Landing(spark, landing, "schedule")
    if must:
        landed.missing(days, fail="no schedule payload for").limit(1).collect()
    return landed.read(days).select("path", F.to_date("key").alias("request_date"), "raw")


def load_schedules(spark: SparkSession, wh: Warehouse, payloads: DataFrame,
                   load_ts: datetime | None = None) -> C.LoadResult:
    """R7 -> P6 -> P3 -> game_raw -> K5 over the staged range -> K6 for a set of schedule payloads."""
    if "request_date" not in payloads.columns:
        payloads = payloads.withColumn("request_date", F.to_date(P.payload_key("path", "schedule")))
    docs = P.parse_envelope(payloads)
    latest = P.latest_games(P.flatten_schedule(docs, keep=["request_date"], raw="raw"), ["request_date"])
    rows = P.game_to_staging(latest, keep=["request_date", "day_pos", "game_pos"])

    def calendar(batch_id: str) -> None:
        staged = P.stage_batch(wh.read("game_raw"), batch_id)
        rng = C.date_range(staged, "game_date").first()
        if rng.start_date is not None:
            populate_date_dim(wh, rng.start_date, rng.end_date)

    return _load(wh, "game_raw", rows, ["request_date", "day_pos", "game_pos"], load_ts, before_step=calendar)


def load_rosters(spark: SparkSession, wh: Warehouse, payloads: DataFrame,
                 load_ts: datetime | None = None) -> C.LoadResult:
    """R4 -> P2 -> player_raw -> K4 for a set of roster payloads ``roster/<CODE>.json``; the team of
    each roster is the team dimension's first team (by key) with that code, upper-cased (R5)."""
    teams = wh.read("team_dim").select("team_id", "team_key", X.normalize_code("team_abbreviation").alias("code"))
    teams = dedupe(teams.filter(F.col("code").isNotNull()), ["code"], ["team_key"], keep="first")
    landed = payloads.withColumn("code", F.upper(P.payload_key("path", "roster")))
    docs = P.parse_envelope(landed.join(teams, "code"))
    flat = P.flatten_rosters(docs, keep=["team_id", "path"], raw="raw")
    rows = P.player_to_staging(flat, keep=["path", "group_pos", "player_pos"])
    return _load(wh, "player_raw", rows, ["path", "group_pos", "player_pos"], load_ts)


def load_boxscores(spark: SparkSession, wh: Warehouse, payloads: DataFrame,
                  load_ts: datetime | None = None) -> C.LoadResult:
    """R8 -> P4 -> player_game_stats_raw -> fact (K7) for a set of landed boxscore payloads."""
    docs = P.parse_envelope(payloads.withColumn("game_id", P.payload_key("path", "boxscore").cast("long")))
    rows = P.stats_to_staging(P.flatten_boxscores(docs, game_col="game_id", raw="raw"),
                              keep=["side_pos", "group_pos", "player_pos"])
    return _load(wh, "player_game_stats_raw", rows, ["game_id", "side_pos", "group_pos", "player_pos"], load_ts)


@_in_scope
def load_player_game_stats(spark: SparkSession, wh: Warehouse, landing: str, start: date | None = None,
                           end: date | None = None, game_ids: str | None = None,
                           load_ts: datetime | None = None, today: date | None = None) -> C.LoadResult:
    """L4: explicit ids (F6, R10) or finished games of the schedules in the window (R9) -> boxscores
    (R8, a missing one fails) -> player_game_stats_raw -> fact (K7)."""
    ids = P.parse_game_ids(game_ids)
    if ids:
        wanted = spark.createDataFrame([(i,) for i in ids], "game_id long")
    else:
        d_start, d_end = default_stats_window(today or date.today())
        sched = _schedules(spark, landing, start or d_start, end or d_end, must=False)
        games = P.flatten_schedule(P.parse_envelope(sched)).select(
            F.try_variant_get("game", "$.id", "bigint").alias("game_id"),
            F.try_variant_get("game", "$.gameState", "string").alias("game_state"))
        wanted = P.final_game_ids(games)
    wanted = written(wanted.select(F.col("game_id").cast("string").alias("key")))
    boxscores = P.Landing(spark, landing, "boxscore")
    boxscores.missing(wanted, fail="no boxscore payload for game").limit(1).collect()
    docs = P.parse_envelope(boxscores.read(wanted).withColumn("game_id", F.col("key").cast("long")))
    flat = P.flatten_boxscores(docs, game_col="game_id", raw="raw")
    rows = P.stats_to_staging(flat, keep=["side_pos", "group_pos", "player_pos"])
    return _load(wh, "player_game_stats_raw", rows, ["game_id", "side_pos", "group_pos", "player_pos"], load_ts)


REPORT_TABLES = ("game_fact", "team_dim", "player_dim", "player_game_stats_fact", "date_dim")


def register_reports(wh: Warehouse) -> list[str]:
    """The four reports as temporary views, registered anew after each commit of ``wh`` to one of their tables."""
    def register(changed: set[str]) -> list[str]:
        if changed.isdisjoint(REPORT_TABLES):
            return []
        return R.register_views(wh.spark, {t: wh.read(t) for t in REPORT_TABLES})

    wh.after_commit.append(register)
    return register(set(REPORT_TABLES))


def run_all(spark: SparkSession, wh: Warehouse, landing: str, *, start: date | None = None,
            end: date | None = None, stats_start: date | None = None, codes: str | None = None,
            game_ids: str | None = None, replay_after: bool = False, today: date | None = None) -> list:
    """Teams, players, games, stats in order; stop at the first failed validation; optional replay."""
    steps = [
        lambda: load_teams(spark, wh, landing),
        lambda: load_players(spark, wh, landing, codes),
        lambda: load_games(spark, wh, landing, start, end, today=today),
        lambda: load_player_game_stats(spark, wh, landing, stats_start, end, game_ids, today=today),
    ]
    results = []
    for step in steps:
        result = step()
        results.append(result)
        if not result.ok:
            return results
    if replay_after:
        results.append(replay(spark, wh))
    return results


def replay(spark: SparkSession, wh: Warehouse) -> dict[str, tuple[int, int]]:
    """Calendar over the staged game range (A7, K5), then each load from its latest staged batch.

    Earlier steps stay committed when a later one fails.
    """
    rng = C.date_range(wh.read("game_raw"), "game_date").first()
    if rng is None or rng.start_date is None:
        raise L.LoadError("no staged games: the calendar range is unknown")
    populate_date_dim(wh, rng.start_date, rng.end_date)
    out = {}
    for staging, step in STEPS.items():
        latest = C.latest_batch(wh.read(staging), "load_batch_id", "created_date").first()
        if latest is None:
            raise L.LoadError(f"no staged batch in {staging}")
        batch_id = latest.batch_id
        load_ts = A.utc_now()
        out[staging] = run_step(wh, batch_id, lambda tx, s=step, b=batch_id, t=load_ts: s(tx, b, t))
    return out
