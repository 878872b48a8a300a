"""Loads, keys, calendar, store atomicity and the source-load jobs from landed files."""

import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starload.operators import loads as L
from starload.operators import reports as R
from starload.operators.keys import assign_surrogate_keys
from starload.plans import audit as A
from starload.plans import jobs as J
from starload.plans import sample as S
from starload.plans.store import StoreError, Warehouse

TS = datetime(2024, 11, 1, 8, 0, 0)
TEAM_TGT = "team_id int, team_key int, team_name string, conference string, is_active boolean"


def test_surrogate_keys_dense_across_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("nk")).repartition(5)
    out = assign_surrogate_keys(df, "k", ["nk"], base=100)
    rows = sorted((r.k, r.nk) for r in out.collect())
    assert [k for k, _ in rows] == list(range(101, 5101))
    assert [nk for _, nk in rows] == sorted(nk for _, nk in rows)  # ascending in natural-key order


def test_upsert_sentinels_reactivation_and_new_keys(spark):
    tgt = spark.createDataFrame([(1, 11, "A", None, True), (2, 12, "B", "E", False), (3, 13, "C", "W", True)],
                                TEAM_TGT)
    src = spark.createDataFrame([(1, "A", ""), (2, "B", "E"), (3, "C", "X"), (4, "D", "E"), (5, "F", None)],
                                "team_id int, team_name string, conference string")
    res = L.upsert_type1(tgt, src, key="team_id", compare={"team_name": "", "conference": ""},
                         surrogate="team_key", created=None, modified=None)
    got = {r.team_id: (r.team_key, r.team_name, r.conference, r.is_active) for r in res.frame.collect()}
    assert got == {1: (11, "A", None, True),  # NULL -> '' is not a change
                   2: (12, "B", "E", True),  # inactive, unchanged: updated and active again
                   3: (13, "C", "X", True), 4: (14, "D", "E", True), 5: (15, "F", None, True)}
    assert sorted(r.team_id for r in res.changed.collect()) == [2, 3]
    dup = src.unionByName(spark.createDataFrame([(4, "D2", "E")], src.schema))
    with pytest.raises(L.LoadError, match="duplicate key"):
        L.upsert_type1(tgt, dup, key="team_id", compare={"team_name": ""}, surrogate="team_key", created=None,
                       modified=None)


def test_upsert_last_changed_row_wins(spark):
    tgt = spark.createDataFrame([(1, 11, "A", "E", True)], TEAM_TGT)
    src = spark.createDataFrame([(1, "A1", "E", 5), (1, "A2", "E", 9), (1, "A", "E", 12)],
                                "team_id int, team_name string, conference string, raw_id long")
    res = L.upsert_type1(tgt, src, key="team_id", compare={"team_name": "", "conference": ""},
                         surrogate="team_key", order=["raw_id"], created=None, modified=None)
    assert [r.team_name for r in res.frame.collect()] == ["A2"]  # changed rows first, then the last of them


def test_calendar_rules(spark):
    rows = L.populate_calendar(spark, date(2024, 10, 1), date(2024, 10, 31)).orderBy("full_date").collect()
    assert len(rows) == 31 and rows[0].date_key == 20241001 and rows[0].day_name == "Tuesday"
    assert rows[0].day_of_week == 3 and rows[4].is_weekend and rows[0].month_name == "October"
    existing = L.populate_calendar(spark, date(2024, 10, 20), date(2024, 11, 5))
    assert L.populate_calendar(spark, date(2024, 10, 1), date(2024, 10, 31), existing).count() == 19
    for bad in ((date(2024, 2, 1), date(2024, 1, 1)), (None, date(2024, 1, 1))):
        with pytest.raises(L.LoadError, match="calendar needs a start date"):
            L.populate_calendar(spark, *bad)
    big = L.populate_calendar(spark, date(1900, 1, 1), date(2024, 12, 31))
    assert big.count() == (date(2024, 12, 31) - date(1900, 1, 1)).days + 1  # no recursion cap


def test_failed_step_commits_nothing_but_the_failure(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    S.run_sample(spark, wh, TS)
    before = sorted(tuple(r) for r in wh.read("team_dim").select("team_id", "team_name").collect())

    def crash(tx):
        tx.replace("team_dim", tx.read("team_dim").withColumn("team_name", F.lit("broken")))
        raise RuntimeError("boom " + "x" * 5000)

    with pytest.raises(RuntimeError):
        J.run_step(wh, S.TEAM_BATCH, crash)
    assert sorted(tuple(r) for r in wh.read("team_dim").select("team_id", "team_name").collect()) == before
    state = A.current_state(wh.read("load_batch")).filter(F.col("load_batch_id") == S.TEAM_BATCH).first()
    assert (state.status, state.rows_inserted, state.rows_updated) == ("Failed", 0, 0)
    assert len(state.error_message) == 4000 and state.error_message.startswith("boom")


def test_staging_allow_list_and_empty_replay(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    with pytest.raises(StoreError, match="only staging tables"):
        with wh.transaction() as tx:
            tx.refresh_staging("team_dim", spark.createDataFrame([], "a int"))
    with pytest.raises(L.LoadError, match="no staged games"):
        J.replay(spark, wh)


def test_duplicate_new_key_fails_batch(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    rows = spark.createDataFrame([(1, 7, "A"), (2, 7, "B")], "team_pos int, team_id int, team_name string")
    with pytest.raises(L.LoadError):
        J._load(wh, "team_raw", rows, ["team_pos"], TS)
    assert wh.read("team_dim").count() == 0
    assert A.current_state(wh.read("load_batch")).first().status == "Failed"


# ---- source loads from landed payload files -------------------------------------------------------

def _write(root, rel, obj):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        json.dump(obj, fh)


def land_sample(root):
    """Landed API payloads carrying the sample data (weekly schedule windows overlap)."""
    _write(root, "teams/teams.json", {"data": [
        {"id": t[0], "fullName": t[1], "triCode": t[2], "conferenceName": t[3], "divisionName": t[4]}
        for t in S.SAMPLE_TEAMS] + [{"id": 99, "fullName": "Old Bruins", "triCode": "bos"},
                                    {"id": 98, "fullName": "No Roster", "triCode": "ZZZ"}]})
    codes = {t[0]: t[2] for t in S.SAMPLE_TEAMS}
    for team_id, code in codes.items():
        players = [p for p in S.SAMPLE_PLAYERS if p[1] == team_id]
        entry = lambda p: {"id": p[0], "firstName": {"default": p[2]}, "lastName": {"default": p[3]},
                           "positionCode": p[4], "shootsCatches": p[5], "birthDate": p[6]}
        _write(root, f"roster/{code}.json", {
            "forwards": [entry(p) for p in players if p[4] != "D"],
            "defensemen": [entry(p) for p in players if p[4] == "D"], "goalies": []})
    games = {g[1]: g for g in S.SAMPLE_GAMES}
    first = date(2024, 10, 5)
    for i in range(8):
        d0 = first + timedelta(days=i)
        week = []
        for j in range(7):
            d = (d0 + timedelta(days=j)).isoformat()
            g = games.get(d)
            week.append({"date": d, "games": [] if g is None else [{
                "id": g[0], "season": int(S.SAMPLE_SEASON), "gameType": 2, "gameState": "OFF",
                "homeTeam": {"id": g[2], "score": g[4], "sog": g[6]},
                "awayTeam": {"id": g[3], "score": g[5], "sog": g[7]}}]})
        _write(root, f"schedule/{d0.isoformat()}.json", {"gameWeek": week})
    for g in S.SAMPLE_GAMES:
        side = {}
        for team_id, name in ((g[2], "homeTeam"), (g[3], "awayTeam")):
            side[name] = {"forwards": [{"playerId": s[1], "goals": s[3], "assists": s[4], "sog": s[5], "hits": s[6],
                                        "blockedShots": s[7], "pim": s[8],
                                        "toi": f"{s[9] // 60}:{s[9] % 60:02d}"}
                                       for s in S.SAMPLE_STATS if s[0] == g[0] and s[2] == team_id],
                          "defense": [], "goalies": []}
        _write(root, f"boxscore/{g[0]}.json", {"awayTeam": {"id": g[3]}, "homeTeam": {"id": g[2]},
                                               "playerByGameStats": side})


def test_run_all_from_landed_files_then_replay(spark, wh_root, tmp_path):
    landing = str(tmp_path / "landing")
    land_sample(landing)
    wh = Warehouse(spark, wh_root)
    results = J.run_all(spark, wh, landing, start=date(2024, 10, 5), end=date(2024, 10, 12),
                        stats_start=date(2024, 10, 5))
    # team 99 shares the code 'BOS' (other case): a team of its own, but its roster is not fetched (R5);
    # team 98 has no roster file: skipped with a message
    assert [(r.inserted, r.updated, r.ok) for r in results] == [(6, 0, True), (8, 0, True), (3, 0, True),
                                                                (12, 0, True)]
    assert results[0].staged == 6
    t = {k: wh.read(k) for k in ("game_fact", "team_dim", "player_dim", "player_game_stats_fact")}
    got = {r["Team"]: (r["Wins"], r["Losses"], r["Goals For"])
           for r in R.team_season_summary(t["game_fact"], t["team_dim"]).collect()}
    assert got == {"Boston Bruins": (1, 0, 4), "New York Rangers": (1, 1, 6), "Tampa Bay Lightning": (1, 0, 5),
                   "Toronto Maple Leafs": (0, 2, 4)}
    assert wh.read("date_dim").count() == 8  # calendar over the staged game range, before the fact load
    out = J.replay(spark, wh)
    assert out == {"team_raw": (0, 0), "player_raw": (0, 0), "game_raw": (0, 0), "player_game_stats_raw": (0, 0)}


def test_text_compare_option(spark):
    tgt = spark.createDataFrame([(1, 11, "Abc", "E", True)], TEAM_TGT)
    src = spark.createDataFrame([(1, "abc  ", "E")], "team_id int, team_name string, conference string")
    cmp = {"team_name": "", "conference": ""}
    assert L.changed_rows(tgt, src, key="team_id", compare=cmp).count() == 1
    assert L.changed_rows(tgt, src, key="team_id", compare=cmp, text_compare="ci_rtrim").count() == 0


def test_default_windows():
    from starload.operators.filters import default_game_window, default_stats_window, season_opening
    assert season_opening(date(2025, 3, 4)) == date(2024, 9, 1)
    assert season_opening(date(2025, 9, 1)) == date(2025, 9, 1)
    assert default_game_window(date(2025, 10, 2)) == (date(2025, 9, 1), date(2025, 10, 2))
    assert default_stats_window(date(2025, 10, 8)) == (date(2025, 10, 1), date(2025, 10, 8))


def test_register_views_over_warehouse(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    S.run_sample(spark, wh, TS)
    names = R.register_views(spark, {t: wh.read(t) for t in ("game_fact", "team_dim", "player_dim",
                                                              "player_game_stats_fact", "date_dim")})
    assert sorted(names) == ["v_player_game_stats", "v_player_season_summary", "v_team_game_results",
                             "v_team_season_summary"]
    row = spark.sql("select `Wins`, `Losses` from v_team_season_summary where `Team` = 'Boston Bruins'").first()
    assert (row.Wins, row.Losses) == (1, 0)
    assert spark.sql("select count(*) from v_player_game_stats").first()[0] == 12


def test_report_views_follow_commits(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    J.register_reports(wh)
    assert spark.table("v_player_game_stats").count() == 0
    S.run_sample(spark, wh, TS)
    assert spark.table("v_player_game_stats").count() == 12
    S.cleanup_sample(spark, wh)
    assert spark.table("v_player_game_stats").count() == 0


def test_zero_row_load_succeeds_with_zero(spark, wh_root, tmp_path):
    landing = str(tmp_path / "landing")
    _write(landing, "teams/teams.json", {"data": []})
    wh = Warehouse(spark, wh_root)
    r = J.load_teams(spark, wh, landing, TS)
    assert (r.staged, r.inserted, r.updated, r.ok) == (0, 0, 0, True)
    assert A.current_state(wh.read("load_batch")).first().status == "Succeeded"


def test_constraints_enforced_on_write(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    rows = spark.createDataFrame([(1, 7, "X" * 101)], "team_pos int, team_id int, team_name string")
    with pytest.raises(Exception, match="longer than 100 characters in team_raw.team_name"):
        J._load(wh, "team_raw", rows, ["team_pos"], TS)
    assert wh.read("team_raw").count() == 0 and wh.read("load_batch").count() == 0  # commit 1 never happened
    ok = spark.createDataFrame([(1, 7, "Seven")], "team_pos int, team_id int, team_name string")
    assert J._load(wh, "team_raw", ok, ["team_pos"], TS).inserted == 1


def test_stale_writer_cannot_commit(spark, wh_root):
    a, b = Warehouse(spark, wh_root), Warehouse(spark, wh_root)
    assert a.tables() == {} and b.tables() == {}
    with a.transaction() as tx:
        tx.append("load_batch", A.events_frame(spark, [A.start_event("x")]))
    with pytest.raises(StoreError, match="Concurrent commit"):
        with b.transaction() as tx:
            tx.append("load_batch", A.events_frame(spark, [A.start_event("y")]))
    b.refresh()
    with b.transaction() as tx:
        tx.append("load_batch", A.events_frame(spark, [A.start_event("y")]))
    a.refresh()
    assert sorted(r.load_batch_id for r in a.read("load_batch").collect()) == ["x", "y"]


def test_upsert_without_order_never_duplicates_a_target_row(spark):
    tgt = spark.createDataFrame([(1, 11, "A", "E", True)], TEAM_TGT)
    src = spark.createDataFrame([(1, "B", "E"), (1, "C", "E")], "team_id int, team_name string, conference string")
    res = L.upsert_type1(tgt, src, key="team_id", compare={"team_name": "", "conference": ""},
                         surrogate="team_key", created=None, modified=None)
    assert [(r.team_id, r.team_name) for r in res.frame.collect()] == [(1, "C")]


def test_missing_schedule_or_boxscore_fails_the_load(spark, wh_root, tmp_path):
    landing = str(tmp_path / "landing")
    land_sample(landing)
    wh = Warehouse(spark, wh_root)
    with pytest.raises(Exception, match="no schedule payload for: 2024-10-13"):
        J.load_games(spark, wh, landing, date(2024, 10, 5), date(2024, 10, 13))  # files exist up to 10-12
    with pytest.raises(Exception, match="no boxscore payload for game: 2024020009"):
        J.load_player_game_stats(spark, wh, landing, game_ids="2024020001, 2024020009")
    assert wh.read("game_raw").count() == 0 and wh.read("player_game_stats_raw").count() == 0


def test_two_team_files_keep_the_last_row_per_team(spark, wh_root, tmp_path):
    landing = str(tmp_path / "landing")
    entry = lambda i, name: {"id": i, "fullName": name, "triCode": f"T{i}"}
    _write(landing, "teams/2024-10-01.json", {"data": [entry(1, "A"), entry(2, "B"), entry(4, "D")]})
    _write(landing, "teams/2024-10-02.json", {"data": [entry(3, "C"), entry(2, "B2"), entry(1, "A2")]})
    wh = Warehouse(spark, wh_root)
    result = J.load_teams(spark, wh, landing, TS)
    assert (result.staged, result.inserted, result.updated) == (4, 4, 0)
    assert {r.team_id: r.team_name for r in wh.read("team_dim").collect()} == {1: "A2", 2: "B2", 3: "C", 4: "D"}
    _write(landing, "teams/2024-10-03.json", {"data": [entry(5, "E"), entry(5, "E again")]})
    with pytest.raises(L.LoadError, match="duplicate key"):  # twice in one payload is an error, as on the host
        J.load_teams(spark, wh, landing, TS)
    assert wh.read("team_dim").count() == 4


def test_failed_transaction_leaves_no_directory(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    with pytest.raises(RuntimeError, match="boom"):
        with wh.transaction() as tx:
            tx.append("date_dim", J.conform(L.populate_calendar(spark, date(2024, 1, 1), date(2024, 1, 3)), "date_dim"))
            raise RuntimeError("boom")
    assert not os.path.isdir(os.path.join(wh_root, "date_dim")) or os.listdir(os.path.join(wh_root, "date_dim")) == []
    assert wh.read("date_dim").count() == 0


def test_reference_without_parent_fails_the_step(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    S.run_sample(spark, wh, TS)
    orphan = wh.read("game_fact").limit(1).withColumns({
        "game_key": F.lit(900).cast("long"), "game_id": F.lit(900).cast("long"), "home_team_key": F.lit(77)})

    def step(tx):
        return J.check_references(tx, "game_fact", tx.append("game_fact", J.conform(orphan, "game_fact"))).count(), 0

    with pytest.raises(L.LoadError, match="1 rows of game_fact have a home_team_key without a parent row"):
        J.run_step(wh, "b-900", step)
    assert wh.read("game_fact").filter("game_key = 900").count() == 0
    state = A.current_state(wh.read("load_batch")).filter("load_batch_id = 'b-900'").first()
    assert state.status == "Failed"


def test_player_of_a_loaded_game_under_another_team_fails(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    S.run_sample(spark, wh, TS)
    first = S.SAMPLE_STATS[0]
    other = next(t[0] for t in S.SAMPLE_TEAMS if t[0] != first[2])
    rows = spark.createDataFrame([(first[0], first[1], other, "{}")],
                                 "game_id long, player_id int, team_id int, raw_json string")
    with pytest.raises(L.LoadError, match="duplicate key player_game_stats_fact"):
        J._load(wh, "player_game_stats_raw", rows, ["game_id", "player_id"], TS)
    assert wh.read("player_game_stats_fact").count() == 12
