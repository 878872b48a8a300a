"""Golden end-to-end sample run (L7) against the expected values of FIXTURES.md section 2."""

from datetime import datetime

from pyspark.sql import functions as F

from starload.operators import reports as R
from starload.plans import sample as S
from starload.plans.store import Warehouse

TS = datetime(2024, 11, 1, 8, 0, 0)

TEAM_SUMMARY = {  # team: games, wins, losses, goals for, against, shots for, against
    "Boston Bruins": (1, 1, 0, 4, 2, 32, 28),
    "New York Rangers": (2, 1, 1, 6, 7, 56, 65),
    "Tampa Bay Lightning": (1, 1, 0, 5, 3, 34, 29),
    "Toronto Maple Leafs": (2, 0, 2, 4, 7, 59, 59),
}
PLAYER_SUMMARY = {  # last name: games, goals, assists, points, shots, hits, blocks, pim, ice seconds
    "Panarin": (2, 2, 3, 5, 10, 1, 0, 0, 2473),
    "Fox": (2, 0, 3, 3, 4, 2, 5, 0, 2862),
    "Marchand": (1, 1, 1, 2, 4, 2, 0, 2, 1165),
    "Pastrnak": (1, 2, 1, 3, 6, 1, 0, 0, 1210),
    "Marner": (2, 0, 3, 3, 7, 0, 2, 0, 2356),
    "Matthews": (2, 2, 0, 2, 11, 2, 1, 0, 2403),
    "Hedman": (1, 1, 1, 2, 3, 1, 4, 2, 1512),
    "Kucherov": (1, 2, 2, 4, 7, 0, 0, 0, 1264),
}


def _tables(wh):
    return {t: wh.read(t) for t in ("game_fact", "team_dim", "player_dim", "player_game_stats_fact", "date_dim")}


def _audit(readback):
    return {r.load_batch_id: (r.status, r.rows_inserted, r.rows_updated) for r in readback.collect()}


def test_sample_run_golden_and_rerun(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    audit = _audit(S.run_sample(spark, wh, TS))
    assert audit == {S.TEAM_BATCH: ("Succeeded", 4, 0), S.PLAYER_BATCH: ("Succeeded", 8, 0),
                     S.GAME_BATCH: ("Succeeded", 3, 0), S.STATS_BATCH: ("Succeeded", 12, 0)}
    assert wh.read("date_dim").count() == 31

    t = _tables(wh)
    summary = R.team_season_summary(t["game_fact"], t["team_dim"]).collect()
    got = {r["Team"]: tuple(r[c] for c in ("Games Played", "Wins", "Losses", "Goals For", "Goals Against",
                                           "Shots For", "Shots Against")) for r in summary}
    assert got == TEAM_SUMMARY
    assert {r["Season"] for r in summary} == {"20242025"}

    players = R.player_season_summary(t["player_game_stats_fact"], t["game_fact"], t["player_dim"],
                                      t["team_dim"]).collect()
    got = {r["Player"].split(" ")[-1]: tuple(r[c] for c in (
        "Games Played", "Goals", "Assists", "Points", "Shots", "Hits", "Blocks", "Penalty Minutes",
        "Time On Ice Seconds")) for r in players}
    assert got == PLAYER_SUMMARY

    results = R.team_game_results(t["game_fact"], t["team_dim"], t["date_dim"]).orderBy("Game ID").collect()
    assert [r["Winning Team"] for r in results] == ["Boston Bruins", "Tampa Bay Lightning", "New York Rangers"]
    stats = R.player_game_stats(t["player_game_stats_fact"], t["game_fact"], t["player_dim"], t["team_dim"],
                                t["date_dim"])
    assert stats.count() == 12
    assert stats.agg(F.sum("Points")).first()[0] == stats.agg(F.sum("Goals") + F.sum("Assists")).first()[0]

    # properties: wins = losses over the season; each game counted twice
    s = R.team_season_summary(t["game_fact"], t["team_dim"]).agg(F.sum("Wins"), F.sum("Losses"),
                                                                  F.sum("Games Played")).first()
    assert s[0] == s[1] and s[2] == 2 * t["game_fact"].count()

    # surrogate keys are 1..n without repeats
    for table, key in (("team_dim", "team_key"), ("player_dim", "player_key"), ("game_fact", "game_key"),
                       ("player_game_stats_fact", "player_game_stats_key")):
        keys = sorted(r[0] for r in wh.read(table).select(key).collect())
        assert keys == list(range(1, len(keys) + 1)), table

    # second identical run without cleanup: nothing inserted or updated, calendar unchanged
    before = {k: wh.read(k).count() for k in ("team_dim", "player_dim", "game_fact", "player_game_stats_fact")}
    audit = _audit(S.run_sample(spark, wh, TS))
    assert set(audit.values()) == {("Succeeded", 0, 0)}
    assert wh.read("date_dim").count() == 31
    assert {k: wh.read(k).count() for k in before} == before
    assert wh.read("team_raw").count() == 4  # staged rows are not repeated


def test_sample_cleanup_removes_everything(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    S.run_sample(spark, wh, TS)
    S.cleanup_sample(spark, wh)
    for table in ("team_dim", "player_dim", "game_fact", "player_game_stats_fact", "date_dim", "load_batch",
                  "team_raw", "player_raw", "game_raw", "player_game_stats_raw"):
        assert wh.read(table).count() == 0, table


def test_cleanup_keeps_a_team_still_referenced(spark, wh_root):
    from datetime import date

    from starload.plans import jobs as J

    wh = Warehouse(spark, wh_root)
    S.run_sample(spark, wh, TS)
    keys = {r.team_id: r.team_key for r in wh.read("team_dim").collect()}
    other = spark.createDataFrame([(99, 2099000001, 20241020, "20242025", "Regular", keys[6], keys[3])],
                                  "game_key long, game_id long, date_key int, season string, game_type string, "
                                  "home_team_key int, away_team_key int")
    with wh.transaction() as tx:
        tx.append("game_fact", J.conform(other.withColumn("created_date", F.lit(TS)), "game_fact"))
    S.cleanup_sample(spark, wh)
    assert sorted(r.team_id for r in wh.read("team_dim").collect()) == [3, 6]  # guarded by the other game
    assert [r.game_id for r in wh.read("game_fact").collect()] == [2099000001]
    assert [r.full_date for r in wh.read("date_dim").collect()] == [date(2024, 10, 20)]
    assert wh.read("player_dim").count() == 0 and wh.read("player_game_stats_fact").count() == 0


def test_reset_batch_clears_the_outcome_and_stages_once(spark, wh_root):
    from starload.plans import audit as A

    wh = Warehouse(spark, wh_root)
    S.stage_sample(spark, wh, TS)
    with wh.transaction() as tx:
        tx.append("load_batch", A.events_frame(spark, [A.succeeded_event(S.TEAM_BATCH, 4, 0)]))
    state = A.current_state(wh.read("load_batch")).filter(F.col("load_batch_id") == S.TEAM_BATCH).first()
    assert (state.status, state.rows_inserted) == ("Succeeded", 4)
    S.stage_sample(spark, wh, TS)  # K11: back to Started with a NULL outcome; R13: rows not staged twice
    state = A.current_state(wh.read("load_batch")).filter(F.col("load_batch_id") == S.TEAM_BATCH).first()
    assert (state.status, state.rows_inserted, state.rows_updated, state.load_end_date) == ("Started", None, None,
                                                                                              None)
    assert state.source_system == "Sample Data"
    assert wh.read("team_raw").count() == 4 and wh.read("player_game_stats_raw").count() == 12
