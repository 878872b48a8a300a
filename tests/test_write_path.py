"""What a load reads, writes and leaves behind: one pass, partitions, carried counts, landed keys, no temporary data."""

import json
import os
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starload.operators import loads as L
from starload.operators.keys import assign_surrogate_keys
from starload.plans import audit as A
from starload.plans import jobs as J
from starload.plans import sample as S
from starload.plans.store import Warehouse
from starload.session import ensure_checkpoint_dir, scratch_scope
from starload.sources import payloads as P
from tests.test_loads import _write, land_sample

TS = datetime(2024, 11, 1, 8, 0, 0)
TABLES = ("team_dim", "player_dim", "game_fact", "player_game_stats_fact", "date_dim", "game_raw", "load_batch")


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def temporary(spark) -> set[str]:
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {os.path.join(d, f) for d, _, files in os.walk(root) for f in files}


def other_season(spark, wh):
    """A game of the season before, with one player's stats, next to the sample's."""
    with wh.transaction() as tx:
        games = spark.createDataFrame([(90, 2023020001, 20241020, "20232024", "Regular", 1, 2)],
                                      "game_key long, game_id long, date_key int, season string, game_type string, "
                                      "home_team_key int, away_team_key int")
        tx.append("game_fact", J.conform(games.withColumn("created_date", F.lit(TS)), "game_fact"))
        stats = spark.createDataFrame([(700, 2023, 90, 1, 1, *[0] * 6)],
                                      "player_game_stats_key long, id_season long, game_key long, player_key int, team_key int, "
                                      "goals int, assists int, shots int, hits int, blocks int, penalty_minutes int")
        tx.append("player_game_stats_fact", J.conform(stats.withColumn("created_date", F.lit(TS)), "player_game_stats_fact"))


# ---- K15, K3, K4: one pass ---------------------------------------------------------------------

def test_upsert_reads_each_side_once(spark, tmp_path):
    for name, rows, schema in (("target", [(1, 11, "A", True)], "team_id int, team_key int, team_name string, is_active boolean"),
                               ("source", [(1, "B"), (2, "C")], "team_id int, team_name string")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "source"))
    rows = L.classify_type1(target, source, key="team_id", compare={"team_name": ""}, surrogate="team_key", load_ts=None, order=None,
                            active="is_active", created=None, modified=None, text_compare="binary")
    physical = plan_of(rows).split("== Physical Plan ==")[1]
    assert physical.count("FileScan") == 2 and "FullOuter" in physical
    res = L.upsert_type1(target, source, key="team_id", compare={"team_name": ""}, surrogate="team_key", created=None, modified=None)
    assert (res.rows_inserted, res.rows_updated) == (1, 1)
    assert [tuple(r) for r in res.inserted.collect()] == [(2, 12, "C", True)]


def test_keys_come_from_written_files(spark):
    """The same numbers each time the result is read, though its input is not deterministic."""
    with scratch_scope(spark):
        out = assign_surrogate_keys(spark.range(0, 3000, 1, 6).select("id", F.rand().alias("r")), "k", ["r"], base=7)
        first = sorted((r.k, r.id) for r in out.collect())
        assert first == sorted((r.k, r.id) for r in out.repartition(3).collect())
        assert [k for k, _ in first] == list(range(8, 3008))
        assert "RDD" not in plan_of(out)  # no checkpointed or recomputed rows, only files


def test_a_load_leaves_no_temporary_data(spark, wh_root, tmp_path):
    before = temporary(spark)
    landing = str(tmp_path / "landing")
    land_sample(landing)
    J.run_all(spark, Warehouse(spark, wh_root), landing, start=date(2024, 10, 5), end=date(2024, 10, 12), stats_start=date(2024, 10, 5))
    S.run_sample(spark, Warehouse(spark, wh_root), TS)
    assert temporary(spark) == before


# ---- K6, K7, K12, C6: partitions and carried counts -------------------------------------------

def test_history_is_pruned_to_the_seasons_of_the_batch(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    S.run_sample(spark, wh, TS)
    other_season(spark, wh)
    assert L.id_seasons(wh.read("game_raw")) == [2024]
    for table in J.PARTITIONS:
        whole, pruned = wh.read(table), wh.read(table, parts=[2024])
        assert len({f.split("id_season=")[1][:4] for f in whole.inputFiles()}) == 2
        assert {f.split("id_season=")[1][:4] for f in pruned.inputFiles()} == {"2024"}
        assert re.search(r"PartitionFilters: \[[^\]]*id_season", plan_of(pruned))
        assert pruned.count() == whole.count() - 1
    # a load of the sample's batches finds its rows in the history: nothing is inserted twice
    assert J.replay(spark, wh)["player_game_stats_raw"] == (0, 0)


def test_a_game_that_changes_its_season_is_still_found(spark, wh_root):
    """The partition follows from the game id, so another season text does not hide the game."""
    wh = Warehouse(spark, wh_root)
    S.run_sample(spark, wh, TS)
    game = S.SAMPLE_GAMES[0]
    rows = spark.createDataFrame([(game[0], date.fromisoformat(game[1]), "20992100", "2", game[2], game[3])],
                                 "game_id long, game_date date, season string, game_type string, home_team_id int, away_team_id int")
    result = J._load(wh, "game_raw", rows, ["game_id"], TS)
    assert (result.staged, result.inserted, result.rows_before, result.rows_after) == (1, 0, 3, 3)


def test_cleanup_rewrites_touched_partitions_only(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    S.run_sample(spark, wh, TS)
    other_season(spark, wh)
    before = {t: set(wh.read(t, parts=[2023]).inputFiles()) for t in J.PARTITIONS}
    S.cleanup_sample(spark, wh)
    for table in J.PARTITIONS:
        assert set(wh.read(table).inputFiles()) == before[table] and wh.read(table).count() == wh.rows(table) == 1
    S.run_sample(spark, wh, TS)  # keys go on after the largest ever given
    assert sorted(r.game_key for r in wh.read("game_fact").collect()) == [90, 91, 92, 93]


def test_counts_are_carried_by_the_writes(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    for step in (lambda: S.run_sample(spark, wh, TS), lambda: J.replay(spark, wh), lambda: S.cleanup_sample(spark, wh)):
        step()
        assert {t: wh.rows(t) for t in TABLES} == {t: wh.read(t).count() for t in TABLES}
        assert {t: Warehouse(spark, wh_root).rows(t) for t in TABLES} == {t: wh.rows(t) for t in TABLES}


# ---- K9, K13, T3 ----------------------------------------------------------------------------------

def test_audit_state_is_kept_in_one_directory(spark, wh_root):
    wh = Warehouse(spark, wh_root)
    for k in range(12):
        with wh.transaction() as tx:
            A.record(tx, [A.start_event(f"b{k % 3}", at=TS)])
        J.run_step(wh, f"b{k % 3}", lambda tx, n=k: (n, 0))
    assert len(wh.tables()["load_batch"]) == 1 and wh.rows("load_batch") == 3
    state = {r.load_batch_id: (r.status, r.rows_inserted, r.load_start_date) for r in A.current_state(wh.read("load_batch")).collect()}
    assert state == {f"b{k}": ("Succeeded", 9 + k, TS) for k in range(3)}


def test_a_failing_hook_leaves_the_outcome(spark, wh_root):
    wh = Warehouse(spark, wh_root)

    def hook(changed):
        raise RuntimeError("no view")

    wh.after_commit.append(hook)
    rows = spark.createDataFrame([(1, 7, "A")], "team_pos int, team_id int, team_name string")
    assert J._load(wh, "team_raw", rows, ["team_pos"], TS).inserted == 1
    assert A.current_state(wh.read("load_batch")).first().status == "Succeeded"


# ---- L2-L4, R6: landing by key --------------------------------------------------------------------

def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "key string")


def test_only_the_wanted_files_are_read(spark, tmp_path):
    land_sample(str(tmp_path))
    week = keys(spark, *(f"2024-10-{d:02d}" for d in range(6, 9)))
    landing = P.Landing(spark, str(tmp_path), "schedule")
    got = landing.read(week)
    assert sorted(os.path.basename(f) for f in got.inputFiles()) == [f"2024-10-{d:02d}.json" for d in range(6, 9)]
    assert sorted(r.key for r in got.collect()) == [f"2024-10-{d:02d}" for d in range(6, 9)]
    names = plan_of(landing.files())
    assert "ReadSchema: struct<path:string>" in names  # a listing: no content is read
    assert [r.key for r in landing.missing(keys(spark, "2024-10-06", "2024-11-01")).collect()] == ["2024-11-01"]
    assert [r.key for r in P.Landing(spark, str(tmp_path), "roster").read(keys(spark, "BOS")).collect()] == ["BOS"]


def test_json_lines_hold_many_documents(spark, wh_root, tmp_path):
    """Payloads landed as JSON lines load like files, and only the wanted buckets are read."""
    files, lines = str(tmp_path / "files"), str(tmp_path / "lines")
    land_sample(files)
    bucket = {"schedule": lambda k: k[:7], "boxscore": lambda k: k[:4], "roster": lambda k: k[0]}
    for kind, of in bucket.items():
        for name in os.listdir(f"{files}/{kind}"):
            key = name.removesuffix(".json")
            with open(f"{files}/{kind}/{name}") as fh:
                payload = json.load(fh)
            path = f"{lines}/{kind}/bucket={of(key)}/all.jsonl"
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "a") as out:
                out.write(json.dumps({"key": key, "payload": payload}) + "\n")
    _write(lines, "schedule/bucket=2031-01/broken.jsonl", ["never read"])
    with open(f"{files}/teams/teams.json") as fh:
        _write(lines, "teams/teams.json", json.load(fh))
    a, b = Warehouse(spark, wh_root + "-a"), Warehouse(spark, wh_root + "-b")
    for wh, landing in ((a, files), (b, lines)):
        results = J.run_all(spark, wh, landing, start=date(2024, 10, 5), end=date(2024, 10, 12), stats_start=date(2024, 10, 5))
        assert [r.inserted for r in results] == [6, 8, 3, 12]
    for table in ("player_dim", "game_fact", "player_game_stats_fact"):
        rows = lambda wh: sorted(map(str, wh.read(table).drop("created_date").collect()))
        assert rows(a) == rows(b)
    with pytest.raises(Exception, match="no schedule payload for: 2024-10-13"):
        J.load_games(spark, b, lines, date(2024, 10, 5), date(2024, 10, 13))


def test_lines_pass_the_payload_through_as_written(spark, tmp_path):
    raw = '{"b": 1.50, "a" : {"z":"é","y":[1 , 2]}}'
    os.makedirs(tmp_path / "boxscore/bucket=2024")
    (tmp_path / "boxscore/bucket=2024/x.jsonl").write_text('{"key":"2024000001","payload":' + raw + "}\n", encoding="utf-8")
    got = P.Landing(spark, str(tmp_path), "boxscore").read(keys(spark, "2024000001")).collect()
    assert [(r.key, r.raw) for r in got] == [("2024000001", raw)]


# ---- R3, R8: ids out of range ---------------------------------------------------------------------

def test_ids_out_of_range_raise(spark):
    side = '{"forwards":[{"playerId":1}],"defense":[],"goalies":[]}'
    box = '{"awayTeam":{"id":%s},"homeTeam":{"id":6},"playerByGameStats":{"awayTeam":' + side + ',"homeTeam":' + side + "}}"
    docs = spark.createDataFrame([(1, box % "99999999999", "x")], "game_id long, raw string, path string")
    with pytest.raises(Exception, match="boxscore side|awayTeam|invalid id: 99999999999"):
        P.flatten_boxscores(P.parse_envelope(docs)).collect()
    fine = spark.createDataFrame([(1, box % "null", "x")], "game_id long, raw string, path string")
    assert [r.team_id for r in P.flatten_boxscores(P.parse_envelope(fine)).collect()] == [6]
    teams = lambda i: spark.createDataFrame([('{"data":[{"id":%s,"triCode":"A"},{"id":2,"triCode":"B"}]}' % i, "x")], "raw string, path string")
    with pytest.raises(Exception, match="team entry with an invalid id: 99999999999"):
        P.team_reference(P.flatten_teams(P.parse_envelope(teams("99999999999")))).collect()
    assert [r.team_id for r in P.team_reference(P.flatten_teams(P.parse_envelope(teams("null")))).collect()] == [2]
