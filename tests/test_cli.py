"""The command line runs the loads end to end (L5) and the replay."""

import json

from starload.__main__ import main
from tests.test_loads import land_sample


def test_cli_all_then_replay(spark, wh_root, tmp_path, capsys):
    landing = str(tmp_path / "landing")
    land_sample(landing)
    code = main(["all", "--warehouse", wh_root, "--landing", landing, "--start-date", "2024-10-05",
                 "--end-date", "2024-10-12", "--stats-start-date", "2024-10-05", "--master", "local[4]"])
    assert code == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert [r["inserted"] for r in lines] == [6, 8, 3, 12] and all(r["duplicates"] == 0 for r in lines)
    assert main(["replay", "--warehouse", wh_root]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {
        "team_raw": [0, 0], "player_raw": [0, 0], "game_raw": [0, 0], "player_game_stats_raw": [0, 0]}
