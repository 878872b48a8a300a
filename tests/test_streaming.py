"""Landing-folder stream: each micro-batch of new files is one audited load; reruns add nothing."""

import json
import os

from starload.plans.store import Warehouse
from starload.streaming.landing import start_landing_loads


def _land(root, name, obj):
    os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
    with open(os.path.join(root, name), "w") as fh:
        json.dump(obj, fh)


def test_teams_stream_loads_new_files_once(spark, wh_root, tmp_path):
    landing = str(tmp_path / "landing")
    _land(landing, "teams/2024-10-01.json", {"data": [{"id": 1, "fullName": "A", "triCode": "AAA"},
                                                       {"id": 2, "fullName": "B", "triCode": "BBB"}]})
    wh = Warehouse(spark, wh_root)
    ckpt = str(tmp_path / "ckpt")
    q = start_landing_loads(spark, wh, landing, "teams", checkpoint=ckpt)
    q.awaitTermination(300)
    assert [(r.inserted, r.updated) for r in q.results] == [(2, 0)]
    _land(landing, "teams/2024-10-02.json", {"data": [{"id": 2, "fullName": "B2", "triCode": "BBB"},
                                                       {"id": 3, "fullName": "C", "triCode": "CCC"}]})
    q = start_landing_loads(spark, wh, landing, "teams", checkpoint=ckpt)
    q.awaitTermination(300)
    assert [(r.inserted, r.updated) for r in q.results] == [(1, 1)]  # only the new file is read
    names = {r.team_id: r.team_name for r in wh.read("team_dim").collect()}
    assert names == {1: "A", 2: "B2", 3: "C"}


def test_all_kinds_stream_in_dependency_order(spark, wh_root, tmp_path):
    from tests.test_loads import land_sample
    from starload.operators import reports as R

    landing = str(tmp_path / "landing")
    land_sample(landing)
    wh = Warehouse(spark, wh_root)
    inserted = {}
    for kind in ("teams", "roster", "schedule", "boxscore"):
        q = start_landing_loads(spark, wh, landing, kind, checkpoint=str(tmp_path / f"ckpt-{kind}"))
        q.awaitTermination(600)
        inserted[kind] = sum(r.inserted for r in q.results)
    # team 98 ('ZZZ') has no roster file; team 99 ('bos') shares Boston's code, the first team by key wins
    assert inserted == {"teams": 6, "roster": 8, "schedule": 3, "boxscore": 12}
    got = {r["Team"]: r["Wins"] for r in R.team_season_summary(wh.read("game_fact"), wh.read("team_dim")).collect()}
    assert got == {"Boston Bruins": 1, "New York Rangers": 1, "Tampa Bay Lightning": 1, "Toronto Maple Leafs": 0}
