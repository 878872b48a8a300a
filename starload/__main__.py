"""Command line for the loads: ``python -m starload <command> --warehouse ROOT [--landing DIR] ...``.

Commands mirror the reference's loaders: teams, players, games, stats, all (in order, stopping at the first
failed validation, optional replay), replay (from the latest staged batches), sample, cleanup-sample.
Exit code 1 when a load's duplicate check fails, as the reference's loaders do.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date

from starload.plans import jobs as J
from starload.plans import sample as S
from starload.plans.store import Warehouse
from starload.session import job_session


def _date(text: str | None) -> date | None:
    return date.fromisoformat(text) if text else None


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="starload")
    ap.add_argument("command", choices=["teams", "players", "games", "stats", "all", "replay", "sample",
                                        "cleanup-sample"])
    ap.add_argument("--warehouse", required=True, help="warehouse root folder (shared file system)")
    ap.add_argument("--landing", help="landing folder with teams/, roster/, schedule/, boxscore/")
    ap.add_argument("--start-date")
    ap.add_argument("--end-date")
    ap.add_argument("--stats-start-date")
    ap.add_argument("--team-abbrevs", help="comma list of team codes for the players load")
    ap.add_argument("--game-ids", help="comma list of game ids for the stats load")
    ap.add_argument("--replay", action="store_true", help="with 'all': replay the loads from staging at the end")
    ap.add_argument("--master", default=None, help="Spark master; unset: the one of spark-submit or the configuration")
    a = ap.parse_args(argv)

    spark = job_session(a.master)
    if not (spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)):
        spark.sparkContext.setCheckpointDir(f"{a.warehouse.rstrip('/')}/_checkpoints")
    wh = Warehouse(spark, a.warehouse)
    start, end = _date(a.start_date), _date(a.end_date)
    if a.command == "teams":
        results = [J.load_teams(spark, wh, a.landing)]
    elif a.command == "players":
        results = [J.load_players(spark, wh, a.landing, a.team_abbrevs)]
    elif a.command == "games":
        results = [J.load_games(spark, wh, a.landing, start, end)]
    elif a.command == "stats":
        results = [J.load_player_game_stats(spark, wh, a.landing, _date(a.stats_start_date) or start, end,
                                            a.game_ids)]
    elif a.command == "all":
        results = J.run_all(spark, wh, a.landing, start=start, end=end, stats_start=_date(a.stats_start_date),
                            codes=a.team_abbrevs, game_ids=a.game_ids, replay_after=a.replay)
    elif a.command == "replay":
        print(json.dumps(J.replay(spark, wh)))
        return 0
    elif a.command == "sample":
        for r in S.run_sample(spark, wh).collect():
            print(r.asDict())
        return 0
    else:
        S.cleanup_sample(spark, wh)
        return 0
    ok = True
    for r in results:
        if isinstance(r, dict):
            print(json.dumps(r))
            continue
        print(json.dumps({"load_batch_id": r.load_batch_id, "staged": r.staged, "before": r.rows_before,
                          "after": r.rows_after, "inserted": r.inserted, "updated": r.updated,
                          "duplicates": r.duplicates}))
        ok = ok and r.ok
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
