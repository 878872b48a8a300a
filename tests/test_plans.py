"""Plan properties that matter at scale, read from ``explain()`` of the catalog queries."""

import contextlib
import io

import pytest

import __spark_entry__ as E

SF_DIR = "/root/testdata/sf0.001"
QUERIES = E.queries()


def plan(spark, name: str) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES[name](spark, SF_DIR).explain()
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairing_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan(spark, "stage_batch_scan")
    assert "In(o_orderkey" in plan(spark, "explicit_ids_semi")
    # the window on cast(o_orderdate as date) is unwrapped into a timestamp range on the raw column
    assert "GreaterThanOrEqual(o_orderdate,1995-01-01T00:00)" in plan(spark, "date_range_filter")


def test_dedupe_limits_before_the_shuffle(spark):
    text = plan(spark, "last_wins_dedupe")
    partial = text.index("WindowGroupLimit", text.index("Exchange"))
    assert "Partial" in text[partial:partial + 400]


def test_team_summary_exchanges_only_partial_sums_of_the_fact(spark):
    """Below the dimension join the fact meets one exchange, fed by partial sums; above it only sums per name are exchanged."""
    text = plan(spark, "v_team_season_summary")
    above, below = text.split("Join", 1)
    assert below.count("Exchange hashpartitioning") == 1 and "Generate inline" in below
    assert "partial_count(1)" in below.split("Exchange hashpartitioning", 1)[1]
    assert above.count("Exchange hashpartitioning") == 1 and above.count("partial_sum") >= 1


def test_references_read_each_child_once(spark):
    """A child's references are unpivoted from one scan; the fact's columns are not read once a reference."""
    from starload.operators.checks import reference_violations
    from starload.schemas import REFERENCES, SCHEMAS

    tables = {t: spark.createDataFrame([], SCHEMAS[t]) for r in REFERENCES for t in (r[0], r[2])}
    out = reference_violations(tables, REFERENCES)
    assert {tuple(r) for r in out.collect()} == {(c, col, 0) for c, col, _, _ in REFERENCES}
    text = plan(spark, "reference_violations")
    assert text.count("Generate inline") == text.count("LeftAnti") == 3  # two loads, three children


def test_player_summary_aggregates_before_the_dimensions(spark):
    text = plan(spark, "v_player_season_summary")
    assert "partial_count(1)" in text
    # reading the tree from the top: names are grouped, then come the dimension joins, then the sums per key
    assert text.index("Join") < text.index("partial_count(1)")


def test_stats_are_dealt_by_game_once_in_parts_by_their_number(spark, monkeypatch):
    """The grouping of line items and the joins by game share one shuffle, whose parts grow with the table."""
    from starload.sources import roles

    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    monkeypatch.setattr(roles, "TASK_LINES", 500)
    text = plan(spark, "boxscore_flatten")
    assert f"{-(-lines // 500)}), REPARTITION_BY_NUM" in text
    # one exchange of the lines, one of the games that they are joined with
    assert text.count("Exchange hashpartitioning") == 2 and text.count("hashpartitioning(game_id") == 2


def test_payloads_are_parsed_once_and_entries_cast_once(spark):
    text = plan(spark, "stats_to_staging")
    assert text.count("parseJson") == 1
    assert text.count("StructField(playerId,IntegerType") == 1
    assert "partial_collect_list" in text and text.count("partial_collect_list") == 1


def test_stats_fact_load_computes_its_staged_rows_once(spark, monkeypatch):
    """Batch, history and the history's largest key read the kept rows, dealt by game; nothing stays kept afterwards."""
    from starload.operators import loads

    seen, load = [], loads.load_stats_fact

    def watched(staged, games, players, teams, existing):
        for df in (staged, existing, existing.groupBy().max("player_game_stats_key")):
            seen.append((df._jdf.queryExecution().withCachedData().toString().count("InMemoryRelation"),
                         df._jdf.queryExecution().sparkPlan().toString()))
        seen.append(staged)
        joined = existing._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan", 1)[0]
        assert "Exchange" not in joined.split("\n", 1)[-1], "the kept rows' dealing by game must serve the join"
        return load(staged, games, players, teams, existing)

    monkeypatch.setattr(loads, "load_stats_fact", watched)
    out = QUERIES["stats_fact_load"](spark, SF_DIR)
    *plans, staged = seen
    assert [n for n, _ in plans] == [1, 1, 1] and all("InMemoryTableScan" in p for _, p in plans)
    assert not staged.is_cached and staged.storageLevel == spark.range(1).storageLevel
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in text and "InMemoryRelation" not in text  # the result reads what the load wrote
    assert out.count() > 0
