"""DuckDB oracle SQL for the catalog queries.

Every statement starts with the same role mapping (as CTEs over the driver's
tables) that ``starload.sources.roles`` builds on the Spark side, then states the
expected result in plain SQL, independently of the Spark operators.
"""

from __future__ import annotations

from starload.schemas import SOURCE_SYSTEM

MAPPING = {
    "m_team": """select n_nationkey as team_id, n_nationkey + 1000 as team_key, n_name as team_name,
  r_name as conference from nation join region on r_regionkey = n_regionkey""",
    "m_player": """select s_suppkey as player_id, s_suppkey + 1000 as player_key, s_nationkey as team_id,
  s_name as full_name,
  case when s_suppkey % 3 = 0 then 'D' when s_suppkey % 3 = 1 then 'C' else 'G' end as position_code
  from supplier""",
    "m_game": """select o_orderkey as game_id, o_orderkey + 1000 as game_key, cast(o_orderdate as date) as game_date,
  cast(case when month(o_orderdate) >= 9 then year(o_orderdate) else year(o_orderdate) - 1 end as varchar) as season,
  o_orderpriority as game_type, c_nationkey as home_team_id, cast((o_orderkey + o_custkey) % 25 as int) as away_team_id,
  case when o_orderstatus = 'P' then null else cast(o_orderkey % 7 as int) end as home_goals,
  case when o_orderstatus = 'P' then null else cast(o_custkey % 7 as int) end as away_goals,
  cast(20 + o_orderkey % 20 as int) as home_shots, cast(20 + o_custkey % 20 as int) as away_shots,
  case when o_orderstatus = 'P' then 'FUT' when o_orderstatus = 'F' then 'FINAL' else 'OFF' end as game_state
  from orders join customer on c_custkey = o_custkey""",
    "m_stats_all": """select l_orderkey as game_id, l_suppkey as player_id, l_orderkey * 8 + l_linenumber as raw_id,
  l_partkey, l_linenumber, cast(l_quantity as int) as qty, l_returnflag, l_linestatus from lineitem""",
    "m_stats": """select game_id, player_id, cast(min(qty) % 4 as int) as goals,
  cast(min(l_linenumber) % 3 as int) as assists, cast(max(qty) % 9 as int) as shots,
  cast(min(l_partkey) % 5 as int) as hits, cast(max(l_partkey) % 4 as int) as blocks,
  case when max(case when l_returnflag = 'A' then 1 else 0 end) = 1 then null else 2 end as penalty_minutes,
  case when max(case when l_linestatus = 'F' then 1 else 0 end) = 1 then cast(600 + min(l_partkey) % 900 as int)
  end as time_on_ice_seconds
  from m_stats_all group by game_id, player_id""",
    "m_stats_fact": """select s.game_id, s.player_id, p.team_id, coalesce(s.goals, 0) as goals,
  coalesce(s.assists, 0) as assists, coalesce(s.goals, 0) + coalesce(s.assists, 0) as points, s.shots, s.hits,
  s.blocks, coalesce(s.penalty_minutes, 0) as penalty_minutes, s.time_on_ice_seconds
  from m_stats s join m_player p on p.player_id = s.player_id""",
    "m_team_src": """select team_id,
  case when team_id % 5 = 0 then concat(team_name, '_X') when team_id % 5 = 4 then cast(null as varchar)
  else team_name end as team_name,
  case when team_id % 5 = 1 then '' else conference end as conference from m_team""",
    "m_team_tgt": """select team_id, team_key, team_name,
  case when team_id % 5 = 1 then cast(null as varchar) else conference end as conference,
  team_id <> 7 as is_active from m_team where team_id < 20""",
    "m_player_src": """select player_id, team_id, split_part(full_name, '#', 1) as first_name,
  split_part(full_name, '#', 2) as last_name,
  case when player_id % 5 = 0 then '' when player_id % 11 = 0 then null else full_name end as full_name,
  position_code from m_player""",
    "m_player_tgt": """select player_id, player_key, team_id + 1000 as team_key,
  case when player_id % 4 = 0 then full_name || ' old' else full_name end as full_name, position_code,
  true as is_active from m_player where player_id % 7 <> 0""",
}

WITH_MAPPING = "with " + ",\n".join(f"{k} as ({v})" for k, v in MAPPING.items())


def q(body: str, *ctes: tuple[str, str]) -> str:
    """Statement = mapping CTEs + extra CTEs + body."""
    extra = "".join(f",\n{name} as ({sql})" for name, sql in ctes)
    return f"{WITH_MAPPING}{extra}\n{body}"


ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, *ctes: tuple[str, str]) -> None:
    ORACLE[name] = q(body, *ctes)


# ---- reports ---------------------------------------------------------------------------
oracle("v_team_season_summary", """
select tg.season as "Season", t.team_name as "Team", count(*) as "Games Played", cast(sum(w) as bigint) as "Wins",
  cast(sum(l) as bigint) as "Losses", cast(sum(coalesce(gf, 0)) as bigint) as "Goals For",
  cast(sum(coalesce(ga, 0)) as bigint) as "Goals Against", cast(sum(coalesce(sf, 0)) as bigint) as "Shots For",
  cast(sum(coalesce(sa, 0)) as bigint) as "Shots Against"
from tg join m_team t on t.team_id = tg.team_id group by tg.season, t.team_name""",
       ("tg", """select season, home_team_id as team_id, home_goals as gf, away_goals as ga, home_shots as sf,
    away_shots as sa, case when home_goals > away_goals then 1 else 0 end as w,
    case when home_goals < away_goals then 1 else 0 end as l from m_game
  union all
  select season, away_team_id, away_goals, home_goals, away_shots, home_shots,
    case when away_goals > home_goals then 1 else 0 end, case when away_goals < home_goals then 1 else 0 end
  from m_game"""))

oracle("v_team_game_results", """
select g.game_id as "Game ID", g.game_date as "Game Date", g.season as "Season", g.game_type as "Game Type",
  h.team_name as "Home Team", a.team_name as "Away Team", g.home_goals as "Home Goals", g.away_goals as "Away Goals",
  g.home_shots as "Home Shots", g.away_shots as "Away Shots",
  case when g.home_goals > g.away_goals then h.team_name when g.away_goals > g.home_goals then a.team_name
  else 'Tie' end as "Winning Team"
from m_game g join m_team h on h.team_id = g.home_team_id join m_team a on a.team_id = g.away_team_id""")

oracle("v_player_game_stats", """
select g.game_id as "Game ID", g.game_date as "Game Date", g.season as "Season", t.team_name as "Team",
  p.full_name as "Player", p.position_code as "Position", s.goals as "Goals", s.assists as "Assists",
  s.points as "Points", s.shots as "Shots", s.hits as "Hits", s.blocks as "Blocks",
  s.penalty_minutes as "Penalty Minutes", s.time_on_ice_seconds as "Time On Ice Seconds"
from m_stats_fact s join m_game g on g.game_id = s.game_id join m_player p on p.player_id = s.player_id
  join m_team t on t.team_id = s.team_id""")

oracle("v_player_season_summary", """
select g.season as "Season", t.team_name as "Team", p.full_name as "Player", p.position_code as "Position",
  count(*) as "Games Played", cast(sum(s.goals) as bigint) as "Goals", cast(sum(s.assists) as bigint) as "Assists",
  cast(sum(s.points) as bigint) as "Points", cast(sum(s.shots) as bigint) as "Shots",
  cast(sum(s.hits) as bigint) as "Hits", cast(sum(s.blocks) as bigint) as "Blocks",
  cast(sum(s.penalty_minutes) as bigint) as "Penalty Minutes",
  cast(sum(coalesce(s.time_on_ice_seconds, 0)) as bigint) as "Time On Ice Seconds"
from m_stats_fact s join m_game g on g.game_id = s.game_id join m_player p on p.player_id = s.player_id
  join m_team t on t.team_id = s.team_id
group by g.season, t.team_name, p.full_name, p.position_code""")

oracle("team_games_unpivot", """
select season, home_team_id as team_id, home_goals as goals_for, away_goals as goals_against,
  home_shots as shots_for, away_shots as shots_against from m_game
union all
select season, away_team_id, away_goals, home_goals, away_shots, home_shots from m_game""")

_TEAM_SRC_VALID = "select * from m_team_src where team_id is not null and team_name is not null"
_TEAM_CHG = ("chg", f"""select t.team_id from m_team_tgt t join ({_TEAM_SRC_VALID}) s on s.team_id = t.team_id
  where coalesce(t.team_name, '') <> coalesce(s.team_name, '') or coalesce(t.conference, '') <> coalesce(s.conference, '')
  or not t.is_active""")

oracle("scd1_change_set", "select team_id from chg", _TEAM_CHG)

oracle("scd1_upsert_team", f"""
select t.team_id, t.team_key, case when c.team_id is not null then s.team_name else t.team_name end as team_name,
  case when c.team_id is not null then s.conference else t.conference end as conference,
  case when c.team_id is not null then true else t.is_active end as is_active
from m_team_tgt t left join m_team_src s on s.team_id = t.team_id left join chg c on c.team_id = t.team_id
union all
select s.team_id, cast((select max(team_key) from m_team_tgt) + row_number() over (order by s.team_id) as int),
  s.team_name, s.conference, true
from ({_TEAM_SRC_VALID}) s where not exists (select 1 from m_team_tgt t where t.team_id = s.team_id)""", _TEAM_CHG)

_PLAYER_SRC = ("psrc", """select p.player_id, t.team_key,
    substring(coalesce(case when rtrim(p.full_name) = '' then null else p.full_name end,
      trim(concat(coalesce(p.first_name, ''), ' ', coalesce(p.last_name, '')))), 1, 200) as full_name,
    p.position_code
  from m_player_src p left join m_team_tgt t on t.team_id = p.team_id where p.player_id is not null""")
_PLAYER_CHG = ("pchg", """select t.player_id from m_player_tgt t join psrc s on s.player_id = t.player_id
  where s.full_name is not null and (coalesce(t.team_key, -1) <> coalesce(s.team_key, -1)
    or t.full_name <> s.full_name or coalesce(t.position_code, '') <> coalesce(s.position_code, '') or not t.is_active)""")

oracle("scd1_upsert_player", """
select t.player_id, t.player_key, case when c.player_id is not null then s.team_key else t.team_key end as team_key,
  case when c.player_id is not null then s.full_name else t.full_name end as full_name,
  case when c.player_id is not null then s.position_code else t.position_code end as position_code,
  case when c.player_id is not null then true else t.is_active end as is_active
from m_player_tgt t left join psrc s on s.player_id = t.player_id left join pchg c on c.player_id = t.player_id
union all
select s.player_id, (select max(player_key) from m_player_tgt) + row_number() over (order by s.player_id),
  s.team_key, s.full_name, s.position_code, true
from psrc s where s.full_name is not null and not exists (select 1 from m_player_tgt t where t.player_id = s.player_id)""",
       _PLAYER_SRC, _PLAYER_CHG)

oracle("insert_missing_single", """
select g.game_id from m_game g
where not exists (select 1 from orders x where x.o_orderkey = g.game_id and x.o_orderstatus = 'F')""")

oracle("insert_missing_composite", """
select s.game_id, s.player_id from m_stats s where not exists
  (select 1 from m_stats_all x where x.game_id = s.game_id and x.player_id = s.player_id and x.l_returnflag = 'R')""")

oracle("game_fact_load", """
select (select max(o_orderkey) + 1000 from orders where o_orderstatus = 'F') + row_number() over (order by g.game_id)
    as game_key,
  g.game_id, cast(year(g.game_date) * 10000 + month(g.game_date) * 100 + day(g.game_date) as int) as date_key,
  g.season, g.game_type, h.team_key as home_team_key, a.team_key as away_team_key, g.home_goals, g.away_goals,
  g.home_shots, g.away_shots
from m_game g join m_team_tgt h on h.team_id = g.home_team_id join m_team_tgt a on a.team_id = g.away_team_id
where g.game_id is not null
  and exists (select 1 from cal where cal.full_date = g.game_date)
  and not exists (select 1 from orders x where x.o_orderkey = g.game_id and x.o_orderstatus = 'F')""",
       ("cal", """select cast(unnest(generate_series((select min(game_date) from m_game),
    (select max(game_date) from m_game), interval 1 day)) as date) as full_date"""))

oracle("stats_fact_load", """
select (select coalesce(max(player_game_stats_key), 0) from ex)
  + row_number() over (order by g.game_key, p.player_key, t.team_key) as player_game_stats_key,
  g.game_key, p.player_key, t.team_key, coalesce(s.goals, 0) as goals, coalesce(s.assists, 0) as assists,
  coalesce(s.goals, 0) + coalesce(s.assists, 0) as points, coalesce(s.shots, 0) as shots,
  coalesce(s.hits, 0) as hits, coalesce(s.blocks, 0) as blocks, coalesce(s.penalty_minutes, 0) as penalty_minutes,
  s.time_on_ice_seconds
from st s join m_game g on g.game_id = s.game_id join m_player p on p.player_id = s.player_id
  join m_team_tgt t on t.team_id = s.team_id
where not exists (select 1 from ex where ex.game_key = g.game_key and ex.player_key = p.player_key
  and ex.team_key = t.team_key)""",
       ("st", "select s.*, p.team_id from m_stats s join m_player p on p.player_id = s.player_id"),
       ("ex", """select (game_id + 1000) * 1000000 + player_id as player_game_stats_key, game_id + 1000 as game_key,
    player_id + 1000 as player_key, team_id + 1000 as team_key
  from st join orders on o_orderkey = game_id and o_orderstatus = 'F'"""))

oracle("player_key_lookup", "select p.player_id, t.team_key from m_player p left join m_team_tgt t on t.team_id = p.team_id")

oracle("dup_single_key", "select raw_id, count(*) as n from m_stats_all group by raw_id having count(*) > 1")

oracle("dup_composite_count", """
select count(*) as duplicate_count from
  (select game_id, player_id from m_stats_all group by game_id, player_id having count(*) > 1) d""")

oracle("fk_violations", """
select g.game_id, g.home_team_id from m_game g
where g.home_team_id is not null and not exists (select 1 from m_team_tgt t where t.team_id = g.home_team_id)""")

_FK_PARENTS = (
    ("fk_player", "select player_id, team_id + 1000 as team_key from m_player"),
    ("fk_days", """select min(game_date) as d0, max(game_date) as d1 from m_game where game_state = 'FINAL'"""),
    ("fk_stats", """select s.game_id, s.player_id, p.team_id from m_stats s
  join m_player p on p.player_id = s.player_id"""))

oracle("reference_violations", """
select 'player_dim' as child_table, 'team_key' as column_name, count(*) as violations from fk_player c
  where c.team_key is not null and c.team_key not in (select team_key from m_team_tgt)
union all select 'game_fact', 'date_key', count(*) from m_game, fk_days
  where game_date is not null and not game_date between d0 and d1
union all select 'game_fact', 'home_team_key', count(*) from m_game
  where home_team_id is not null and home_team_id not in (select team_id from m_team_tgt)
union all select 'game_fact', 'away_team_key', count(*) from m_game
  where away_team_id is not null and away_team_id not in (select team_id from m_team_tgt)
union all select 'player_game_stats_fact', 'game_key', count(*) from fk_stats s
  where not exists (select 1 from orders o where o.o_orderkey = s.game_id and o.o_orderstatus = 'F')
union all select 'player_game_stats_fact', 'player_key', count(*) from fk_stats s where s.player_id % 7 = 0
union all select 'player_game_stats_fact', 'team_key', count(*) from fk_stats s
  where s.team_id is not null and s.team_id not in (select team_id from m_team_tgt)""", *_FK_PARENTS)

oracle("staged_date_range",
       "select min(game_date) as start_date, max(game_date) as end_date from m_game where game_date is not null")

oracle("latest_batch",
       "select event_type as batch_id from events group by event_type order by max(ts) desc, event_type limit 1")

oracle("delete_by_join", """
select s.game_id, s.player_id from m_stats s
where not exists (select 1 from m_game g where g.game_id = s.game_id and g.game_state = 'FINAL')""")

oracle("guarded_delete", """
select d.doc_id from documents d where not (d.n_chars < 5000
  and not exists (select 1 from labels l where l.doc_id = d.doc_id)
  and not exists (select 1 from pages p where p.page_id = d.doc_id)
  and not exists (select 1 from benchmark b where b.item_id = d.doc_id))""")

oracle("guarded_delete_either", """
select p_partkey from part where not (p_size < 30 and p_partkey not in (select l_partkey from guards)
  and p_partkey not in (select l_suppkey from guards))""",
       ("guards", "select l_partkey, l_suppkey from lineitem where l_returnflag = 'R' and l_quantity >= 45"))


def _varied(name: str, key: str) -> str:
    return (f"concat(case {key} % 3 when 0 then upper({name}) when 1 then lower({name}) else {name} end, "
            f"case when {key} % 2 = 0 then '  ' else '' end)")


oracle("v_team_season_summary_host_text", """
select season as "Season", min(team_name) as "Team", count(*) as "Games Played",
  count(*) filter (gf > ga) as "Wins", count(*) filter (gf < ga) as "Losses",
  cast(sum(coalesce(gf, 0)) as bigint) as "Goals For", cast(sum(coalesce(ga, 0)) as bigint) as "Goals Against",
  cast(sum(coalesce(sf, 0)) as bigint) as "Shots For", cast(sum(coalesce(sa, 0)) as bigint) as "Shots Against"
from sides join spelled using (team_id) group by season, lower(rtrim(team_name))""",
       ("spelled", f"select team_id, {_varied('conference', 'team_id')} as team_name from m_team"),
       ("sides", """
  select season, home_team_id as team_id, home_goals as gf, away_goals as ga, home_shots as sf, away_shots as sa from m_game
  union all select season, away_team_id, away_goals, home_goals, away_shots, home_shots from m_game"""))

oracle("dup_host_text", f"""
select min(name) as name, count(*) as n from (select {_varied("p_brand", "p_partkey")} as name from part) z
group by lower(rtrim(name)) having count(*) > 1""")

oracle("key_lookup_host_text", "select s_suppkey, s_nationkey as n_nationkey from supplier")

oracle("first_wins_host_text", f"""
select p_partkey, {_varied("p_brand", "p_partkey")} as code from part
where p_partkey in (select min(p_partkey) from part group by lower(p_brand))""")

oracle("final_game_ids", "select distinct game_id from m_game where game_state in ('FINAL', 'OFF') order by game_id")

oracle("last_wins_dedupe", """
select game_id, player_id, l_partkey, qty from (select *, row_number() over (partition by game_id, player_id
  order by raw_id desc, l_partkey desc, qty desc) as rn from m_stats_all) z where rn = 1""")

oracle("first_wins_dedupe", """
select game_id, player_id, l_partkey, qty from (select *, row_number() over (partition by game_id, player_id
  order by raw_id, l_partkey, qty) as rn from m_stats_all) z where rn = 1""")

# ---- payloads ---------------------------------------------------------------------------------
oracle("payload_envelope", "select event_id, cast(json_extract_string(props, '$.k') as int) as k from events")

oracle("raw_json_canonical",
       """select event_id, concat('{"k":', json_extract_string(props, '$.k'), '}') as raw_json from events""")

oracle("raw_json_verbatim", r"""
select p_partkey, pos as team_pos, case pos when 0 then concat('{"price" : ', cast(cast(p_retailprice as decimal(12, 2)) as varchar),
  ', "fullName":"Zürich \u00e9 ✓ ', p_brand, '", "more":{"b":[1 , 2.50],"a":null}, "id":', p_partkey, '}')
  when 1 then '7' when 2 then '[1]' else '{}' end as raw_json
from part, (select unnest([0, 1, 2, 3])::int as pos) z""")

oracle("player_raw_json", """
select cast(player_id as int) as player_id, case when position_code = 'G'
  then concat('{"birthDate":"', birth, '"', first, ',"id":', player_id, ',"lastName":', last, ',"positionCode":"G","shootsCatches":"', hand, '"}')
  else concat('{"id":', player_id, first, ',"lastName":', last, ',"positionCode":"', position_code, '","shootsCatches":"', hand,
              '","birthDate":"', birth, '"}') end as raw_json from elements""",
       ("elements", """
select player_id, position_code,
  concat(strftime(date '1980-01-01' + cast(player_id % 7000 as int), '%Y-%m-%d'), case when player_id % 3 = 0 then 'T00:00:00' else '' end) as birth,
  case when player_id % 11 <> 0 then concat(',"firstName":{"default":"', split_part(full_name, '#', 1), '"}')
       when position_code = 'G' then ',"firstName":null' else '' end as first,
  case when player_id % 2 = 0 then concat('"', split_part(full_name, '#', 2), '"')
       else concat('{"default":"', split_part(full_name, '#', 2), '"}') end as last,
  case when player_id % 2 = 0 then 'L' else 'R' end as hand
from m_player where not (position_code = 'G' and team_id % 7 = 3)"""))

oracle("team_payload_flatten", "select team_id, team_name from m_team")

_TEAM_CODE = ("tref", """select team_id, team_name, conference,
  case when team_id % 5 = 3 then lower(concat('T', lpad(cast(team_id % 16 as varchar), 2, '0')))
  when team_id % 5 = 4 then null else concat('T', lpad(cast(team_id % 16 as varchar), 2, '0')) end as code
  from m_team""")

oracle("team_reference", "select team_id, code as team_abbrev from tref where code is not null", _TEAM_CODE)

oracle("team_to_staging", """select concat('{"conferenceName":"', conference, '","fullName":"', team_name,
  '","id":', team_id, case when team_id % 5 = 3 then concat(',"rawTricode":"', code, '","triCode":""')
  when team_id % 5 = 4 then '' else concat(',"triCode":"', code, '"') end, '}') as raw_json, team_id, team_name, code as team_abbreviation, conference,
  cast(null as varchar) as division from tref""", _TEAM_CODE)

_ROSTER_DEDUPE = ("rdd", """select team_id, upper(code) as team_abbrev from (select *,
  row_number() over (partition by upper(code) order by conference desc, team_id // 1024 desc, team_id) as rn from tref where code is not null) z where rn = 1""")

oracle("roster_team_dedupe", "select team_id, team_abbrev from rdd", _TEAM_CODE, _ROSTER_DEDUPE)

oracle("code_list_filter", "select team_id, team_abbrev from rdd where team_abbrev in ('T01', 'T03', 'T05', 'T18', 'T08')",
       _TEAM_CODE, _ROSTER_DEDUPE)

_ROSTER = ("ros", """select * from m_player where not (position_code = 'G' and team_id % 7 = 3)""")

oracle("roster_flatten", """select team_id,
  case position_code when 'C' then 'forwards' when 'D' then 'defensemen' else 'goalies' end as roster_group,
  cast(player_id as int) as player_id from ros""", _ROSTER)

oracle("player_to_staging", """select cast(player_id as int) as player_id, team_id, first_name, last_name,
  concat_ws(' ', nullif(first_name, ''), nullif(last_name, '')) as full_name, position_code,
  case when player_id % 2 = 0 then 'L' else 'R' end as shoots_catches,
  cast(date '1980-01-01' + cast(player_id % 7000 as int) as date) as birth_date
from (select *, case when player_id % 11 = 0 then null else split_part(full_name, '#', 1) end as first_name,
  split_part(full_name, '#', 2) as last_name from ros) r""", _ROSTER)

oracle("schedule_flatten", """select 0 as request_seq, game_id, game_date, game_state from m_game
union all select 1, game_id, game_date, game_state from m_game where game_id % 13 = 0""")

def _side(name: str, prefix: str) -> str:
    return f"""concat('"{name}":{{"id":', {prefix}_team_id, case when {prefix}_goals is null then ''
  else concat(',"score":', {prefix}_goals) end, ',"sog":', {prefix}_shots, '}}')"""


oracle("game_to_staging", f"""select concat('{{', {_side("awayTeam", "away")}, ',"gameState":"', game_state,
  '","gameType":"', case when game_id % 13 = 0 then 'LATE' else game_type end, '",',
  case when game_id % 97 = 0 then '' else concat({_side("homeTeam", "home")}, ',') end, '"id":', game_id,
  ',"season":', season, '}}') as raw_json, game_id, game_date, season,
  case when game_id % 13 = 0 then 'LATE' else game_type end as game_type,
  case when game_id % 97 = 0 then null else home_team_id end as home_team_id, away_team_id,
  case when game_id % 97 = 0 then null else home_goals end as home_goals, away_goals,
  case when game_id % 97 = 0 then null else home_shots end as home_shots, away_shots from m_game""")

_BOX = ("box", """select s.*, g.home_team_id, g.away_team_id, p.position_code,
  s.player_id % 2 = 0 as home from m_stats s join m_game g on g.game_id = s.game_id
  join m_player p on p.player_id = s.player_id
  where not (s.player_id % 2 = 1 and s.game_id % 89 = 0)""")

oracle("boxscore_flatten", """select game_id, case when home then 'homeTeam' else 'awayTeam' end as side,
  case when home then home_team_id else away_team_id end as team_id,
  case position_code when 'C' then 'forwards' when 'D' then 'defense' else 'goalies' end as roster_group,
  cast(player_id as int) as player_id from box""", _BOX)

oracle("stats_to_staging", """select concat('{"assists":', assists, ',"blockedShots":', blocks, ',"goals":', goals,
  ',"hits":', hits, case when penalty_minutes is null then '' else concat(',"pim":', penalty_minutes) end,
  ',"playerId":', player_id, ',"sog":', shots, case when time_on_ice_seconds is null then ''
  else concat(',"toi":"', time_on_ice_seconds // 60, ':', lpad(cast(time_on_ice_seconds % 60 as varchar), 2, '0'), '"')
  end, '}') as raw_json, game_id, cast(player_id as int) as player_id,
  case when home then home_team_id else away_team_id end as team_id, goals, assists, shots, hits, blocks,
  penalty_minutes, time_on_ice_seconds from box""", _BOX)

oracle("missing_payloads", """select g.game_id from m_game g where g.game_state in ('FINAL', 'OFF')
  and not exists (select 1 from m_stats s where s.game_id = g.game_id and s.game_id % 10 <> 0)""")

oracle("explicit_ids_semi", """select game_id, game_state from m_game
  where game_id in (1, 2, 3, 4, 5, 6, 7, 32, 33, 34, 35, 36, 37, 38, 39, 64, 99999999)""")

oracle("stage_batch_scan", "select event_id, user_id, value from events where event_type = 'click'")

oracle("batch_stamp", f"""select row_number() over (order by game_id) as raw_id, '{SOURCE_SYSTEM}' as source_system,
  '11111111-1111-1111-1111-111111111111' as load_batch_id, game_id,
  timestamp '2024-10-01 12:00:00' as created_date from m_game""")

# ---- filters ------------------------------------------------------------------------------------
oracle("valid_stage_rows", "select player_id, full_name from m_player_src where player_id is not null and full_name is not null")

oracle("date_range_filter",
       "select game_id, game_date from m_game where game_date between date '1995-01-01' and date '1995-12-31'")

# ---- calendar ------------------------------------------------------------------------------------
_CAL = ("cal", """select cast(unnest(generate_series((select min(game_date) from m_game),
    (select max(game_date) from m_game), interval 1 day)) as date) as d""")
_CAL_ROWS = """select cast(strftime(d, '%Y%m%d') as int) as date_key, d as full_date,
  cast(year(d) as int) as calendar_year, cast(quarter(d) as int) as calendar_quarter,
  cast(month(d) as int) as calendar_month, monthname(d) as month_name, cast(day(d) as int) as day_of_month,
  cast(dayofweek(d) + 1 as int) as day_of_week, dayname(d) as day_name, dayofweek(d) in (0, 6) as is_weekend
from cal"""

oracle("date_sequence", "select d as request_date from cal", _CAL)
oracle("date_dim_populate", _CAL_ROWS, _CAL)
oracle("date_dim_insert_missing", _CAL_ROWS + " where not exists (select 1 from m_game g where g.game_date = cal.d)",
       _CAL)

# ---- audit -----------------------------------------------------------------------------------------
_AUDIT = ("aud", """select cast(user_id as varchar) as load_batch_id,
  arg_max(case when event_type = 'view' then ts end, case when event_type = 'view' then event_id end)
    as load_start_date,
  arg_max(ts, event_id) as load_end_date, arg_max(event_type, event_id) as status,
  arg_max(cast(floor(value) as int), event_id) as rows_inserted, max(event_id) as event_seq
from events group by user_id""")

oracle("batch_audit_state",
       "select load_batch_id, load_start_date, load_end_date, status, rows_inserted, event_seq from aud", _AUDIT)
oracle("audit_readback", "select load_batch_id, load_start_date, status from aud order by load_start_date", _AUDIT)

# ---- counts and constraint checks --------------------------------------------------------------------
oracle("row_counts", """select 'team' as table_name, count(*) as row_count from m_team
union all select 'player', count(*) from m_player union all select 'game', count(*) from m_game
union all select 'stats', count(*) from m_stats_all""")

oracle("not_null_violations", " union all ".join(
    f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_count from m_game"
    for c in ["game_id", "game_date", "season", "home_team_id", "away_team_id", "home_goals", "away_goals"]))

oracle("length_violations", " union all ".join(
    f"""select '{c}' as column_name, {n} as length_limit, cast(max(length({c})) as int) as max_length,
  count(*) filter (where length({c}) > {n}) as violations from m_player_src"""
    for c, n in [("first_name", 100), ("last_name", 100), ("full_name", 200), ("position_code", 10)]))

# ---- scalar rules ----------------------------------------------------------------------------------
oracle("fn_isnull_typed", """select player_id,
  substring(coalesce(case when player_id % 3 <> 0 then full_name end, repeat(full_name, 12)), 1, 200) as name
  from m_player""")
oracle("fn_coalesce",
       "select game_id, coalesce(home_goals, 0) as home_goals, coalesce(away_goals, 0) as away_goals from m_game")
oracle("fn_nullif_blank", """select player_id, case when rtrim(x) = '' then null else x end as value from
  (select player_id, case when player_id % 4 = 0 then '' when player_id % 4 = 1 then '   ' else full_name end as x
   from m_player) z""")
oracle("fn_full_name", """select player_id, trim(concat(coalesce(case when player_id % 3 <> 0 then first_name end, ''), ' ',
  coalesce(case when player_id % 4 <> 0 then last_name end, ''))) as full_name from m_player_src""")
oracle("fn_localized_text", """select player_id, case when player_id % 4 in (0, 1) then split_part(full_name, '#', 1)
  when player_id % 4 = 2 then null else cast(player_id as varchar) end as value from m_player""")
oracle("fn_int_coercion", """select event_id, try_cast(case when event_id % 5 = 0 then 'n/a' when event_id % 5 = 1 then ''
  else cast(user_id as varchar) end as int) as value from events""")
oracle("fn_toi_to_seconds", """select raw_id, l_partkey,
  case when len(string_split(t, ':')) = 2 then try_cast(string_split(t, ':')[1] as int) * 60
    + try_cast(string_split(t, ':')[2] as int) end as seconds
  from (select raw_id, l_partkey, concat(cast(l_linenumber * 7 as varchar), ':', lpad(cast(l_partkey % 60 as varchar), 2, '0')) as t
        from m_stats_all) z""")
oracle("fn_to_date", "select game_id, case when game_id % 3 = 2 then null else game_date end as value from m_game")
oracle("fn_date_key", "select game_id, cast(strftime(game_date, '%Y%m%d') as int) as date_key from m_game")
oracle("fn_date_parts", """select game_id, cast(year(game_date) as int) as calendar_year,
  cast(quarter(game_date) as int) as calendar_quarter, cast(month(game_date) as int) as calendar_month,
  cast(day(game_date) as int) as day_of_month, cast(dayofweek(game_date) + 1 as int) as day_of_week from m_game""")
oracle("fn_day_month_names",
       "select game_id, monthname(game_date) as month_name, dayname(game_date) as day_name from m_game")
oracle("fn_is_weekend", "select game_id, dayofweek(game_date) in (0, 6) as is_weekend from m_game")
oracle("fn_date_add", "select game_id, cast(game_date + interval 1 day as date) as next_date from m_game")
oracle("fn_winner_label", """select game_id, case when home_goals > away_goals then cast(home_team_id as varchar)
  when away_goals > home_goals then cast(away_team_id as varchar) else 'Tie' end as winner from m_game""")
oracle("fn_points", "select game_id, player_id, goals + assists as points from m_stats")
oracle("fn_truncate_message", """select game_id, cast(length(c) as int) as msg_length, substring(c, 3991, 10) as msg_tail
  from (select game_id, substring(repeat(concat(game_type, ' '), 400), 1, 4000) as c from m_game) z""")
oracle("fn_normalize_code", """select player_id, upper(trim(concat('  ', lower(substring(full_name, 1, 3)), position_code, ' ')))
  as code from m_player""")
oracle("fn_season_start", """select game_id, make_date(cast(case when month(game_date) >= 9 then year(game_date)
  else year(game_date) - 1 end as int), 9, 1) as season_start from m_game""")
oracle("season_start_of_date", """select game_id, cast(case when month(game_date) >= 9 then year(game_date)
  else year(game_date) - 1 end as int) as season_start_year from m_game""")
