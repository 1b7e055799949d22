"""Match and odds data, made from the given tables by plain expressions that both engines
evaluate alike. In an oracle's text, {v_events} and the like stand for the view."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import table

VIEWS = {
    "v_events": """
        select o_orderkey as id, lower(n_name) || '/' || lower(c_mktsegment) as league, n_nationkey as nk, year(o_orderdate) as y,
          cast(year(o_orderdate) as string) as season, case when o_orderkey % 13 = 0 then null else cast(year(o_orderdate) as string) end as season_raw,
          c_name as home, n_name || ' ' || c_mktsegment as away, cast(o_orderdate as timestamp) + (o_orderkey % 5) * interval '1' hour as dt,
          case when o_orderkey % 29 = 0 then 'scheduled' else 'finished' end as status,
          case when o_orderkey % 41 = 0 or o_orderkey % 29 = 0 then null else cast(o_orderkey % 4 as int) end as score_home,
          case when o_orderkey % 43 = 0 or o_orderkey % 29 = 0 then null else cast(o_orderkey % 3 as int) end as score_away,
          case when o_orderkey % 31 = 0 or o_orderkey % 29 = 0 then null else '6-4 6-3' end as sets_detail,
          'https://matches.example.com/' || lower(n_name) || '/#' || cast(o_orderkey as string) as source_url
        from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey""",
    "v_gappy": "select * from {v_events} where (nk + y) % 9 <> 0",
    "v_odds": """
        select l_orderkey as event_id,
          case when l_linenumber <= 5 then 'home_away' when l_linenumber = 6 then 'over_under' else 'asian_handicap' end as market,
          case when l_linenumber <= 5 then '' when l_returnflag = 'A' then '+1.5' when l_returnflag = 'N' then '2.5' else '3.5' end as submarket,
          case when l_linenumber = 6 then case when l_linestatus = 'O' then 'over' else 'under' end when l_linestatus = 'O' then 'home' else 'away' end as outcome,
          l_suppkey as bookmaker, cast(null as double) as odds_opening, 1 + l_quantity / 10 as odds_closing, cast(l_quantity as int) as tenths,
          l_linenumber, l_partkey, cast(l_shipdate as timestamp) as l_shipdate, l_extendedprice, l_quantity
        from {lineitem}""",
    "v_shards": """
        select s.r as shard, s.r = 2 as is_seed, e.id, e.league, e.season_raw as season, e.home, e.away, e.dt, e.status,
          case when (e.id * 7 + s.r) % 2 = 0 then null else e.score_home end as score_home,
          case when (e.id * 5 + s.r) % 3 = 0 then null else e.score_away + s.r end as score_away,
          case when s.r = 0 then null else e.sets_detail end as sets_detail, e.source_url
        from {v_events} e cross join (select 0 as r union all select 1 union all select 2) s where (e.id + s.r) % 3 <> 0""",
    "v_state_events": "select league, season, count(*) as c, max(dt) as completed_at, min(nk) as nk from {v_events} group by league, season",
    "v_state": """
        select league, season, cast(case when c % 7 = 0 then -1 when c % 5 = 0 then 0 else c end as bigint) as n, completed_at from {v_state_events}
        union all select league, '' as season, cast(-1 as bigint) as n, max(completed_at) as completed_at from {v_state_events} where nk % 4 = 0 group by league
        union all select 'ghost/' || cast(r_regionkey as string) as league, '' as season, cast(-1 as bigint) as n, cast(null as timestamp) as completed_at from {region}
        union all select 'ghost/' || cast(r_regionkey as string) as league, '2000' as season, cast(0 as bigint) as n, cast(null as timestamp) as completed_at from {region}""",
    "v_season_log": """
        select league, y, max(case when (nk * 7 + y) % 8 < 4 then 'empty' when (nk + y) % 11 = 0 then 'broken' else 'ok' end) as outcome
        from {v_events} where y < 2001 group by league, y""",
    "v_listing_log": """
        select event_id, cast(ts as timestamp) as ts, user_id % 4 as shard, cast(user_id % 7 + 1996 as int) as season_year,
          case when event_type = 'error' then 404 when event_type in ('view', 'click') then 200 end as http,
          case event_type when 'view' then 1 when 'click' then 0 when 'error' then 0 end as n_rows
        from {events}""",
    "v_odds_text": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, case l_linenumber
          when 1 then '+' || cast(cast(l_quantity as int) * 7 - 7 as string) when 2 then '-' || cast(cast(l_quantity as int) * 5 - 5 as string)
          when 3 then cast(cast(l_quantity as int) as string) || '/' || cast(l_suppkey % 9 as string) when 4 then ' ' || cast(cast(l_quantity as int) % 4 as string) || ',' || cast(l_suppkey % 90 + 10 as string) || ' '
          when 5 then cast(cast(l_quantity as int) as string) || '.' || cast(l_partkey % 10 as string) when 6 then '-' else case when l_suppkey % 2 = 0 then 'N/A' else '1e3' end end as txt
        from {lineitem}""",
    "v_targets": "select distinct p_brand as block, p_name as home, p_type as away from {part}",
    "v_listings": """
        select p_brand as block, min(p_partkey) as pos, home, away from (select p_brand, p_partkey,
          case when p_partkey % 3 = 0 then substr(p_name, 1, 3) || substr(p_name, 5) when p_partkey % 3 = 1 then replace(p_name, ' ', '  ') else p_name end as home,
          case when p_partkey % 5 = 0 then substr(p_type, 1, 2) || substr(p_type, 4) else p_type end as away from {part} where p_partkey % 7 <> 0) x group by p_brand, home, away""",
    "v_real_odds": """
        select cast(l_shipdate as timestamp) as match_date, l_suppkey as home_team, l_returnflag as market, l_extendedprice as real_odd, l_partkey % 4 as file_rank,
          l_orderkey, l_linenumber, l_partkey, l_quantity from {lineitem}""",
}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations"]


def expanded(sql: str) -> str:
    """The text with views as subqueries and tables by name."""
    while found := re.search(r"\{(\w+)\}", sql):
        name = found[1]
        sql = sql.replace(found[0], f"({VIEWS[name].strip()})" if name in VIEWS else name)
    return sql


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view over the tables of a folder."""

    def needed(text: str) -> dict[str, DataFrame]:
        names = set(re.findall(r"\{(\w+)\}", text))
        return {n: view(spark, sf_dir, n) if n in VIEWS else table(spark, sf_dir, n) for n in names}

    return spark.sql(VIEWS[name], **needed(VIEWS[name]))
