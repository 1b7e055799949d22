"""Queries of the scalar functions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import scalars as S
from ..operators import audit, dims, odds
from ..session import table
from .registry import query
from .views import view

AS_OF = "2001-08-02"
KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _sql_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _sql_case(column: str, values: dict, otherwise: str) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then '{v}'" for k, v in values.items()) + f" else {otherwise} end"


@query("p01_parse_odd", f"""
    select {KEY}, txt, case when trim(txt) in ('', '-', 'N/A', 'nan', 'NaN') then null
      when regexp_matches(trim(txt), '^[+][0-9]+$') then round(1 + try_cast(substr(trim(txt), 2) as double) / 100, 4)
      when regexp_matches(trim(txt), '^-[0-9]+$') and try_cast(substr(trim(txt), 2) as double) > 0 then round(1 + 100 / try_cast(substr(trim(txt), 2) as double), 4)
      when regexp_matches(trim(txt), '^[+-]?[0-9]+([.,][0-9]*)?$') then case when try_cast(replace(trim(txt), ',', '.') as double) > 1 then try_cast(replace(trim(txt), ',', '.') as double) end
      when regexp_matches(trim(txt), '^[0-9]+/[0-9]+$') and try_cast(split_part(trim(txt), '/', 2) as double) > 0
        then round(1 + try_cast(split_part(trim(txt), '/', 1) as double) / try_cast(split_part(trim(txt), '/', 2) as double), 4) end as odd
    from {{v_odds_text}}""")  # fmt: skip
def p01(spark, sf):
    return view(spark, sf, "v_odds_text").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "txt", S.parse_odd(F.col("txt")).alias("odd"))


@query("p02_normalize_name", "select doc_id, trim(regexp_replace(text, '[\\s\\x0B\\x1c-\\x1f\\x85\\p{Z}]+', ' ', 'g')) as name from documents")
def p02(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.normalize_name(F.col("text")).alias("name"))


_PT = _sql_case("strftime(o_orderdate, '%m')", {f"{n:02d}": m.title() for m, n in fixed.MONTHS_PT.items()}, "''")


@query("p03_parse_pt_datetime", f"""
    select o_orderkey, txt, case o_orderkey % 5 when 0 then cast(o_orderdate as timestamp) + interval '90' minute when 1 then cast(o_orderdate as timestamp)
      when 2 then case when strftime(o_orderdate, '%m-%d') <> '02-29' then strptime('2001-' || strftime(o_orderdate, '%m-%d'), '%Y-%m-%d') end
      when 3 then timestamp '{AS_OF} 22:05:00' else case when o_orderkey % 2 = 0 then timestamp '2001-08-01 09:30:00' end end as dt
    from (select o_orderkey, o_orderdate, case o_orderkey % 5 when 0 then strftime(o_orderdate, '%d') || ' ' || ({_PT}) || ' ' || strftime(o_orderdate, '%Y') || ', 01:30'
        when 1 then 'Hoje, ' || strftime(o_orderdate, '%d') || ' ' || ({_PT}) || ' ' || strftime(o_orderdate, '%Y') || '  - Playoffs'
        when 2 then strftime(o_orderdate, '%d') || ' ' || ({_PT}) || ' - Playoffs' when 3 then 'Hoje, 22:05'
        else case when o_orderkey % 2 = 0 then 'Ontem 9:30' else '99 Xyz' end end as txt from orders) x""")  # fmt: skip
def p03(spark, sf):
    o, d = table(spark, sf, "orders"), F.col("o_orderdate")
    names = F.create_map(*[F.lit(x) for m, n in fixed.MONTHS_PT.items() for x in (n, m.title())])
    day, month, year = F.date_format(d, "dd"), F.element_at(names, F.month(d)), F.date_format(d, "yyyy")
    full = F.concat_ws(" ", day, month, year)
    kind = F.col("o_orderkey") % 5
    text = (
        F.when(kind == 0, F.concat(full, F.lit(", 01:30")))
        .when(kind == 1, F.concat(F.lit("Hoje, "), full, F.lit("  - Playoffs")))
        .when(kind == 2, F.concat_ws(" ", day, month, F.lit("- Playoffs")))
        .when(kind == 3, "Hoje, 22:05")
        .otherwise(F.when(F.col("o_orderkey") % 2 == 0, "Ontem 9:30").otherwise("99 Xyz"))
    )
    return o.select("o_orderkey", text.alias("txt")).select("o_orderkey", "txt", S.parse_pt_datetime(F.col("txt"), F.lit(AS_OF).cast("date")).alias("dt"))


@query("p04_parse_datetime_any", """
    select o_orderkey, case o_orderkey % 6 when 5 then null when 4 then strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') when 3 then strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d')
      else cast(o_orderdate as timestamp) end as dt from orders""")  # fmt: skip
def p04(spark, sf):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 6
    formats = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "dd/MM/yyyy HH:mm", "yyyy-MM-dd", "dd/MM/yyyy"]
    text = F.coalesce(*(F.when(k == n, F.date_format(d, f)) for n, f in enumerate(formats)), F.lit("no date"))
    return table(spark, sf, "orders").select("o_orderkey", S.parse_datetime_any(text, day_first=True).alias("dt"))


#: Notations of a date and time, and the hours by which each is east of UTC.
NOTATIONS = [
    ("EEE, dd MMM yyyy HH:mm:ss '-0300'", -3), ("MMMM d, yyyy h:mm a", 0), ("d MMMM yyyy 'at' HH'h'mm", 0), ("yyyyMMdd'T'HHmmss'Z'", 0), ("MM/dd/yyyy HH:mm", 0), ("yyyy/M/d HH:mm:ss.SSS", 0),
    ("dd-MMM-yy HH:mm", 0), ("EEEE, MMM d yyyy HH:mm 'GMT+2'", 2), ("yyyy.MM.dd, HH:mm:ss", 0), ("yyyy-MM-dd'T'HH:mm:ssXXX", 0), ("HH:mm yyyy MMM dd", 0), ("dd MMM, yyyy", None), ("'someday' yyyy", None),
]


@query("p04_free_dates", f"""
    select o_orderkey, case when k = {len(NOTATIONS) - 1} then null when k = {len(NOTATIONS) - 2} then cast(o_orderdate as timestamp)
      else cast(o_orderdate as timestamp) + (o_orderkey % 24) * interval '1' hour + (o_orderkey % 60) * interval '1' minute - hours * interval '1' hour end as dt
    from (select *, o_orderkey % {len(NOTATIONS)} as k from orders) o join (values {", ".join(f"({k}, {h or 0})" for k, (_, h) in enumerate(NOTATIONS))}) z(n, hours) on n = k""")  # fmt: skip
def p04_free(spark, sf):
    at = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"), mins=(F.col("o_orderkey") % 60).cast("int"))
    text = F.coalesce(*(F.when(F.col("o_orderkey") % len(NOTATIONS) == k, F.date_format(at, f)) for k, (f, _) in enumerate(NOTATIONS)))
    return table(spark, sf, "orders").select("o_orderkey", S.parse_datetime_any(text).alias("dt"))


@query("p05_epoch_to_iso", "select event_id, strftime(to_timestamp(event_id * 4321), '%Y-%m-%dT%H:%M:%S+00:00') as iso from events")
def p05(spark, sf):
    return table(spark, sf, "events").select("event_id", S.epoch_to_iso(F.col("event_id") * 4321).alias("iso"))


@query("p06_offset_to_utc", """
    select event_id, case when event_id % 7 = 0 then null else strftime(date_trunc('second', ts) - to_hours(cast(event_id % 5 as int)), '%Y-%m-%dT%H:%M:%S+00:00') end as iso from events""")
def p06(spark, sf):
    e = table(spark, sf, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0"), (F.col("event_id") % 5).cast("string"), F.lit(":00"))
    return e.select("event_id", S.offset_to_iso(F.when(F.col("event_id") % 7 == 0, "soon").otherwise(text)).alias("iso"))


@query("p07_stable_event_id", """
    select id, substr(sha1('tennis|' || coalesce(league, '') || '|' || trim(regexp_replace(home, '\\s+', ' ', 'g')) || '|' || trim(regexp_replace(away, '\\s+', ' ', 'g')) || '|' || strftime(dt, '%Y-%m-%d')), 1, 16) as event_id
    from {v_events}""")  # fmt: skip
def p07(spark, sf):
    e = view(spark, sf, "v_events")
    return e.select("id", S.stable_event_id(F.lit("tennis"), F.col("league"), F.concat(F.lit("  "), "home"), F.replace("away", F.lit(" "), F.lit("  ")), S.iso_utc(F.col("dt"))).alias("event_id"))


@query("p08_coalesce_score", "select id, coalesce(score_home, 9) as score from {v_events}")
def p08(spark, sf):
    text = F.coalesce(F.col("score_home").cast("string"), F.when(F.col("id") % 2 == 0, ""))
    return view(spark, sf, "v_events").select("id", S.coalesce_score(text, F.lit("9")).cast("int").alias("score"))


_PATHS = [*fixed.GRAND_SLAMS, *fixed.MASTERS, *fixed.TIER_500]


def _leagues(spark, sf):
    """Real league paths and made-up ones, one for each order."""
    kinds = F.lit([*_PATHS, "united-kingdom/challenger-new-london-2", "usa/itf-m25-el-paso-homens", "new-zealand/atp-tour-finals", "south-korea/korea-cup-open", "uae"])
    return table(spark, sf, "orders").select("o_orderkey", F.element_at(kinds, (F.col("o_orderkey") % F.size(kinds)).cast("int") + 1).alias("league"))


def _sql_leagues() -> str:
    names = [*_PATHS, "united-kingdom/challenger-new-london-2", "usa/itf-m25-el-paso-homens", "new-zealand/atp-tour-finals", "south-korea/korea-cup-open", "uae"]
    return f"(select o_orderkey, ({'[' + ', '.join(repr(n) for n in names) + ']'})[cast(o_orderkey % {len(names)} as int) + 1] as league from orders)"


def _sql_title(x: str) -> str:
    return f"array_to_string(list_transform(string_split(replace({x}, '-', ' '), ' '), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')"


_SLUG = "case when contains(league, '/') then substr(league, position('/' in league) + 1) else '' end"


@query("p09_derive_venue", f"""
    select o_orderkey, league, {_sql_case("split_part(league, '/', 1)", fixed.COUNTRY_NAMES, _sql_title("split_part(league, '/', 1)"))} as country,
      {_sql_case("league", fixed.CITIES, _sql_title(f"regexp_replace(regexp_replace({_SLUG}, '^({'|'.join(fixed.TOURNAMENT_PREFIXES)})', ''), '({'|'.join(fixed.TOURNAMENT_SUFFIXES)})$', '')"))} as city
    from {_sql_leagues()} x""")  # fmt: skip
def p09(spark, sf):
    return _leagues(spark, sf).select("o_orderkey", "league", S.venue_country(F.col("league")).alias("country"), S.venue_city(F.col("league")).alias("city"))


@query("p10_league_tier", f"""
    select o_orderkey, case when league in {_sql_list(fixed.GRAND_SLAMS)} then 0 when league in {_sql_list(fixed.MASTERS)} then 1 when league in {_sql_list(fixed.TIER_500)} then 2
      when regexp_matches(league, '^([^/]*/)?(atp|wta)-') then 3 when contains(league, 'challenger') then 4 else 5 end as tier from {_sql_leagues()} x""")  # fmt: skip
def p10(spark, sf):
    return _leagues(spark, sf).select("o_orderkey", S.league_tier(F.col("league")).alias("tier"))


_SEASON = "case o_orderkey % 4 when 0 then cast(year(o_orderdate) as string) when 1 then cast(year(o_orderdate) - 1 as string) || '-' || cast(year(o_orderdate) as string) when 2 then 'unknown' end"


@query("p11_season_is_final", f"select o_orderkey, coalesce(try_cast({_SEASON} as int) < 2000, false) as final from orders")
def p11(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.season_is_final(F.expr(_SEASON), 2000).alias("final"))


@query("p12_season_end_year", "select o_orderkey, case when o_orderkey % 4 < 2 then cast(year(o_orderdate) as int) end as end_year from orders")
def p12(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", S.season_end_year(F.expr(_SEASON)).alias("end_year"))


@query("p13_strip_season_suffix", "select o_orderkey, 'league-' || cast(o_orderkey % 50 as string) as slug from orders")
def p13(spark, sf):
    slug = F.expr(f"'league-' || cast(o_orderkey % 50 as string) || coalesce('-' || nullif({_SEASON}, 'unknown'), '')")
    return table(spark, sf, "orders").select("o_orderkey", S.strip_season_suffix(slug).alias("slug"))


@query("p14_typed_load", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_suppkey % 3 = 0 then null else cast(l_quantity as int) end as n, case when l_suppkey % 5 > 1 then l_discount end as x from lineitem")
def p14(spark, sf):
    n = F.when(F.col("l_suppkey") % 3 == 0, "").otherwise(F.col("l_quantity").cast("int").cast("string"))
    x = F.when(F.col("l_suppkey") % 5 == 0, "").when(F.col("l_suppkey") % 5 == 1, "n/a").otherwise(F.col("l_discount").cast("string"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.typed(n, "int").alias("n"), S.typed(x, "double").alias("x"))


@query("p15_host_allowed", """
    select page_id, url from pages where regexp_matches(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '(^|[.])example[.](com|net)$')""")
def p15(spark, sf):
    return table(spark, sf, "pages").where(S.host_allowed(F.col("url"), ["example.com", "example.net"])).select("page_id", "url")


_LINKS = "select page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) as href from pages"


@query("p16_resolve_url", f"""
    select page_id, href, count(*) as n, case when starts_with(href, 'http') then href when starts_with(href, '/') then 'https://base.example.com' || href end as url from ({_LINKS}) x group by page_id, href""")
def p16(spark, sf):
    from ..operators.extract import links

    found = links(table(spark, sf, "pages")).groupBy("page_id", F.col("link").alias("href")).agg(F.count("*").alias("n"))
    return found.withColumn("url", S.resolve_url(F.col("href"), "https://base.example.com/"))


@query("p17_url_fragment", "select id, case when id % 3 = 0 then '' else cast(id as string) || case when id % 3 = 1 then '#x' else '' end end as fragment from {v_events}")
def p17(spark, sf):
    u = F.col("source_url")
    url = F.when(F.col("id") % 3 == 0, F.split_part(u, F.lit("#"), F.lit(1))).when(F.col("id") % 3 == 1, F.concat(u, F.lit("#x"))).otherwise(u)
    return view(spark, sf, "v_events").select("id", S.url_fragment(url).alias("fragment"))


@query("p18_derive_urls", """
    select id, 'https://h/tennis/' || league || case when season_raw is null then '' else '-' || season_raw end || '/results/' as results,
      case when season_raw is null then 'https://h/matches/tennis/' else 'https://h/tennis/' || league || '/' end as upcoming,
      'https://h/tennis/' || league || case when season_raw is null then '' else '-' || season_raw end || '/results/#/page/' || cast(id % 9 as string) || '/' as page,
      case when id % 2 = 0 then 'https://h/' || league || '/m/' else 'https://h/' || league || '/m/#over-under' end as tab from {v_events}""")  # fmt: skip
def p18(spark, sf):
    base, sport, league, season = "https://h", F.lit("tennis"), F.col("league"), F.col("season_raw")
    results = S.results_url(base, sport, league, season)
    match = F.concat(F.lit("https://h/"), league, F.lit("/m/"))
    return view(spark, sf, "v_events").select(
        "id", results.alias("results"), S.upcoming_url(base, sport, F.when(season.isNotNull(), league)).alias("upcoming"),
        S.page_url(results, F.col("id") % 9).alias("page"), S.tab_url(match, F.when(F.col("id") % 2 == 0, "").otherwise("over-under")).alias("tab"),
    )


_ALIASES = [*fixed.LEAGUE_ALIASES, "/usa/ncaa/", "spain/acb"]
_SPORTS = ["basketball", "soccer", "tennis"]


@query("p19_resolve_alias", f"""
    select o_orderkey, sport, given, case when path is null then trim(given, '/') when own = sport then path end as path, coalesce(own <> sport, false) as rejected
    from (select o_orderkey, ({_SPORTS})[cast(o_orderkey % 3 as int) + 1] as sport, ({_ALIASES})[cast(o_orderkey % {len(_ALIASES)} as int) + 1] as given from orders) x
    left join (values {', '.join(f"('{k}', '{s}', '{p}')" for k, (s, p) in fixed.LEAGUE_ALIASES.items())}) a(alias, own, path) on given = alias""")  # fmt: skip
def p19(spark, sf):
    pick = lambda values: F.element_at(F.lit(values), (F.col("o_orderkey") % len(values)).cast("int") + 1)
    rows = table(spark, sf, "orders").select("o_orderkey", pick(_SPORTS).alias("sport"), pick(_ALIASES).alias("given"))
    aliases = spark.createDataFrame([(k, s, p) for k, (s, p) in fixed.LEAGUE_ALIASES.items()], "alias string, sport string, path string")
    return dims.resolve_alias(rows, aliases).select("o_orderkey", "sport", "given", "path", "rejected")


@query("p20_listing_outcome", "select event_id, case when http >= 400 then 'http404' when n_rows > 0 then 'ok' when n_rows = 0 and http = 200 then 'empty200' else 'uncertain' end as outcome from {v_listing_log}")
def p20(spark, sf):
    return view(spark, sf, "v_listing_log").select("event_id", S.listing_outcome(F.col("http"), F.col("n_rows")).alias("outcome"))


@query("p21_season_complete", "select league, season, coalesce(n <> 0 or completed_at >= timestamp '1999-12-31 00:00:00', false) as complete from {v_state}")
def p21(spark, sf):
    return view(spark, sf, "v_state").select("league", "season", S.season_complete(F.col("n"), F.col("completed_at"), "1999-12-31").alias("complete"))


@query("p22_score_pair", """
    select event_id, case event_id % 5 when 0 then cast(event_id % 120 as int) when 1 then cast(event_id % 10 as int) when 2 then null when 3 then null else null end as home,
      case event_id % 5 when 0 then 7 when 1 then 12 else null end as away from events""")  # fmt: skip
def p22(spark, sf):
    k, n = F.col("event_id") % 5, F.col("event_id")
    text = (
        F.when(k == 0, F.concat((n % 120).cast("string"), F.lit(" - 7")))
        .when(k == 1, F.concat(F.lit("Home "), (n % 10).cast("string"), F.lit(" : 12 Away")))
        .when(k == 2, "at 22:30 today")
        .when(k == 3, "result 1:2:3")
        .otherwise("no score")
    )
    pair = S.score_pair(text)
    return table(spark, sf, "events").select("event_id", pair["home"].alias("home"), pair["away"].alias("away"))


@query("p23_set_scores", "select id, case when status = 'finished' then cast(id % 7 as string) || '-6 7-' || cast(id % 6 as string) end as sets from {v_events}")
def p23(spark, sf):
    text = F.concat(F.lit("Final 2:1 ("), (F.col("id") % 7).cast("string"), F.lit(":6, 7 - "), (F.col("id") % 6).cast("string"), F.lit(") after (1:1)"))
    return view(spark, sf, "v_events").select("id", S.set_scores(text, F.col("status")).alias("sets"))


@query("p24_match_status", """
    select event_id, case when event_id % 5 < 3 then 'finished' else 'scheduled' end as status, case when event_id % 5 < 3 then cast(event_id % 9 as int) end as home,
      case when event_id % 5 < 3 then 4 end as away from events""")  # fmt: skip
def p24(spark, sf):
    k, n = F.col("event_id") % 5, (F.col("event_id") % 9).cast("string")
    strong = F.when(k == 0, F.concat(n, F.lit(":4")))
    info = F.when(k == 1, F.concat(F.lit("Resultado "), n, F.lit("-4"))).otherwise("starts 8:30")
    teams = F.when(k == 2, F.concat(F.lit("Home "), n, F.lit(" – 4 Away"))).otherwise("Home Away")
    out = S.match_status(strong, info, teams)
    return table(spark, sf, "events").select("event_id", out["status"].alias("status"), out["home"].alias("home"), out["away"].alias("away"))


@query("p25_json_ld", """
    select event_id, case when event_id % 4 <> 0 then strftime(date_trunc('second', ts) - interval '2' hour, '%Y-%m-%dT%H:%M:%S+00:00') end as dt_utc,
      case when event_id % 4 <> 0 then 'Team ' || json_extract_string(props, '$.k') end as home, case when event_id % 4 <> 0 then event_type end as away,
      case when event_id % 4 <> 0 and event_id % 3 = 0 then 'PT' end as country from events""")  # fmt: skip
def p25(spark, sf):
    e = table(spark, sf, "events")
    block = lambda body: F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    place = F.when(F.col("event_id") % 3 == 0, ', "location": {"address": {"addressCountry": "PT"}}').otherwise("")
    event = F.concat(
        F.lit('{"@type": ["Thing", "SportsEvent"], "startDate": "'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('+02:00", "homeTeam": {"name": " Team  '),
        F.get_json_object("props", "$.k"), F.lit('"}, "awayTeam": {"name": "'), F.col("event_type"), F.lit('"}'), place, F.lit("}"),
    )
    html = F.concat(F.lit("<p>x</p>"), block(F.lit('{"@type": "WebSite"}')), block(F.lit("not json")), F.when(F.col("event_id") % 4 == 0, "").otherwise(block(event)))
    return e.select("event_id", S.json_ld_fields(html).alias("f")).select("event_id", "f.*")


@query("p26_round_label", "select o_orderkey, strftime(o_orderdate, '%d %m %Y') as label from orders")
def p26(spark, sf):
    text = F.concat(F.lit(" "), F.date_format("o_orderdate", "dd MM yyyy"), F.when(F.col("o_orderkey") % 2 == 0, "  - Playoffs - B").otherwise(""))
    return table(spark, sf, "orders").select("o_orderkey", S.round_label_stripped(text).alias("label"))


@query("p27_market_labels", f"""
    select event_id, array_to_string(list(label order by pos), ',') as labels from (select distinct event_id, pos, label from {{v_odds}} o
      join (values {', '.join(f"('{m}', '{label}', {k})" for k, (m, label, *_) in enumerate(fixed.MARKETS))}) c(market, label, pos) on o.market = c.market) x group by event_id""")  # fmt: skip
def p27(spark, sf):
    return odds.clickable_labels(view(spark, sf, "v_odds").select("event_id", "market")).withColumn("labels", F.array_join("labels", ","))


@query("f01_date_regex_distinct", """
    select distinct league, season, home from {v_events} where dt between timestamp '1997-01-01 00:00:00' and timestamp '1999-12-31 00:00:00' and regexp_matches(lower(league), 'auto|furn')""")
def f01(spark, sf):
    return audit.between(view(spark, sf, "v_events"), "1997-01-01", "1999-12-31", "AUTO|FURN", ["league", "season", "home"])


@query("f02_stale", f"select id, dt from {{v_events}} where cast(dt as date) < date '{AS_OF}' - 2")
def f02(spark, sf):
    return audit.stale(view(spark, sf, "v_events"), AS_OF).select("id", "dt")


@query("f03_phantoms", "select id, dt, source_url from {v_events} where strftime(dt, '%H:%M:%S') = '00:00:00' and status = 'scheduled' and source_url is not null")
def f03(spark, sf):
    return audit.phantoms(view(spark, sf, "v_events")).select("id", "dt", "source_url")


@query("f04_valid_odds", "select event_id, bookmaker, odds_closing from {v_odds} where odds_closing > 3.5")
def f04(spark, sf):
    shifted = view(spark, sf, "v_odds").withColumn("shifted", F.col("odds_closing") - 2.5)
    return odds.valid(shifted, "shifted").select("event_id", "bookmaker", "odds_closing")
