"""Queries of extraction from pages, and of streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.fixed_values import MONTHS_PT, OUTCOMES
from ..functions.scalars import parse_odd
from ..operators import extract, pages
from ..operators.matching import name_ratios
from ..session import table
from ..streaming import jobs
from .registry import query
from .views import view

_TAGS = ["title", "h1", "b", "p", "a"]
_ONE = "<(?:" + "|".join(f"{t}\\b[^>]*>.*?</{t}" for t in _TAGS) + ")>"
_TOKENS = f"""(select page_id, url, pos - 1 as pos, regexp_extract(raw, '^<(\\w+)', 1) as tag, raw, trim(regexp_replace(raw, '<[^>]*>', '', 'gs')) as txt from (
    select page_id, url, unnest(x) as raw, generate_subscripts(x, 1) as pos from (select page_id, url, regexp_extract_all(html, '{_ONE}', 0, 's') as x from pages) y) z)"""


def tokens(spark, sf):
    return extract.elements(table(spark, sf, "pages"))


@query("h01_elements", f"select page_id, cast(pos as int) as pos, tag, txt as text from {_TOKENS} t")
def h01(spark, sf):
    return tokens(spark, sf).select("page_id", "pos", "tag", "text")


_UNDER = f"(select *, last_value(case when tag in ('b', 'h1') then txt end ignore nulls) over (partition by page_id order by pos rows unbounded preceding) as header from {_TOKENS} t)"


@query("h02_rows_under_header", f"select page_id, cast(pos as int) as pos, txt as text, header from {_UNDER} u where tag = 'p'")
def h02(spark, sf):
    return extract.rows_under_header(tokens(spark, sf), F.col("tag").isin("b", "h1"), F.col("tag") == "p").select("page_id", "pos", "text", "header")


_HREFS = "(select page_id, unnest(x) as link, generate_subscripts(x, 1) - 1 as pos from (select page_id, regexp_extract_all(html, 'href=\"([^\"]+)\"', 1) as x from pages) y)"


@query("h03_first_by_url", f"select link, page_id, cast(pos as int) as pos from (select *, row_number() over (partition by link order by page_id, pos) as n from {_HREFS} h) x where n = 1")
def h03(spark, sf):
    return extract.first_by_url(extract.links(table(spark, sf, "pages")), ["page_id", "pos"]).select("link", "page_id", "pos")


@query("h04_page_count", "select page_id, coalesce(cast(regexp_extract(url, 'page=([0-9]+)', 1) as int), 1) as pages from pages where regexp_matches(url, 'page=[0-9]') union all select page_id, 1 from pages where not regexp_matches(url, 'page=[0-9]')")
def h04(spark, sf):
    return table(spark, sf, "pages").select("page_id", extract.page_count(F.col("url"), r"page=(\d+)").alias("pages"))


@query("h05_slugs", f"select distinct slug from (select regexp_extract(link, '^/?([a-z0-9/-]+)', 1) as slug from {_HREFS} h where regexp_matches(link, '^/[a-z0-9/-]+')) x where slug <> '' and not list_contains(string_split(slug, '/'), 'login')")
def h05(spark, sf):
    return extract.slugs(table(spark, sf, "pages"), r'href="/([a-z0-9/-]+)', ["login"])


_CELL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def cells(spark, sf):
    """Rows with cells of odds in several notations, some unreadable."""
    text = [F.concat(F.lit("+"), F.col("l_quantity").cast("int").cast("string")), F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(",5")), F.lit("-")]
    n = (F.col("l_suppkey") % 3 + 1).cast("int")
    arr = F.slice(F.transform(F.array(*text), lambda x: parse_odd(x)), F.lit(1), n)
    book = F.when(F.col("l_partkey") % 11 != 0, F.col("l_suppkey"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", F.col("l_suppkey"), book.alias("bookmaker"), arr.alias("cells"))


_CELLS = "(select *, l_suppkey % 3 + 1 as n, case when l_partkey % 11 <> 0 then l_suppkey end as bookmaker, [round(1 + cast(l_quantity as int) / 100, 4), cast(l_quantity as int) + 0.5::double, null] as cells from lineitem)"


@query("h06_fixed_outcomes", f"""
    select {_CELL}, bookmaker, (['home', 'draw', 'away'])[i] as outcome, cells[i] as odds_closing from {_CELLS} c, (values (1), (2), (3)) t(i) where i <= n and bookmaker is not null""")
def h06(spark, sf):
    return extract.fixed_outcomes(cells(spark, sf), OUTCOMES["1x2"], _CELL.split(", "))


@query("h07_line_markets", """
    select event_id, coalesce(last_value(case when event_type = 'signup' then '2.5' when event_type = 'purchase' and value > 50 then cast(cast(value as int) as string) end ignore nulls)
      over (partition by user_id order by ts, event_id rows unbounded preceding), '') as line from events""")  # fmt: skip
def h07(spark, sf):
    e = table(spark, sf, "events")
    attribute = F.when(F.col("event_type") == "signup", "2.5").when(F.col("event_type") == "click", "")
    title = F.when((F.col("event_type") == "purchase") & (F.col("value") > 50), F.format_string("Games %d total", F.bround("value", 0).cast("int"))).otherwise("Total")
    return e.select("event_id", extract.line_value(attribute, title, ["user_id"], ["ts", "event_id"]).alias("line"))


@query("h08_best_prices", f"""
    select {_CELL}, case l_returnflag when 'A' then '+1.5' else '-3' end as submarket, 'best' as bookmaker, (['over', 'under'])[i] as outcome, cells[i] as odds_closing
    from {_CELLS} c, (values (1), (2)) t(i) where i <= n and l_returnflag <> 'R'""")  # fmt: skip
def h08(spark, sf):
    label = F.when(F.col("l_returnflag") == "A", "Handicap 2 +1.5 ").when(F.col("l_returnflag") == "N", "Line -3").otherwise("no line")
    return extract.best_prices(cells(spark, sf).withColumn("label", label), ["over", "under"], _CELL.split(", "))


@query("h09_grid", f"""
    select {_CELL}, bookmaker, case when i <= 2 then (['2:0', '2:1'])[i] else 'col_2' end as submarket, 'yes' as outcome, cells[i] as odds_closing
    from {_CELLS} c, (values (1), (2), (3)) t(i) where i <= n and bookmaker is not null""")  # fmt: skip
def h09(spark, sf):
    return extract.grid(cells(spark, sf).withColumn("headers", F.lit(["2:0", "2:1"])), _CELL.split(", "))


@query("h10_match_header", "select id, case when id % 3 = 0 then 'Header ' || home else home end as home, away, case when id % 4 = 0 then null else status end as status from {v_events}")
def h10(spark, sf):
    e = view(spark, sf, "v_events")
    header = e.select("id", F.when(F.col("id") % 3 == 0, F.concat(F.lit("Header "), "home")).alias("home"), F.when(F.col("id") % 2 == 0, F.col("away")).alias("away"), F.lit(None).cast("string").alias("status"))
    listing = e.select("id", "home", "away", F.when(F.col("id") % 4 != 0, F.col("status")).alias("status"))
    return extract.assemble_header(header, listing, "id", ["home", "away", "status"])


@query("h11_tab_labels", "select o_orderkey, case o_orderkey % 3 when 0 then 'Home/Away,1X2' when 1 then '1X2,Home/Away' else '1X2,Games' end as labels from orders")
def h11(spark, sf):
    active = F.when(F.col("o_orderkey") % 3 == 0, F.lit(["Home/Away"])).otherwise(F.lit(["1X2"]))
    inactive = F.when(F.col("o_orderkey") % 3 == 2, F.lit(["Games", "", "1X2"])).otherwise(F.lit(["1X2", "Home/Away", "1X2"]))
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(extract.tab_labels(active, inactive), ",").alias("labels"))


@query("h12_upcoming", "select id, home, 'scheduled' as status, cast(null as int) as score_home, cast(null as int) as score_away from {v_events}")
def h12(spark, sf):
    return extract.as_upcoming(view(spark, sf, "v_events")).select("id", "home", "status", "score_home", "score_away")


# --- whole pages, made from the tables, to rows

AS_OF = "2001-08-02"
SITE, HOSTS = "https://matches.example.com", ["example.com"]


_TOP, _BOTTOM = "<html><body><nav><a href='/x'>1 2</a></nav>", "</body></html>"


def joined(rows, page: str, order: list[str], piece):
    """(page_id, html): the pieces of each page in their order, between what isn't of interest.
    ``piece`` makes a row's markup of its values, which are gathered as they are: markup is many
    times as long, and is made where its page is."""
    values = F.struct(*order, *(c for c in rows.columns if c not in (page, *order)))
    made = rows.groupBy(F.col(page).alias("page_id")).agg(F.sort_array(F.collect_list(values)).alias("rows"))
    html = F.concat(F.lit(_TOP), F.array_join(F.transform("rows", lambda row: piece(row, F.col("page_id"))), "\n"), F.lit(_BOTTOM))
    return made.select("page_id", html.alias("html"))


def in_pieces(rows, page: str, order: list[str], piece):
    """(page_id, number, html): pages as those of ``joined``, of any length, in numbered pieces, one
    for each row, in order. A page's values are sorted, not gathered, and its markup never is.
    Partitions are as many as the session has for shuffles: by the size of the values, which their
    markup is many times as long as, Spark would make few of them."""
    mine = Window.partitionBy("page_id").orderBy(*order)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = rows.withColumnRenamed(page, "page_id").repartition(parts, "page_id").withColumns({"number": F.row_number().over(mine), "last": F.lead(F.lit(1)).over(mine).isNull()})
    values = values.select("page_id", "number", "last", F.struct(*(c for c in rows.columns if c != page)).alias("row"))
    html = F.concat(F.when(F.col("number") == 1, _TOP).otherwise(""), F.coalesce(piece(F.col("row"), F.col("page_id")), F.lit("")), F.when(F.col("last"), _BOTTOM).otherwise("\n"))
    return values.select("page_id", "number", html.alias("html"))


def div(test_id: str, *inner):
    """An element with its content two elements of its own tag further down."""
    return F.concat(F.lit(f'<div class="row" data-testid="{test_id}"><div><div class="in">'), *(F.lit(x) if isinstance(x, str) else x for x in inner), F.lit("</div></div></div>"))


def listing_pages(spark, sf):
    """A page for each league and year, elements in elements of their own tag. Some rows stand twice, some lead to another site, some
    name one side only; a header that is no date comes between."""
    months = F.lit([m.capitalize() for m in MONTHS_PT])

    def piece(row, _):
        col = row.getField
        date = F.concat_ws(" ", F.day(col("dt")).cast("string"), F.element_at(months, F.month(col("dt"))), col("y").cast("string"))
        people = F.concat(F.lit('<a title="'), col("home"), F.lit('"><p class="name participant-name">'), col("home"), F.lit('</p></a><a title="'), col("away"), F.lit('">'), F.when(col("id") % 4 == 0, "?").otherwise(F.concat(F.lit('<p data-testid="participant-name">'), col("away"), F.lit("</p>"))), F.lit("</a>"))
        score = F.concat(col("score_home").cast("string"), F.lit(":"), col("score_away").cast("string"))
        shown = F.coalesce(F.when(col("id") % 3 == 0, F.concat(F.lit("<p>after extra time "), F.replace(score, F.lit(":"), F.lit(" : ")), F.lit("</p>"))).otherwise(div("score", score)), F.lit(""))
        time = F.when(col("status") == "finished", "Finalizado").otherwise(F.date_format(col("dt"), "HH:mm"))

        def game(href, names):
            return F.concat(F.lit('<div data-testid="game-row"> <div></div><a href="'), href, F.lit('">'), div("game-row", div("time-item", time), div("event-participants", names), shown), F.lit("</a></div>"))

        path = F.concat(F.lit("/"), col("nk").cast("string"), F.lit("/#"), col("id").cast("string"))
        again = F.when(col("id") % 19 == 0, game(F.concat(F.lit(SITE), path), F.lit('<a title="X"></a><a title="Y"></a>'))).otherwise("")
        foreign = F.when(col("id") % 17 == 0, game(F.lit("https://example.com.other.org/#1"), people)).otherwise("")
        alone = F.when(col("id") % 23 == 0, game(F.lit("/one/#1"), F.lit('<a title="X">X</a>'))).otherwise("")
        return F.concat(div("date-header", date, " - Playoffs"), div("secondary-header", "Best odds"), foreign, game(path, people), again, alone)

    rows = view(spark, sf, "v_events").select(F.concat_ws("/", "league", F.col("y").cast("string")).alias("page"), "id", "y", "nk", "home", "away", "dt", "status", "score_home", "score_away")
    return in_pieces(rows, "page", ["id"], piece)


@query("h02_listing_rows", f"""
    select league || '/' || cast(y as string) as page_id, '{SITE}/' || cast(nk as string) || '/#' || cast(id as string) as match_url, case when status = 'finished' then date_trunc('day', dt) else dt end as dt,
      home, away, case when status = 'finished' and score_away is not null then score_home end as score_home, case when status = 'finished' and score_home is not null then score_away end as score_away, status from {{v_events}}""")  # fmt: skip
def h02_listing(spark, sf):
    return pages.listing_rows(listing_pages(spark, sf), F.lit(AS_OF).cast("date"), SITE, HOSTS, number="number").drop("pos")


ODDS_ROW = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_PAYOUT = "cast(l_linenumber as string) || '.' || cast(l_partkey as string) || '%'"


def odds_row(row, test_id: str = "odd-container", tag: str = "div"):
    """One to three cells of odds in several notations, in an element of their own tag if it may nest."""
    inner = "span" if tag == "p" else tag
    n, quantity = row["l_suppkey"] % 3 + 1, row["l_quantity"].cast("int").cast("string")
    text = [F.concat(F.lit("+"), quantity), F.concat(quantity, F.lit(",5")), F.lit("-")]
    return F.concat(*(F.when(n > k, F.concat(F.lit(f'<{tag} data-testid="{test_id}"><{inner}><b>'), t, F.lit(f"</b></{inner}></{tag}>"))).otherwise("") for k, t in enumerate(text)))


def bookmakers(row, page=None):
    name = F.when(row["l_partkey"] % 11 != 0, F.concat(F.lit("Book &amp; Co "), row["l_suppkey"].cast("string"))).otherwise(" ")
    payout = F.concat(row["l_linenumber"].cast("string"), F.lit("."), row["l_partkey"].cast("string"), F.lit("%"))
    return div("over-under-expanded-row", div("outrights-expanded-bookmaker-name", name), odds_row(row), div("payout-container", payout))


def odds_pages(spark, sf, piece, *more):
    return joined(table(spark, sf, "lineitem").select("l_orderkey", *ODDS_ROW, *more), "l_orderkey", ODDS_ROW, piece)


_BOOKS = f"(select *, 'Book & Co ' || cast(l_suppkey as string) as book, {_PAYOUT} as payout_pct from {_CELLS} b)"


@query("h06_page_odds", f"""
    select l_orderkey as page_id, payout_pct, book as bookmaker, (['home', 'draw', 'away'])[i] as outcome, cells[i] as odds_closing from {_BOOKS} c, (values (1), (2), (3)) t(i) where i <= n and bookmaker is not null""")
def h06_page(spark, sf):
    return pages.fixed_outcome_odds(odds_pages(spark, sf, bookmakers), OUTCOMES["1x2"])


#: Where a row lies, by its line number, in pages whose number isn't a multiple of 4: the lines of
#: its containers. Lines 2 and 7 lie in none.
_HOLDERS = "(values (1, '2.5'), (3, '3.5'), (4, '+4.5'), (5, ''), (6, '-1.5'), (6, '-2')) h(line, submarket)"


@query("h07_page_lines", f"""
    with rows as (select *, l_orderkey as page_id, coalesce(last_value(case when l_orderkey % 4 = 0 and l_linenumber = 2 then '-1.5' when l_orderkey % 4 <> 0 and l_linenumber = 7 then '7.5' end ignore nulls)
        over (partition by l_orderkey order by {', '.join(ODDS_ROW)} rows unbounded preceding), '') as header from {_BOOKS} b),
    held as (select page_id, h.submarket, payout_pct, book, n, cells from rows join {_HOLDERS} on line = l_linenumber where page_id % 4 <> 0 and bookmaker is not null),
    found as (select * from held union all select page_id, header, payout_pct, book, n, cells from rows where bookmaker is not null and page_id not in (select page_id from held))
    select page_id, submarket, payout_pct, book as bookmaker, (['over', 'under'])[i] as outcome, cells[i] as odds_closing from found, (values (1), (2)) t(i) where i <= n""")  # fmt: skip
def h07_page(spark, sf):
    """Rows in containers of every kind, one in the other, and outside; pages without containers
    that hold a row have line headers only, one of them without a number."""

    def piece(row, page):
        own, held, line = bookmakers(row), page % 4 != 0, row["l_linenumber"]
        return (
            F.when(held & (line == 1), F.concat(F.lit('<div class="x" data-line="2.5"><div>'), own, F.lit("</div></div>")))
            .when(held & (line == 3), F.concat(F.lit('<section data-total=""><div><h3>Games <b>3.5</b> in all</h3></div>'), own, F.lit("<h3>9</h3></section>")))
            .when(held & (line == 4), F.concat(F.lit('<div data-testid="total-line-box"><div><p class="big title">+4.5</p></div>'), own, F.lit("</div>")))
            .when(held & (line == 5), F.concat(F.lit('<div data-handicap="">none'), own, F.lit("</div>")))
            .when(held & (line == 6), F.concat(F.lit('<div data-handicap="-1.5"><div data-line=""><span class="line-value">Line -2</span>'), own, F.lit("</div></div>")))
            .when(held & (line == 7), F.concat(F.lit('<div data-line="8"></div>'), div("line-header", "Games <i>7.5</i>"), own))
            .when(~held & (line == 2), F.concat(div("handicap-row", "Handicap -1.5"), own))
            .when(~held & (line == 4), F.concat(F.lit('<div data-total="4"></div>'), div("total-row", "Total"), own))
            .otherwise(own)
        )

    return pages.line_odds(odds_pages(spark, sf, piece), ["over", "under"])


@query("h08_page_best", f"""
    select l_orderkey as page_id, case l_returnflag when 'A' then '+1.5' else '-3' end as submarket, 'best' as bookmaker, (['over', 'under'])[i] as outcome, cells[i] as odds_closing
    from {_CELLS} c, (values (1), (2)) t(i) where i <= n and l_returnflag <> 'R'""")  # fmt: skip
def h08_page(spark, sf):

    def piece(row, page):
        label = F.when(row["l_returnflag"] == "A", "<p>Acima/Abaixo +1.5</p><p>+1.5</p>").when(row["l_returnflag"] == "N", "Handicap 2 -3").otherwise("<p>no line</p>")
        return div("over-under-collapsed-row", div("over-under-collapsed-option-box", label), div("odd-container-default", odds_row(row, "odd-container-default", "p")))

    return pages.best_price_odds(odds_pages(spark, sf, piece, "l_returnflag"), ["over", "under"])


@query("h09_page_grid", f"""
    select l_orderkey as page_id, payout_pct, book as bookmaker, case when i <= 2 then (['2:0', '2:1'])[i] else 'col_2' end as submarket, 'yes' as outcome, cells[i] as odds_closing
    from {_BOOKS} c, (values (1), (2), (3)) t(i) where i <= n and bookmaker is not null""")  # fmt: skip
def h09_page(spark, sf):
    """The header in three forms, by the page's number."""
    by_id = div("bookmaker-table-header-line", "<div>Bookmaker</div><div><div>2:0</div></div><div> </div><div>2:1</div>")
    in_table = F.lit("<table><thead><tr><th>Bookmaker</th><th><div>2:0</div></th><th></th><th>2:1</th></tr></thead></table>")
    by_class = F.lit('<div class="wide table-header"><div>Bookmaker</div><div>2:0</div><span>no cell</span><div>2:1</div></div>')
    form = F.col("page_id") % 3
    made = odds_pages(spark, sf, bookmakers).withColumn("html", F.concat(F.when(form == 0, by_id).when(form == 1, in_table).otherwise(by_class), F.col("html")))
    return pages.grid_odds(made)


def match_pages(spark, sf):
    """A page for each event: a third has JSON-LD, of the others some lack an element."""
    e = view(spark, sf, "v_events")
    event = F.struct(F.lit("SportsEvent").alias("@type"), F.date_format("dt", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("startDate"), F.struct(F.concat(F.lit("Page "), "home").alias("name")).alias("homeTeam"), F.struct(F.col("away").alias("name")).alias("awayTeam"), F.struct(F.struct(F.lit("Xland").alias("addressCountry")).alias("address")).alias("location"))
    script = F.concat(F.lit('<script type="application/ld+json">{"@type": "Other"}</script><script type="application/ld+json">'), F.to_json(event), F.lit("</script>"))
    guest = F.when(F.col("id") % 2 == 0, div("game-guest", "Page ", F.col("away"))).otherwise("")
    score = F.concat(F.col("score_home").cast("string"), F.lit(":"), F.col("score_away").cast("string"))
    live = F.when(F.col("sets_detail").isNotNull(), F.concat(F.lit("Resultado final <strong>"), score, F.lit("</strong> (6<sup>3</sup>:4, 6:3)"))).otherwise(F.concat(F.lit("Final "), score))
    html = F.concat(F.lit("<html>"), F.when(F.col("id") % 3 == 0, script).otherwise(guest), F.coalesce(div("live-info", live), F.lit("")), F.lit("</html>"))
    return e.select(F.col("source_url").alias("match_url"), html.alias("html"))


@query("h10_match_rows", """
    select source_url as match_url, case when id % 3 = 0 then 'Page ' || home else home end as home, case when id % 3 <> 0 and id % 2 = 0 then 'Page ' || away else away end as away, dt,
      score_home, score_away, case when score_home is not null and score_away is not null then 'finished' else 'scheduled' end as status,
      case when score_home is not null and score_away is not null and sets_detail is not null then '6-4 6-3' end as sets_detail, case when id % 3 = 0 then 'Xland' else 'Nation_' || cast(nk as string) end as venue_country
    from {v_events}""")  # fmt: skip
def h10_rows(spark, sf):
    listing = view(spark, sf, "v_events").select(F.col("source_url").alias("match_url"), "home", "away", "dt", "score_home", "score_away", "league")
    out = pages.match_rows(pages.match_headers(match_pages(spark, sf), F.lit(AS_OF).cast("date"), "match_url"), listing)
    return out.select("match_url", "home", "away", "dt", "score_home", "score_away", "status", "sets_detail", "venue_country")


@query("k01_sequence_ratio")
def k01(spark, sf):
    targets = view(spark, sf, "v_targets").select("block", F.col("home").alias("name"))
    return name_ratios(targets, view(spark, sf, "v_listings").select("block", F.col("home").alias("listing")))


@query("k02_market_extractors", f"""
    select l_orderkey as event_id, market, bookmaker, case market when '1x2' then (['home', 'draw', 'away'])[i] else (['yes', 'no'])[i] end as outcome, cells[i] as odds_closing
    from (select *, case l_linenumber when 1 then '1x2' when 2 then 'btts' end as market from {_CELLS} c) d, (values (1), (2), (3)) t(i)
    where i <= n and bookmaker is not null and (market = '1x2' or market = 'btts' and i <= 2)""")  # fmt: skip
def k02(spark, sf):
    market = F.when(F.col("l_linenumber") == 1, "1x2").when(F.col("l_linenumber") == 2, "btts").otherwise("unknown")
    rows = cells(spark, sf).select(F.col("l_orderkey").alias("event_id"), market.alias("market"), "bookmaker", "cells")
    broken = {"unknown": lambda rows: rows.select("no_such_column")}
    return extract.extract_markets(rows, extract.EXTRACTORS | broken, failed=[])


# --- streams

_BATCHES = 5


def by_day(spark, sf, delayed: bool = False):
    """The events in ``_BATCHES`` batches by day; delayed: every 13th comes a batch late, every
    17th with the last one."""
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first = e.agg(F.min("ts").alias("t")).first()["t"]
    number = F.least(F.floor(F.datediff("ts", F.lit(first)) / 6), F.lit(_BATCHES - 1))
    if delayed:
        number = F.when(F.col("event_id") % 17 == 0, _BATCHES - 1).when(F.col("event_id") % 13 == 0, F.least(number + 1, F.lit(_BATCHES - 1))).otherwise(number)
    return jobs.arriving(e, number, _BATCHES)


@query("t01_ingest_once", "select distinct user_id, event_type from events")
def t01(spark, sf):
    """The same keys come again in every batch."""
    stream = by_day(spark, sf, delayed=True).select("ts", "user_id", "event_type")
    return jobs.run_to_end(jobs.ingest_once(stream, ["user_id", "event_type"]), "once").select("user_id", "event_type")


@query("t02_upsert_stream", """
    select id, first(home order by seq) as home, arg_min(season, seq) filter (season is not null) as season, case when min(k) is null then first(score_home order by seq) else arg_min(score_home, seq) filter (score_home is not null) end as score_home,
      case when min(k) is null then first(score_away order by seq) else first(score_away order by seq) filter (seq = k) end as score_away from (
      select user_id as id, event_type as home, event_id as seq, case when event_id % 3 = 0 then cast(event_id % 7 as string) end as season, case when event_type = 'view' then cast(event_id % 5 as int) end as score_home,
        cast(event_id % 4 as int) as score_away, min(case when event_type = 'view' then event_id end) over (partition by user_id) as k from events) x group by id""")  # fmt: skip
def t02(spark, sf):
    n = F.col("event_id")
    rows = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("home"), n.alias("seq"), F.when(n % 3 == 0, (n % 7).cast("string")).alias("season"),
        F.when(F.col("event_type") == "view", (n % 5).cast("int")).alias("score_home"), (n % 4).cast("int").alias("score_away"),
        F.lit(None).cast("string").alias("sets_detail"), F.lit("scheduled").alias("status"),
    )
    return jobs.upsert_stream(jobs.in_batches(rows, 4, ["seq"])).select("id", "home", "season", "score_home", "score_away")


@query("t03_rate_by_window", """
    select start, n, ok from (select date_trunc('day', ts) as start, count(*) as n, count(*) filter (event_type = 'view') as ok from events group by 1) x
    where start + interval '1' day <= (select max(ts) - interval '1' hour from events)""")  # fmt: skip
def t03(spark, sf):
    return jobs.run_to_end(jobs.rate_by_window(by_day(spark, sf), F.col("event_type") == "view"), "rate")


@query("t04_fresh_only", f"""
    with days as (select *, least(date_diff('day', cast((select min(ts) from events) as date), cast(ts as date)) // 6, {_BATCHES - 1}) as day_batch from events),
    rows as (select *, case when event_id % 17 = 0 then {_BATCHES - 1} when event_id % 13 = 0 then least(day_batch + 1, {_BATCHES - 1}) else day_batch end as b from days),
    tops as (select x.b, max(y.ts) as top from (select distinct b from rows) x left join rows y on y.b < x.b group by x.b)
    select event_id, event_type, ts from rows join tops on rows.b = tops.b where top is null or ts >= top - interval '7' day""")  # fmt: skip
def t04(spark, sf):
    return jobs.fresh_rows(by_day(spark, sf, delayed=True)).select("event_id", "event_type", "ts")
