"""From the HTML of a page to rows: listings, bookmakers' odds, match headers.

A page's elements are found by their tags and depth (``markup``), whatever they hold. Pages are
independent of each other: what a page says is worked out where it lies, a row for each element
that is one, and only what runs on in a listing (the date header) or over a page (whether any
row lies in a container) is a window over a page's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.fixed_values import LINE_ATTRIBUTES, TEST_IDS
from . import markup as M
from .extract import assemble_header, best_prices, fixed_outcomes, grid
from .merge import first_wins
from .sequence import carried

_SCORE = r"^(\d+)\s*[:\-]\s*(\d+)$"
_NUMBER = r"([+-]?\d+(?:\.\d+)?)"


def _named(*names: str) -> dict[str, str]:
    return {n: M.by_test_id(TEST_IDS[n]) for n in names}


def _with_columns(out: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """``out`` with the pages' further columns."""
    more = [c for c in pages.columns if c not in (key, "html")]
    return out.join(pages.select(key, *more), key) if more else out


def listing_rows(pages: DataFrame, as_of: Column, base: str, hosts: list[str], key: str = "page_id", number: str | None = None) -> DataFrame:
    """H-02: (key, pos, match_url, dt, home, away, score_home, score_away, status), one row for
    each URL of a page.

    A game row counts if a link is right below it; the link's host has to be one of ``hosts``.
    The date is the latest header's that is one, the time the row's own. A row whose time isn't
    a time is finished, and has a score in its score element, else as text. Rows with fewer
    than two names are dropped. With ``number`` pages come in pieces (``markup.rows``)."""
    people = M.by_test_id(TEST_IDS["participants"])
    asks = {
        "hrefs": M.Ask("a[href]", "href", child=True, of="game_row", need=True), "text": M.Ask(", ".join(_named("date_header", "game_row").values())),
        "names": M.Ask(f".participant-name, {M.by_test_id(TEST_IDS['participant'])}", inside=people, first=False, of="game_row"),
        "titles": M.Ask("a[title]", "title", inside=people, first=False, of="game_row"),
        "times": M.Ask(M.by_test_id(TEST_IDS["time"]), of="game_row"), "scores": M.Ask(M.by_test_id(TEST_IDS["score"]), of="game_row"),
    }
    rows = M.rows(pages, key, _named("date_header", "game_row"), asks, number=number)
    one = lambda name: F.try_element_at(F.col(name), F.lit(1))
    filled = lambda xs: F.filter(xs, lambda x: x != "")
    is_header = F.array_contains("kind", "date_header")
    said = F.when(is_header, F.trim(F.element_at(F.split(one("text"), r"\s*-\s*", 2), 1)))
    # Only what a row says goes to its page's other rows: what has no link is dropped before.
    rows = rows.select(
        key, "pos", is_header.alias("is_header"), said.alias("said"), F.coalesce(one("hrefs"), F.lit("")).alias("href"), filled(F.col("names")).alias("names"),
        filled(F.transform("titles", S.normalize_name)).alias("titles"), F.coalesce(one("times"), F.lit("00:00")).alias("time"), one("scores").alias("shown"), F.when(~is_header, one("text")).alias("all"),
    ).where("is_header or href <> ''")
    dated = F.when(S.parse_pt_datetime(F.col("said"), as_of).isNotNull(), F.col("said"))
    rows = rows.withColumn("header", carried(dated, [key], ["pos"])).where("not is_header").withColumn("match_url", S.resolve_url(F.col("href"), base))
    rows = rows.withColumn("names", F.when(F.size("names") >= 2, F.col("names")).otherwise(F.array_union("names", "titles")))
    rows = rows.where((F.size("names") >= 2) & S.host_allowed(F.col("match_url"), hosts))
    finished = ~F.col("time").rlike(r"^\d{1,2}:\d{2}$")
    rows = rows.withColumn("at", F.concat_ws(" ", "header", F.when(finished, "00:00").otherwise(F.col("time"))))
    loose = r"(?<![:\d])(\d{1,2})\s*:\s*(\d{1,2})(?![:\d])"
    in_text = ~F.regexp_extract("all", loose, 0).rlike(r"^\d{2}:\d{2}$")
    score = lambda k: F.when(finished, F.when(F.col("shown").rlike(_SCORE), F.regexp_extract("shown", _SCORE, k)).when(in_text, F.regexp_extract("all", loose, k))).try_cast("int")
    out = rows.select(
        key, "pos", "match_url", S.parse_pt_datetime(F.col("at"), as_of).alias("dt"), F.col("names")[0].alias("home"), F.col("names")[1].alias("away"),
        score(1).alias("score_home"), score(2).alias("score_away"), F.when(finished, "finished").otherwise("scheduled").alias("status"),
    )
    return first_wins(out, [key, "match_url"], ["pos"])


_ODDS_ROW = _named("odds_row")
_SAID = {"names": M.Ask(M.by_test_id(TEST_IDS["bookmaker"])), "cells": M.Ask(M.by_test_id(TEST_IDS["odd"]), first=False), "payouts": M.Ask(M.by_test_id(TEST_IDS["payout"]))}


def bookmaker_rows(pages: DataFrame, key: str, *keep: str, **further) -> DataFrame:
    """(key, keep, bookmaker, cells, payout_pct) of each row of odds; bookmaker is NULL if none is
    named, cells are the texts. ``further`` is handed on to ``markup.rows``."""
    rows = M.rows(pages, key, _ODDS_ROW, _SAID, **further)
    one = lambda name: F.try_element_at(F.col(name), F.lit(1))
    return rows.select(key, *keep, S.blank_to_null(one("names")).alias("bookmaker"), "cells", F.coalesce(one("payouts"), F.lit("")).alias("payout_pct"))


def priced(rows: DataFrame) -> DataFrame:
    """Rows with the odds that their text says, one row for each cell."""
    return rows.withColumn("odds_closing", S.parse_odd(F.col("odds_closing")))


def fixed_outcome_odds(pages: DataFrame, outcomes: list[str], key: str = "page_id") -> DataFrame:
    """H-06 from the page: pages' columns, payout_pct, bookmaker, outcome, odds_closing."""
    return _with_columns(priced(fixed_outcomes(bookmaker_rows(pages, key), outcomes, [key, "payout_pct"])), pages, key)


def line_odds(pages: DataFrame, outcomes: list[str], key: str = "page_id") -> DataFrame:
    """H-07 from the page: as H-06, with submarket, the line that a row belongs to.

    A row belongs to the containers that it lies in, and is there once for each: a container's
    line is its attribute, else the number in its first title, else empty; rows outside all
    containers are dropped. Only on a page where no row with odds lies in a container, every
    row takes the number of the last line header before it, else the empty line."""
    number = lambda x: F.nullif(F.regexp_extract(F.coalesce(x, F.lit("")), _NUMBER, 1), F.lit(""))
    containers = M.Around('[data-testid*="line"], ' + ", ".join(f"[{a}]" for a in LINE_ATTRIBUTES), tuple(LINE_ATTRIBUTES), "h2, h3, h4, .title, .line-value")
    rows = bookmaker_rows(pages, key, "own", "titles", "before", around=containers, before=(M.by_test_id(TEST_IDS["line_header"]), _NUMBER))
    rows = rows.where(F.col("bookmaker").isNotNull() & (F.size("cells") > 0))
    lines = F.zip_with("own", "titles", lambda own, title: F.coalesce(own, number(title), F.lit("")))
    rows = rows.select(key, "payout_pct", "bookmaker", "cells", lines.alias("lines"), F.coalesce(number(F.col("before")), F.lit("")).alias("header"))
    of_page = Window.partitionBy(key)
    rows = rows.withColumn("in_boxes", F.max(F.size("lines")).over(of_page) > 0)
    rows = rows.withColumn("submarket", F.explode(F.when(F.col("in_boxes"), F.col("lines")).otherwise(F.array("header"))))
    return _with_columns(priced(fixed_outcomes(rows, outcomes, [key, "submarket", "payout_pct"])), pages, key)


def best_price_odds(pages: DataFrame, outcomes: list[str], key: str = "page_id") -> DataFrame:
    """H-08 from the page: collapsed rows, the best price of each line."""
    label = M.by_test_id(TEST_IDS["best_label"])
    asks = {"inner": M.Ask("p", inside=label), "outer": M.Ask(label), "cells": M.Ask(M.by_test_id(TEST_IDS["best_odd"], "p"), first=False)}
    one = lambda name: F.try_element_at(F.col(name), F.lit(1))
    rows = M.rows(pages, key, _named("best_row"), asks).select(key, "cells", F.coalesce(one("inner"), one("outer"), F.lit("")).alias("label"))
    return _with_columns(priced(best_prices(rows, outcomes, [key])), pages, key)


def grid_odds(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """H-09 from the page: cells under the first table header (by test id, ``thead`` or the class
    ``table-header``), whose first cell names the bookmaker; of cells in cells the innermost count."""
    header = f"{M.by_test_id(TEST_IDS['grid_header'])}, thead, .table-header"
    rows = bookmaker_rows(pages, key, "named", of_page={"named": M.Ask("th, td, div", inside=header, below=True, leaves=True, first=False)})
    heads = F.filter(F.slice("named", 2, F.greatest(F.size("named"), F.lit(1))), lambda x: x != "")
    return _with_columns(priced(grid(rows.withColumn("headers", heads), [key, "payout_pct"])), pages, key)


_EVENT = "`@type` string, startDate string, homeTeam struct<name string>, awayTeam struct<name string>, location struct<address struct<addressCountry string>>"


def match_headers(pages: DataFrame, as_of: Column, key: str = "page_id") -> DataFrame:
    """What a match page says of its match: (key, home, away, dt, venue_country, score_home,
    score_away, sets_detail, status). The page's JSON-LD event comes before its elements."""
    blocks = F.regexp_extract_all("html", F.lit(r'(?s)<script type="application/ld\+json">(.*?)</script>'), F.lit(1))
    events = F.filter(F.transform(blocks, lambda x: F.from_json(x, _EVENT)), lambda x: x["@type"].contains("SportsEvent"))
    kinds = _named("host", "guest", "game_time", "live", "game_participants") | {"strong": "strong", "raised": "sup"}
    toks, event = F.col("toks"), F.col("event")
    rows = pages.select(key, F.try_element_at(events, F.lit(1)).alias("event")).join(M.parsed(pages, key, kinds, without={"live": "raised"}), key, "left")
    named = lambda team, name: F.coalesce(S.blank_to_null(S.normalize_name(event[team]["name"])), S.blank_to_null(F.col(name)))
    live = M.first(toks, "live")
    found = {n: M.first_text(toks, n) for n in ("host", "guest")} | {"strong": F.coalesce(M.first_text(live, "strong"), F.lit("")), "live": F.coalesce(M.first_text(toks, "live"), F.lit("")), "others": F.coalesce(M.first_text(toks, "game_participants"), F.lit("")), "time": M.first_text(toks, "game_time")}
    rows = rows.select(key, "event", *(c.alias(n) for n, c in found.items()))
    free, dashes = r"(\d+)\s*[:\-]\s*(\d+)", r"(\d+)\s*[–—\-]\s*(\d+)"
    by_strong, by_text = F.col("strong").rlike(_SCORE), F.col("live").rlike(free) & F.col("live").rlike("Result|[Ff]inal")
    score = lambda k: F.when(by_strong, F.regexp_extract("strong", _SCORE, k)).when(by_text, F.regexp_extract("live", free, k)).when(F.col("others").rlike(dashes), F.regexp_extract("others", dashes, k)).try_cast("int")
    sets = F.regexp_extract_all(F.regexp_extract("live", r"\(([^)]+)\)", 1), F.lit(free), F.lit(0))
    joined = F.array_join(F.transform(sets, lambda x: F.regexp_replace(x, r"\s*[:\-]\s*", "-")), " ")
    return rows.select(
        key, named("homeTeam", "host").alias("home"), named("awayTeam", "guest").alias("away"),
        F.coalesce(F.try_to_timestamp(event["startDate"]), S.parse_pt_datetime(F.col("time"), as_of)).alias("dt"),
        S.blank_to_null(event["location"]["address"]["addressCountry"]).alias("venue_country"),
        score(1).alias("score_home"), score(2).alias("score_away"), F.when(by_strong, S.blank_to_null(joined)).alias("sets_detail"),
        F.when(score(1).isNotNull() & score(2).isNotNull(), "finished").otherwise("scheduled").alias("status"),
    )


def match_rows(headers: DataFrame, listing: DataFrame, league: str = "league", key: str = "match_url") -> DataFrame:
    """H-10: field by field the match page's value, else the listing's (home, away, dt and the
    scores); status and sets are the page's; a venue that the page doesn't name is derived
    from the league's path."""
    fields = ["home", "away", "dt", "score_home", "score_away"]
    out = assemble_header(headers, listing, key, fields).join(headers.select(key, "status", "sets_detail", "venue_country"), key).join(listing.select(key, league), key, "left")
    return out.withColumns({"venue_country": F.coalesce("venue_country", S.venue_country(F.col(league))), "venue_city": S.venue_city(F.col(league))})
