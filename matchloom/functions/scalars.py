"""Column functions: text to numbers, dates, names, keys and URLs. NULL in, NULL out unless
a docstring says otherwise; nothing raises on bad text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed

NUMBER = r"^[+-]?\d+([.,]\d*)?$"


def _table(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def parse_odd(text: Column, half_even: bool = False) -> Column:
    """Decimal odds from `1.87`, `1,87`, `+150`, `-110` or `2/5`; NULL for anything else.

    A sign makes it American, without one it is decimal and must exceed 1. ``half_even``
    rounds ties to even at the fourth place."""
    s = F.trim(text)
    rounded = F.bround if half_even else F.round
    sign, n = F.regexp_extract(s, r"^([+-])(\d+)$", 1), F.regexp_extract(s, r"^([+-])(\d+)$", 2).try_cast("double")
    american = F.when((sign == "+") & n.isNotNull(), 1 + n / 100).when((sign == "-") & (n > 0), 1 + 100 / n)
    decimal = F.when(s.rlike(NUMBER), F.regexp_replace(s, ",", ".").try_cast("double"))
    a, b = (F.regexp_extract(s, r"^(\d+)/(\d+)$", k).try_cast("double") for k in (1, 2))
    fraction = F.when(b > 0, 1 + a / b)
    return F.when(~s.isin(fixed.MISSING_ODDS), F.coalesce(rounded(american, 4), F.when(decimal > 1, decimal), rounded(fraction, 4)))


def normalize_name(text: Column) -> Column:
    """No white space at the ends, one space between words; any Unicode white space counts."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def parse_pt_datetime(text: Column, as_of: Column) -> Column:
    """Timestamp from Portuguese text such as `Hoje, 19 Abr 2026, 00:30`.

    A full date comes first, then `hoje` and `ontem` relative to the date ``as_of``, then a
    date without a year in its year. Without a time it is midnight; an impossible date is NULL."""
    months = _table(fixed.MONTHS_PT)
    part = lambda pattern, k: F.regexp_extract(text, pattern, k)
    time = r"(\d{1,2}):(\d{2})(?!\d)"
    hour, minute = (F.coalesce(part(time, k).try_cast("int"), F.lit(0)) for k in (1, 2))
    full, short = r"(\d{1,2})\s+(\w{3})\s+(\d{4})", r"(\d{1,2})\s+(\w{3})"
    month = lambda pattern: F.try_element_at(months, F.lower(part(pattern, 2)))

    def at(year: Column, month: Column, day: Column) -> Column:
        return F.try_make_timestamp(year, month, day, hour, minute, F.lit(0))

    low = F.lower(text)
    said = F.when(low.contains("hoje"), as_of).when(low.contains("ontem"), F.date_sub(as_of, 1))
    dated = at(part(full, 3).try_cast("int"), month(full), part(full, 1).try_cast("int"))
    relative = at(F.year(said), F.month(said), F.day(said))
    yearless = F.when(said.isNull(), at(F.year(as_of), month(short), part(short, 1).try_cast("int")))
    return F.coalesce(dated, relative, yearless)


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.transform(F.array(value), use)[0]


_TIME = r"^(.*?)(?<![\d:.,/+-])(\d{1,2})(?::(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?|h(\d{2})?|(?=\s*[ap]\.?m\b))\s*(?:([ap])\.?m\b\.?)?(?![\d:])(.*)$"
_ZONE = rf"^\s*(?:z\b|\(?(?:{'|'.join(fixed.ZONES)})\b\)?)?\s*(?:([+-])(\d{{1,2}}):?(\d{{2}})?(?!\d))?"
_MONTH = r"(?<![a-z])(" + "|".join(rf"{m[:3]}(?:{m[3:]})?" if m != "september" else "sept?(?:ember)?" for m in fixed.MONTHS_EN) + r")(?![a-z])"
_WEEKDAY = r"(?<![a-z])(?:" + "|".join(rf"{d[:3]}(?:{d[3:]})?" for d in fixed.WEEKDAYS_EN) + r"|tues|wednes|thur|thurs)(?![a-z])"
_FILLER = r"(?<![a-z])(?:at|on|and|of|ad|t)(?![a-z])|(?<=\d)(?:st|nd|rd|th)(?![a-z])|(?<=\d)t(?=\s)"


def parse_datetime_any(text: Column, day_first: bool = False, default: Column | None = None) -> Column:
    """A timestamp in UTC from a date in about any notation, NULL if it can't be told.

    Tokens are told by their kind: a time (`13:05:07.5`, `1:05 pm`, `13h05`, `1pm`), a zone
    behind it (`Z`, `UTC`, `-03:00`, `GMT+2`; other names of zones are passed over), names of
    months and weekdays, and numbers. A number of four digits or above 31 is the year; with a
    month's name the other is the day, and of two that may be either the last is the year.
    Without a name the year comes first or last: year, month, day, or month, day, year, the
    first two the other way round if ``day_first`` asks for it or the first can't be a month.
    Years of two digits are those from 1969 to 2068. Without a zone the time is UTC, without a
    time it is midnight. What a date lacks comes from the date ``default``; without one it is
    NULL, as are texts with any other word."""
    low = F.concat(F.lit(" "), F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " "))), F.lit(" "))
    low = F.regexp_replace(low, r"(?<![\d])(\d{4})(\d{2})(\d{2})[t ]?(\d{2})(\d{2})(\d{2})(?!\d)", "$1-$2-$3 $4:$5:$6")
    low = F.regexp_replace(low, r"(?<!\d)(\d{4})(\d{2})(\d{2})[t ]?(\d{2})(\d{2})(?![\d:])", "$1-$2-$3 $4:$5")
    low = F.regexp_replace(low, r"(?<!\d)(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3")
    number = lambda s: s.try_cast("int")

    def timed(s: Column) -> Column:
        of = [F.regexp_extract(s, f"(?s){_TIME}", k) for k in range(9)]
        has = s.rlike(f"(?s){_TIME}")
        return F.struct(
            has.alias("has"), F.when(has, of[1]).otherwise(s).alias("before"), F.when(has, of[8]).otherwise("").alias("after"), F.when(has, number(of[2])).otherwise(0).alias("hour"),
            F.coalesce(number(of[3]), number(of[6]), F.lit(0)).alias("minute"), F.concat_ws(".", F.coalesce(F.nullif(of[4], F.lit("")), F.lit("0")), F.nullif(of[5], F.lit(""))).try_cast("decimal(8,6)").alias("second"), of[7].alias("half"),
        )

    def zoned(x: Column) -> Column:
        sign, hours, minutes = (F.when(x["has"], F.regexp_extract(x["after"], _ZONE, k)) for k in (1, 2, 3))
        offset = (number(hours) * 60 + F.coalesce(number(minutes), F.lit(0))) * F.when(sign == "-", -1).otherwise(1)
        rest = F.when(x["has"], F.regexp_replace(x["after"], _ZONE, "")).otherwise("")
        words = F.regexp_replace(F.regexp_replace(F.concat_ws(" ", x["before"], rest, F.lit("")), _WEEKDAY, " "), _FILLER, " ")
        hour = F.when(x["half"] == "", x["hour"]).when(x["hour"].between(1, 12), x["hour"] % 12 + F.when(x["half"] == "p", 12).otherwise(0))
        return F.struct(hour.alias("hour"), x["minute"].alias("minute"), x["second"].alias("second"), F.coalesce(offset, F.lit(0)).alias("offset"), words.alias("words"))

    def counted(x: Column) -> Column:
        month = F.array_position(F.lit([m[:3] for m in fixed.MONTHS_EN]), F.substring(F.regexp_extract(x["words"], _MONTH, 1), 1, 3))
        left = F.regexp_replace(F.regexp_replace(x["words"], _MONTH, " "), r"\d+", " ")
        return F.struct(x.alias("x"), F.when(month > 0, month.cast("int")).alias("month"), F.regexp_extract_all(x["words"], F.lit(r"(\d+)"), F.lit(1)).alias("n"), (F.regexp_replace(left, r"[\s,./;'-]+", "") == "").alias("whole"))

    def dated(y: Column) -> Column:
        n, month, given = y["n"], y["month"], lambda k: F.try_element_at(y["n"], F.lit(k))
        value = lambda k: number(given(k))
        is_year = lambda k: (F.length(given(k)) == 4) | (value(k) > 31)
        full = lambda k: F.when(F.length(given(k)) > 2, value(k)).otherwise(value(k) + F.when(value(k) > 68, 1900).otherwise(2000))
        missing = lambda part: part(default).cast("int") if default is not None else F.lit(None).cast("int")
        size, named = F.size(n), month.isNotNull()
        swap = (value(1) > 12) | (F.lit(day_first) & (value(2) <= 12))
        year = (
            F.when(named & (size == 2), F.when(is_year(1), full(1)).otherwise(full(2))).when(named & (size == 1), F.when(is_year(1), full(1)).otherwise(missing(F.year)))
            .when(size == 3, F.when(is_year(1), full(1)).otherwise(full(3))).when(~named & (size == 2) & is_year(1), full(1)).when(~named & (size == 2), F.when(is_year(2), full(2)).otherwise(missing(F.year))).when(size == 0, missing(F.year))
        )
        of_month = (
            F.when(named, month).when(size == 3, F.when(is_year(1), value(2)).otherwise(F.when(swap, value(2)).otherwise(value(1))))
            .when(size == 2, F.when(is_year(1), value(2)).when(is_year(2), value(1)).when(swap, value(2)).otherwise(value(1))).when(size == 0, missing(F.month))
        )
        day = (
            F.when(named & (size == 2), F.when(is_year(1), value(2)).otherwise(value(1))).when(named & (size == 1), F.when(is_year(1), missing(F.day)).otherwise(value(1)))
            .when(size == 3, F.when(is_year(1), value(3)).otherwise(F.when(swap, value(1)).otherwise(value(2)))).when(size == 2, F.when(is_year(1) | is_year(2), missing(F.day)).when(swap, value(1)).otherwise(value(2))).when(size == 0, missing(F.day))
        )
        x = y["x"]
        at = F.try_make_timestamp(year, of_month, day, x["hour"], x["minute"], x["second"])
        return F.when(y["whole"] & (size <= F.when(named, 2).otherwise(3)), at - F.make_dt_interval(mins=x["offset"]))

    return F.when(F.trim(text) != "", _once(_once(_once(_once(low, timed), zoned), counted), dated))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def epoch_to_iso(seconds: Column) -> Column:
    return iso_utc(F.timestamp_seconds(seconds))


def offset_to_iso(text: Column) -> Column:
    """`2026-08-25T13:00:00+02:00` -> `2026-08-25T11:00:00+00:00` (session time zone UTC)."""
    return iso_utc(F.try_to_timestamp(text))


def stable_event_id(sport: Column, league: Column, home: Column, away: Column, iso: Column) -> Column:
    parts = [sport, league, normalize_name(home), normalize_name(away), F.substring(iso, 1, 10)]
    return F.substring(F.sha1(F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in parts))), 1, 16)


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def coalesce_score(first: Column, second: Column) -> Column:
    """The first that is neither NULL nor empty; 0 counts."""
    return F.coalesce(blank_to_null(first), second)


def typed(text: Column, kind: str) -> Column:
    """Blank to NULL, then a cast that gives NULL for bad text."""
    return blank_to_null(text).try_cast(kind)


def title_words(slug: Column) -> Column:
    return F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))


def venue_country(path: Column) -> Column:
    country = F.split_part(path, F.lit("/"), F.lit(1))
    return F.coalesce(F.try_element_at(_table(fixed.COUNTRY_NAMES), country), title_words(country))


def venue_city(path: Column) -> Column:
    """The table's city, else the tournament's name without one prefix and one suffix."""
    slug = F.regexp_extract(path, "^[^/]*/(.*)$", 1)
    slug = F.regexp_replace(slug, f"^(?:{'|'.join(fixed.TOURNAMENT_PREFIXES)})", "")
    slug = F.regexp_replace(slug, f"(?:{'|'.join(fixed.TOURNAMENT_SUFFIXES)})$", "")
    return F.coalesce(F.try_element_at(_table(fixed.CITIES), path), title_words(slug))


def league_tier(path: Column) -> Column:
    """0 (most important) to 5."""
    name = F.regexp_replace(path, "^[^/]*/", "")
    return (
        F.when(path.isin(fixed.GRAND_SLAMS), 0)
        .when(path.isin(fixed.MASTERS), 1)
        .when(path.isin(fixed.TIER_500), 2)
        .when(name.startswith("atp-") | name.startswith("wta-"), 3)
        .when(name.contains("challenger"), 4)
        .otherwise(5)
    )


def season_is_final(season: Column, as_of_year: int) -> Column:
    """A season of one past year; NULL and spans such as 2023-2024 are not final."""
    return F.coalesce(F.when(season.rlike(r"^\d+$"), season.try_cast("int")) < as_of_year, F.lit(False))


def season_end_year(season: Column) -> Column:
    last = F.regexp_extract(season, r"^(?:\d{4}-)?(\d{4})$", 1)
    return last.try_cast("int")


def strip_season_suffix(slug: Column) -> Column:
    return F.regexp_replace(slug, r"-(19|20)\d\d(-(19|20)\d\d)?$", "")


def host_allowed(url: Column, hosts: list[str]) -> Column:
    """The URL's host is one of ``hosts`` or below one; false for what isn't a URL."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    ok = F.lit(False)
    for h in hosts:
        ok = ok | (host == h) | host.endswith("." + h)
    return F.coalesce(ok, F.lit(False))


def resolve_url(href: Column, base: str) -> Column:
    """Absolute links as they are, links from the root behind ``base``, others NULL."""
    return F.when(href.startswith("http"), href).when(href.startswith("/"), F.concat(F.lit(base.rstrip("/")), href))


def url_fragment(url: Column) -> Column:
    """What follows the first `#`, empty without one."""
    return F.regexp_extract(url, "#(.*)$", 1)


def results_url(base: str, sport: Column, league: Column, season: Column) -> Column:
    return F.concat(F.lit(base + "/"), sport, F.lit("/"), league, F.when(F.coalesce(season, F.lit("")) != "", F.concat(F.lit("-"), season)).otherwise(""), F.lit("/results/"))


def upcoming_url(base: str, sport: Column, league: Column) -> Column:
    return F.when(F.coalesce(league, F.lit("")) != "", F.concat(F.lit(base + "/"), sport, F.lit("/"), league, F.lit("/"))).otherwise(F.concat(F.lit(base + "/matches/"), sport, F.lit("/")))


def page_url(results: Column, page: Column) -> Column:
    return F.concat(results, F.lit("#/page/"), page.cast("string"), F.lit("/"))


def tab_url(match: Column, tab: Column) -> Column:
    return F.when(F.coalesce(tab, F.lit("")) != "", F.concat(F.rtrim(match, F.lit("/")), F.lit("/#"), tab)).otherwise(match)


def listing_outcome(http: Column, rows: Column) -> Column:
    """http404 for a status of 400 or more, else ok, empty200, or uncertain without a count."""
    return F.when(http >= 400, "http404").when(rows > 0, "ok").when((rows == 0) & (http == 200), "empty200").otherwise("uncertain")


def season_complete(n: Column, completed_at: Column, epoch: str) -> Column:
    """Data or broken, or confirmed empty at ``epoch`` or later."""
    return F.coalesce((n != 0) | (completed_at >= epoch), F.lit(False))


def score_pair(text: Column) -> Column:
    """struct(home, away) of a score that is the whole text, else of a pair within it that
    isn't part of a longer number and doesn't look like a time; NULL without one."""
    whole, inner = r"^(\d+)\s*[:\-]\s*(\d+)$", r"(?<![:\d])(\d{1,2})\s*:\s*(\d{1,2})(?![:\d])"
    pair = lambda p: F.struct(F.regexp_extract(text, p, 1).try_cast("int").alias("home"), F.regexp_extract(text, p, 2).try_cast("int").alias("away"))
    time_like = F.regexp_extract(text, inner, 0).rlike(r"^\d{2}:\d{2}$")
    return F.when(text.rlike(whole), pair(whole)).when(text.rlike(inner) & ~time_like, pair(inner))


def set_scores(text: Column, status: Column) -> Column:
    """`(6:7, 7:6)` -> `6-7 7-6`, for finished matches with any."""
    pairs = F.regexp_extract_all(F.regexp_extract(text, r"\(([^)]+)\)", 1), F.lit(r"\d+\s*[:\-]\s*\d+"), F.lit(0))
    out = F.array_join(F.transform(pairs, lambda p: F.regexp_replace(p, r"\s*[:\-]\s*", "-")), " ")
    return F.when((status == "finished") & (out != ""), out)


def round_label_stripped(text: Column) -> Column:
    """What stands before the first dash."""
    return F.trim(F.get(F.split(text, r"\s*-\s*"), F.lit(0)))


def json_ld_event(html: Column) -> Column:
    """The first JSON-LD block of a sports event, as text."""
    blocks = F.regexp_extract_all(html, F.lit(r'(?s)<script type="application/ld\+json">(.*?)</script>'), F.lit(1))
    events = F.filter(blocks, lambda b: F.coalesce(F.get_json_object(b, "$.@type").contains("SportsEvent"), F.lit(False)))
    return F.get(events, F.lit(0))


def json_ld_fields(html: Column) -> Column:
    """struct(dt_utc, home, away, country) of the page's event."""
    event = json_ld_event(html)
    get = lambda p: blank_to_null(F.get_json_object(event, p))
    return F.struct(
        offset_to_iso(get("$.startDate")).alias("dt_utc"),
        normalize_name(get("$.homeTeam.name")).alias("home"),
        normalize_name(get("$.awayTeam.name")).alias("away"),
        get("$.location.address.addressCountry").alias("country"),
    )


def match_status(strong: Column, info: Column, participants: Column) -> Column:
    """struct(status, home, away): a score in the bold text, else in the info text beside a
    word for a result, else between the participants; without one the match is scheduled."""
    first = lambda text, p: F.when(text.rlike(p), F.struct(F.regexp_extract(text, p, 1).try_cast("int").alias("home"), F.regexp_extract(text, p, 2).try_cast("int").alias("away")))
    score = F.coalesce(
        first(strong, r"^(\d+)\s*[:\-]\s*(\d+)$"),
        F.when(info.rlike("Resultado|Result|Final|final"), first(info, r"(\d+)\s*[:\-]\s*(\d+)")),
        first(participants, r"(\d+)\s*[–—\-]\s*(\d+)"),
    )
    return F.struct(F.when(score.isNotNull(), "finished").otherwise("scheduled").alias("status"), score["home"].alias("home"), score["away"].alias("away"))
