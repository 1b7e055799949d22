"""Rows from pages: patterns and document order, no document tree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import OUTCOMES
from .merge import first_wins
from .sequence import carried

ELEMENT = r"(?s)<(title|h1|b|p|a)\b[^>]*>(.*?)</\1>"


def elements(pages: DataFrame, pattern: str = ELEMENT) -> DataFrame:
    """H-01: (page_id, url, pos, tag, raw, text) of the elements, in document order."""
    found = pages.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(pattern), F.lit(0))).alias("pos", "raw"))
    text = F.trim(F.regexp_replace("raw", r"(?s)<[^>]*>", ""))
    return found.select("page_id", "url", "pos", F.regexp_extract("raw", r"^<(\w+)", 1).alias("tag"), "raw", text.alias("text"))


def rows_under_header(tokens: DataFrame, is_header: Column, is_row: Column) -> DataFrame:
    """H-02: rows with the text of the latest header before them; NULL before the first."""
    header = carried(F.when(is_header, F.col("text")), ["page_id"], ["pos"])
    return tokens.withColumn("header", header).where(is_row)


def first_by_url(links: DataFrame, order: list[str]) -> DataFrame:
    """H-03: the first row of each URL."""
    return first_wins(links, ["link"], order)


def page_count(text: Column, pattern: str = r"#/page/(\d+)/") -> Column:
    """H-04: the largest page number, 1 without any."""
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda x: x.try_cast("int"))), F.lit(1))


def links(pages: DataFrame, pattern: str = r'href="([^"]+)"') -> DataFrame:
    """(page_id, pos, link) of all links, in document order."""
    return pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("pos", "link"))


def slugs(pages: DataFrame, pattern: str, invalid: list[str]) -> DataFrame:
    """H-05: distinct slugs by pattern, without those with an invalid segment."""
    found = pages.select(F.explode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("slug")).distinct()
    return found.where(~F.arrays_overlap(F.split("slug", "/"), F.lit(invalid)) & (F.col("slug") != ""))


def fixed_outcomes(rows: DataFrame, outcomes: list[str], keep: list[str]) -> DataFrame:
    """H-06: the i-th cell of a bookmaker's row is the i-th outcome's odds, up to the shorter
    list. Rows without a bookmaker are dropped; odds that can't be read stay as NULL."""
    names = F.lit(outcomes)
    n = F.least(F.size("cells"), F.size(names))
    pairs = F.slice(F.arrays_zip(names.alias("outcome"), F.col("cells").alias("odds_closing")), F.lit(1), n)
    out = rows.where("bookmaker is not null").select(*keep, "bookmaker", F.explode(pairs).alias("__p"))
    return out.select(*keep, "bookmaker", "__p.outcome", "__p.odds_closing")


def line_value(attribute: Column, title: Column, key: list[str], order: list) -> Column:
    """H-07: the line from the attribute, else the title's number, else the last line before, else empty."""
    own = F.coalesce(F.when(attribute != "", attribute), F.nullif(F.regexp_extract(title, r"([+-]?\d+(?:\.\d+)?)", 1), F.lit("")))
    return F.coalesce(carried(own, key, order), F.lit(""))


def best_prices(rows: DataFrame, outcomes: list[str], keep: list[str]) -> DataFrame:
    """H-08: collapsed rows: the signed number at the label's end is the line, the bookmaker
    is `best`; rows without such a number are dropped."""
    line = F.regexp_extract("label", r"([+-]?\d+(?:\.\d+)?)\s*$", 1)
    rows = rows.withColumns({"submarket": line, "bookmaker": F.lit("best")}).where("submarket <> ''")
    return fixed_outcomes(rows, outcomes, [*keep, "submarket"])


def grid(rows: DataFrame, keep: list[str]) -> DataFrame:
    """H-09: cell j of a bookmaker's row stands under header j, or col_j where there is none."""
    cells = rows.where("bookmaker is not null").select(*keep, "bookmaker", "headers", F.posexplode("cells").alias("__j", "odds_closing"))
    head = F.coalesce(F.try_element_at("headers", F.col("__j") + 1), F.concat(F.lit("col_"), F.col("__j").cast("string")))
    return cells.select(*keep, "bookmaker", head.alias("submarket"), F.lit("yes").alias("outcome"), "odds_closing")


def assemble_header(header: DataFrame, listing: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """H-10: field by field the header's value, else the listing's."""
    other = listing.select(key, *(F.col(f).alias(f"__{f}") for f in fields))
    rows = header.join(other, key, "left")
    return rows.select(key, *(F.coalesce(F.col(f), F.col(f"__{f}")).alias(f) for f in fields))


def tab_labels(active: Column, inactive: Column) -> Column:
    """H-11: the active tab's label first, then the others, each once, none empty."""
    return F.array_distinct(F.filter(F.concat(active, inactive), lambda x: x.isNotNull() & (x != "")))


def as_upcoming(listing: DataFrame) -> DataFrame:
    """H-12: all scheduled, no scores."""
    return listing.withColumns({"status": F.lit("scheduled"), "score_home": F.lit(None).cast("int"), "score_away": F.lit(None).cast("int")})


def sitemap(pages: DataFrame, body: str, leaf: str) -> DataFrame:
    """S-08: distinct slugs in the <loc> entries of all bodies; ``leaf`` has one group."""
    loc = pages.select(F.explode(F.regexp_extract_all(F.col(body), F.lit(r"<loc>([^<]*)</loc>"), F.lit(1))).alias("loc"))
    return loc.select(F.regexp_extract("loc", leaf, 1).alias("slug")).where("slug <> ''").distinct()


#: K-02: market -> a job on the rows of that market.
Extractor = Callable[[DataFrame], DataFrame]
EXTRACTORS: dict[str, Extractor] = {m: (lambda rows, o=o: fixed_outcomes(rows, o, ["event_id", "market"])) for m, o in OUTCOMES.items()}


def extract_markets(rows: DataFrame, extractors: dict[str, Extractor], failed: list[str] | None = None) -> DataFrame:
    """K-02: each market's rows through its extractor, results together. A market whose job
    can't be built is left out and named in ``failed``."""
    parts = []
    for market, job in extractors.items():
        try:
            parts.append(job(rows.where(F.col("market") == market)))
        except Exception:  # noqa: BLE001  one market must not cost the others
            if failed is None:
                raise
            failed.append(market)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def latest_fresh(pages: DataFrame, as_of: Column, ttl_days: int = 7, key: str = "key", at: str = "fetched_at") -> DataFrame:
    """S-07: the latest version of each key, if it is no older than the time to live."""
    body = F.struct(*[c for c in pages.columns if c != key])
    out = pages.groupBy(key).agg(F.max_by(body, at).alias("__b")).select(key, "__b.*")
    return out.where(F.col(at) >= as_of - F.expr(f"interval {ttl_days} days"))


def numbered(df: DataFrame, key: list[str], order: list, name: str = "n") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
