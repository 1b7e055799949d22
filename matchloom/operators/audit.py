"""Completeness and consistency of loaded data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import league_tier


def between(events: DataFrame, first: str, last: str, league: str, columns: list[str], dt: str = "dt") -> DataFrame:
    """F-01: distinct rows of ``columns`` of events from ``first`` to ``last`` whose league has
    the pattern ``league``, case not regarded; events without a league are left out."""
    inside = F.col(dt).between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"))
    return events.where(inside & F.col("league").rlike(f"(?i){league}")).select(*columns).dropDuplicates()


def stale(events: DataFrame, as_of: str, days: int = 2, dt: str = "dt") -> DataFrame:
    """F-02: events of days strictly before ``as_of`` less ``days``."""
    return events.where(F.to_date(dt) < F.date_sub(F.lit(as_of).cast("date"), days))


def phantoms(events: DataFrame, as_of: str | None = None) -> DataFrame:
    """F-03: scheduled for midnight, with a URL; with ``as_of`` only what is past."""
    out = events.where((F.date_format("dt", "HH:mm:ss") == "00:00:00") & (F.col("status") == "scheduled") & F.col("source_url").isNotNull())
    return out.where(F.col("dt") < F.lit(as_of).cast("timestamp")) if as_of else out


def with_flag(df: DataFrame, keys: DataFrame, on: Column | str | list, name: str) -> DataFrame:
    """``df`` with a boolean: whether a row's key is among the distinct ``keys``."""
    return df.join(keys.withColumn(name, F.lit(True)), on, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def having_odds(events: DataFrame, odds: DataFrame, market: str = "home_away") -> DataFrame:
    """J-03: events with odds of a market."""
    return events.join(odds.where(F.col("market") == market).select(F.col("event_id").alias("id")), "id", "left_semi")


def _flagged(events: DataFrame, odds: DataFrame, market: str) -> DataFrame:
    keys = odds.where(F.col("market") == market).select(F.col("event_id").alias("id")).distinct()
    return with_flag(events, keys, "id", "has_odds")


def incomplete(events: DataFrame, odds: DataFrame, market: str = "home_away") -> DataFrame:
    """J-04: no score, or no odds of the market, or finished without sets."""
    return _flagged(events, odds, market).where("score_home is null or not has_odds or (status = 'finished' and sets_detail is null)")


def completeness(events: DataFrame, odds: DataFrame, as_of: str, market: str = "home_away") -> DataFrame:
    """A-01: past events per league and season: all, scored, with odds; incomplete groups only."""
    rows = _flagged(stale(events, as_of), odds, market)
    out = rows.groupBy("league", "season").agg(F.count("*").alias("total"), F.count_if(F.col("score_home").isNotNull()).alias("scored"), F.count_if("has_odds").alias("with_odds"))
    return out.where("scored < total or with_odds < total")


def missing(report: DataFrame) -> DataFrame:
    """The report with the number of events without a score."""
    return report.withColumn("missing", F.col("total") - F.col("scored"))


def completeness_rollup(report: DataFrame) -> DataFrame:
    """A-02: number of incomplete groups, events without a score, and the share scored in per cent."""
    sums = missing(report).agg(F.count("*").alias("groups"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"), F.sum("total").alias("total"), F.sum("scored").alias("scored"))
    return sums.select("groups", "missing", (100.0 * F.col("scored") / F.col("total")).alias("scored_pct"))


def top_incomplete(report: DataFrame, n: int = 5) -> DataFrame:
    """O-02: the groups with the most events without a score."""
    return missing(report).orderBy(F.desc("missing"), "league", "season").limit(n)


def orphans(odds: DataFrame, events: DataFrame) -> DataFrame:
    """J-12: odds rows whose event is missing, and events without odds, as (side, id)."""
    both = odds.select(F.col("event_id").alias("id"), F.lit(True).alias("__odds")).unionByName(events.select("id", F.lit(False).alias("__odds")))
    # One pass by id holds no more than its key and two marks; a missing id has no partner.
    seen = both.groupBy("id").agg(F.bool_or("__odds").alias("__odds"), F.bool_or(~F.col("__odds")).alias("__event"))
    alone = lambda name, here, there: F.when(F.col(here) & (~F.col(there) | F.col("id").isNull()), F.lit(name))
    sides = F.array_compact(F.array(alone("odds", "__odds", "__event"), alone("event", "__event", "__odds")))
    return seen.select(F.explode(sides).alias("side"), "id")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A-05: (name, n) of each table."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dead_leagues(state: DataFrame, events: DataFrame) -> DataFrame:
    """J-06: leagues marked broken as a whole that have no events."""
    return state.where("season = '' and n < 0").select("league").distinct().join(events.select("league").distinct(), "league", "left_anti")


def tier_histogram(leagues: DataFrame) -> DataFrame:
    """A-06: number of different leagues of each tier."""
    return leagues.select("league").distinct().groupBy(league_tier(F.col("league")).alias("tier")).agg(F.count("*").alias("n"))


def merge_summary(rows: DataFrame, match: list[str], market: Column | str = "market") -> DataFrame:
    """A-07: rows, different matches and different markets; a NULL market doesn't count."""
    return rows.agg(F.count("*").alias("n_rows"), F.count_distinct(*match).alias("matches"), F.count_distinct(market).alias("markets"))


OUTCOMES = ["ok", "empty200", "http404", "uncertain"]


def outcome_counts(log: DataFrame, as_of_year: int, by: str = "shard", season: str = "season_year") -> DataFrame:
    """A-09: outcomes of listings and the share of ok ones, of final seasons only: the current
    one is never refused and would hide the curve."""
    final = log.where(F.col(season) < as_of_year)
    return final.groupBy(by).agg(*(F.count_if(F.col("outcome") == n).alias(n) for n in OUTCOMES), (F.count_if(F.col("outcome") == "ok") / F.count("*")).alias("ok_rate"))


def run_summary(state: DataFrame) -> DataFrame:
    """A-10: leagues with data, leagues without, and season marks that were passed over."""
    per = state.groupBy("league").agg(F.count_if(F.col("n") > 0).alias("d"), F.count_if(F.col("n") <= 0).alias("skipped"))
    return per.agg(F.count_if(F.col("d") > 0).alias("with_data"), F.count_if(F.col("d") == 0).alias("without_data"), F.sum("skipped").alias("skipped"))


def counts_by(events: DataFrame, key: list[str]) -> DataFrame:
    """A-12: number of events of each key, in one pass for all."""
    return events.groupBy(*key).agg(F.count("*").alias("n"))
