"""What remains to be done, and in which order and by whom."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import league_tier, season_end_year
from .audit import dead_leagues, with_flag


def not_done(work: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """J-05: work whose key is not among ``done``; NULL keys match each other."""
    other = done.select(*(F.col(k).alias(f"__{k}") for k in key)).distinct()
    on = None
    for k in key:
        same = F.col(k).eqNullSafe(F.col(f"__{k}"))
        on = same if on is None else on & same
    return work.join(other, on, "left_anti")


def in_manifest(work: DataFrame, manifest: DataFrame, key: str = "league") -> DataFrame:
    """J-07: the work that the manifest names."""
    return work.join(manifest.select(key).distinct(), key, "left_semi")


def all_leagues(*parts: DataFrame) -> DataFrame:
    """X-01: the leagues of all parts, each once."""
    out = parts[0].select("league")
    for p in parts[1:]:
        out = out.union(p.select("league"))
    return out.distinct()


def only_stored(stored: DataFrame, *others: DataFrame) -> DataFrame:
    """X-02: leagues that are stored and in none of the others."""
    out = stored.select("league")
    for p in others:
        out = out.subtract(p.select("league"))
    return out.distinct()


def head_of_tiers(leagues: DataFrame, most: int = 1, n: int = 5, order: str = "league") -> DataFrame:
    """O-03: the first leagues of the tiers up to ``most``."""
    return leagues.where(league_tier(F.col("league")) <= most).orderBy(order).limit(n)


def first_groups(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """O-03: the first ``n`` keys in their order."""
    return df.select(*key).distinct().orderBy(*key).limit(n)


def season_span(events: DataFrame) -> DataFrame:
    """A-11: first, last and all years of each league's seasons."""
    year = season_end_year(F.col("season"))
    rows = events.select("league", year.alias("year")).where("year is not null")
    return rows.groupBy("league").agg(F.min("year").alias("first"), F.max("year").alias("last"), F.collect_set("year").alias("years"))


def gap_years(spans: DataFrame, floor: int = 1998) -> DataFrame:
    """X-03: (league, year) missing between first and last, and the year before if not below ``floor``."""
    before = F.when(F.col("first") - 1 >= floor, F.array(F.col("first") - 1)).otherwise(F.array().cast("array<int>"))
    gaps = F.array_except(F.sequence("first", "last"), "years")
    return spans.select("league", F.explode(F.concat(gaps, before)).alias("year"))


def assign_round_robin(leagues: DataFrame, shards: int, order: str = "league") -> DataFrame:
    """W-04: the sorted list dealt to shards in turn. The list is of leagues: one task sorts it."""
    return leagues.withColumn("shard", (F.row_number().over(Window.orderBy(order)) - 1) % shards)


def prioritised(leagues: DataFrame, covered: DataFrame, best_first: bool = True) -> DataFrame:
    """O-01: covered leagues first, then by tier, then by path; `priority` counts from 1."""
    rows = with_flag(leagues, covered.select("league").distinct(), "league", "covered").withColumn("tier", league_tier(F.col("league")))
    tier = F.col("tier") if best_first else -F.col("tier")
    return rows.withColumn("priority", F.row_number().over(Window.orderBy(F.desc("covered"), tier, "league")))


def worklist(discovered: DataFrame, known: DataFrame, events: DataFrame, state: DataFrame, manifest: DataFrame | None, shard: int, shards: int) -> DataFrame:
    """X-04: all leagues, less dead ones, those of one shard, in order, if the manifest has them."""
    leagues = all_leagues(discovered, known, events)
    leagues = leagues.join(dead_leagues(state, events), "league", "left_anti")
    mine = assign_round_robin(leagues, shards).where(F.col("shard") == shard)
    if manifest is not None:
        mine = in_manifest(mine, manifest)
    return prioritised(mine, events)
