"""Dimensions: surrogate ids, decoding, remapping between shards, the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import FEW, stored
from .merge import first_wins
from .sequence import ranked

def encode(names: DataFrame, known: DataFrame | None = None, column: str = "name") -> DataFrame:
    """M-01: (id, name) for every distinct name; known ids stay, new ones follow in name order."""
    new = names.select(F.col(column).alias("name")).where("name is not null").distinct()
    if known is None:
        return ranked(new, ["name"], "id").select("id", "name")
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).cast("long").alias("top"))
    fresh = ranked(new.join(known, "name", "left_anti"), ["name"], "id").crossJoin(F.broadcast(top))  # top is one row
    return known.select(F.col("id").cast("long").alias("id"), "name").unionByName(fresh.select((F.col("top") + F.col("id")).alias("id"), "name"))


def encoded_by(df: DataFrame, dim: DataFrame, column: str, id_column: str) -> DataFrame:
    """``df`` with the id of ``column`` in place of its value; NULL for what the dimension lacks."""
    ids = dim.select(F.col("id").alias(id_column), F.col("name").alias("__name"))
    return df.join(ids, F.col(column).cast("string") == F.col("__name"), "left").drop(column, "__name")


def decode(events: DataFrame, leagues: DataFrame, teams: DataFrame) -> DataFrame:
    """J-01: names for league_id, home_id and away_id, inner."""
    role = lambda dim, r: dim.select(F.col("id").alias(f"{r}_id"), F.col("name").alias(r))
    return events.join(role(leagues, "league"), "league_id").join(role(teams, "home"), "home_id").join(role(teams, "away"), "away_id")


def remap(df: DataFrame, column: str, old: DataFrame, new: DataFrame) -> DataFrame:
    """J-02: ids of ``old`` (id, name) to those of ``new`` by name; rows without one are dropped."""
    ids = old.select(F.col("id").alias(column), "name").join(new.select(F.col("id").alias("__new"), "name"), "name").drop("name")
    return df.join(ids, column).withColumn(column, F.col("__new")).drop("__new")


#: S-09: the dimensions, and the columns of wide odds rows whose values they hold.
STAR = {"sports": ["sport"], "leagues": ["league"], "teams": ["home", "away"], "bookmakers": ["bookmaker"], "markets": ["market"], "submkts": ["submarket"], "outcomes": ["outcome"]}
ODDS_COLUMNS = ["market", "submarket", "outcome", "bookmaker"]


def dictionary(rows: DataFrame, columns: dict[str, list[str]], owners: dict[str, str] | None = None) -> DataFrame:
    """M-01 for several dimensions in one pass: (dim, id, name) of every distinct name that the
    columns of a dimension hold, ids from 1 in each in name order. Written, so that its size is
    known where it is joined. ``owners`` gives a column for a dimension: ``owner`` is then the
    least value of it that the name came with, NULL for other dimensions."""
    owners = owners or {}
    none = F.lit(None).cast(rows.schema[next(iter(owners.values()))].dataType if owners else "string")
    entry = lambda dim, c: F.struct(F.lit(dim).alias("dim"), F.col(c).cast("string").alias("name"), (F.col(owners[dim]) if dim in owners else none).alias("owner"))
    every = F.array(*(entry(dim, c) for dim, cs in columns.items() for c in cs))
    names = rows.select(F.inline(every)).where("name is not null").distinct()
    if owners:  # of the distinct rows, which are few; in one plan with them all rows would be sorted
        names = stored(names, "names").groupBy("dim", "name").agg(F.min("owner").alias("owner"))
    return stored(ranked(names, ["dim", "name"], "id", ("dim",)).select("dim", "id", "name", *(["owner"] if owners else [])), "dictionary")


def star(wide: DataFrame, event_columns: list[str], odds_values: list[str], order: list[str]) -> dict[str, DataFrame]:
    """S-09: wide rows of odds as seven dimensions, events (a row for each event_id, the first
    by ``order``, with league_id, home_id, away_id and ``event_columns``) and odds (a row for
    each event and each of ``ODDS_COLUMNS``, the first by ``order``). leagues has its sport_id.
    A missing name has a missing id; a league of several sports has the first.

    What makes the wide rows is worked out once: they are written, and read for the names, for
    the events and for the odds."""
    wide = stored(wide.select(*dict.fromkeys(["event_id", *(c for cs in STAR.values() for c in cs), *event_columns, *odds_values, *order])), "wide")
    names = dictionary(wide, STAR, {"leagues": "sport"})
    out = {t: names.where(F.col("dim") == t).select("id", "name") for t in STAR}
    leagues = names.where("dim = 'leagues'").select("id", "name", F.col("owner").alias("sport"))
    out["leagues"] = encoded_by(leagues, out["sports"], "sport", "sport_id").select("id", "sport_id", "name")
    events = first_wins(wide, ["event_id"], order).select("event_id", "league", "home", "away", *event_columns)
    for column, dim in (("league", "leagues"), ("home", "teams"), ("away", "teams")):
        events = encoded_by(events, out[dim], column, f"{column}_id")
    odds = first_wins(wide, ["event_id", *ODDS_COLUMNS], order).select("event_id", *ODDS_COLUMNS, *odds_values)
    for column, dim in zip(ODDS_COLUMNS, ("markets", "submkts", "outcomes", "bookmakers"), strict=True):
        odds = encoded_by(odds, out[dim], column, f"{column}_id")
    return out | {"events": events, "odds": odds}


def unstar(tables: dict[str, DataFrame]) -> DataFrame:
    """The wide rows again, one for each row of odds."""

    def named(df: DataFrame, column: str, dim: str, *more: str) -> DataFrame:
        names = tables[dim].select(F.col("id").alias(f"{column}_id"), F.col("name").alias(column), *more)
        return df.join(names, f"{column}_id", "left").drop(f"{column}_id")

    events = named(named(named(named(tables["events"], "league", "leagues", "sport_id"), "sport", "sports"), "home", "teams"), "away", "teams")
    odds = tables["odds"]
    for column, dim in zip(ODDS_COLUMNS, ("markets", "submkts", "outcomes", "bookmakers"), strict=True):
        odds = named(odds, column, dim)
    return odds.join(events, "event_id")


def merged_names(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J-02 for all shards at once: of (shard_rank, dim, id, name) the merged dimensions (dim,
    id, name) and the mapping (shard_rank, dim, old, new). An id that a shard has several names for
    has the first of them."""
    merged = ranked(names.select("dim", "name").distinct(), ["dim", "name"], "id")
    new = merged.select("dim", "name", F.col("id").alias("new"))
    mapping = names.join(new, ["dim", "name"]).groupBy("shard_rank", "dim", F.col("id").alias("old")).agg(F.min("new").alias("new"))
    return merged.select("dim", "id", "name"), mapping


def short_dims(rows: DataFrame) -> set[str]:
    """The dimensions with ``FEW`` rows at most in a table of all of them, whose size says nothing of
    the one that is joined."""
    return {r["dim"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).where(F.col("n") <= FEW).select("dim").collect()}


def remapped(df: DataFrame, mapping: DataFrame, columns: dict[str, str], short: set[str]) -> DataFrame:
    """J-02: the columns' ids as those of the merged dimensions; rows with an id that their
    shard has no name for are dropped. Of ``short`` dimensions the mapping is broadcast."""
    for column, dim in columns.items():
        ids = mapping.where(F.col("dim") == dim).select("shard_rank", F.col("old").alias(column), "new")
        df = df.join(F.broadcast(ids) if dim in short else ids, ["shard_rank", column]).withColumn(column, F.col("new")).drop("new")
    return df


def with_names(df: DataFrame, mapping: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The rows all of whose ids their shard has a name for, not remapped yet. Rows stay where
    they are: their distinct ids are exchanged, and those without a name broadcast, unless they
    are many."""
    ids = F.array(*(F.struct(F.lit(dim).alias("dim"), F.col(c).alias("old")) for c, dim in columns.items()))
    df = df.dropna(subset=["shard_rank", *columns])
    lost = stored(df.select("shard_rank", F.inline(ids)).distinct().join(mapping, ["shard_rank", "dim", "old"], "left_anti"), "lost")
    few = lost.count() <= FEW
    for column, dim in columns.items():
        mine = (lost if few else mapping).where(F.col("dim") == dim).select("shard_rank", F.col("old").alias(column))
        df = df.join(F.broadcast(mine) if few else mine, ["shard_rank", column], "left_anti" if few else "left_semi")
    return df


def resolve_alias(rows: DataFrame, aliases: DataFrame, given: str = "given", sport: str = "sport") -> DataFrame:
    """P-19: path of a given name and whether it was rejected. aliases: (alias, sport, path).
    A known alias of another sport is rejected; an unknown name passes without outer slashes."""
    known = aliases.select(F.col("alias").alias(given), F.col("sport").alias("__own"), F.col("path").alias("__known"))
    rejected = F.coalesce(F.col("__own") != F.col(sport), F.lit(False))
    path = F.when(F.col("__known").isNull(), F.regexp_replace(given, "^/+|/+$", "")).when(~rejected, F.col("__known"))
    return rows.join(known, given, "left").withColumn("path", path).withColumn("rejected", rejected).drop("__own", "__known")
