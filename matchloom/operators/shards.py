"""The whole merge of shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .audit import table_counts
from .dims import merged_names, remapped, short_dims, with_names
from .merge import drop_false_empty, fill_zero_scores, first_wins_of_few, infer_season, merge_events, merge_season_state

EVENT_IDS = {"league_id": "leagues", "home_id": "teams", "away_id": "teams"}
ODDS_IDS = {"market_id": "markets", "submarket_id": "submkts", "outcome_id": "outcomes", "bookmaker_id": "bookmakers"}

TABLES = ("dims", "events", "odds", "state")


def merge_shards(names: DataFrame, events: DataFrame, odds: DataFrame, state: DataFrame, odds_order: list, tables: tuple[str, ...] = TABLES) -> dict[str, DataFrame]:
    """M-12: names, events, odds and season states of ranked shards as one set: J-02, then M-03,
    M-02 and M-05, then the repairs M-08, M-09 and J-08.

    Each table has shard_rank; names are (dim, id, name) in the ids of the shard, and the other
    tables refer to them, states to leagues by name. Rows with an id that has no name are
    dropped. Events are one shuffle by id; of odds, few of which share a key, only hashes are
    exchanged. Of ``tables`` those that aren't named aren't worked out; dims are those of names."""
    dims, mapping = merged_names(stored(names, "names"))
    dims, mapping = stored(dims, "dims"), stored(mapping, "mapping")
    short, out = short_dims(mapping), {"dims": dims}
    if "events" in tables or "state" in tables:
        # An event has the ids of its first row: those of long dimensions are remapped behind the fold, where
        # there are fewer rows, and only for who reads them.
        long = {c: dim for c, dim in EVENT_IDS.items() if dim not in short}
        rows = remapped(events, mapping, {c: dim for c, dim in EVENT_IDS.items() if dim in short}, short)
        rows = (with_names(rows, mapping, long) if long else rows).withColumn("__shard", F.col("shard_rank"))
        folded = stored(fill_zero_scores(infer_season(merge_events(rows), F.col("dt"))).drop("repaired"), "events").withColumnRenamed("__shard", "shard_rank")
        leagues = dims.where("dim = 'leagues'").select(F.col("id").alias("league_id"), F.col("name").alias("league"))
        seasons = remapped(folded.select("shard_rank", "league_id", "season").distinct(), mapping, {c: dim for c, dim in long.items() if c == "league_id"}, short)
        out |= {"events": remapped(folded, mapping, long, short).drop("shard_rank"), "state": drop_false_empty(merge_season_state(state), seasons.drop("shard_rank").distinct().join(leagues, "league_id"))}
    if "odds" in tables:
        out["odds"] = first_wins_of_few(remapped(odds, mapping, ODDS_IDS, short), ["event_id", *ODDS_IDS], ["shard_rank", *odds_order]).drop("shard_rank")
    return {t: out[t] for t in TABLES if t in out and t in ("dims", *tables)}


def final_counts(merged: dict[str, DataFrame]) -> DataFrame:
    """A-05 of a merge: its events and odds, each dimension, the seasons and the empty ones."""
    dims = merged["dims"].groupBy(F.col("dim").alias("name")).agg(F.count("*").alias("n"))
    rest = {"events": merged["events"], "odds": merged["odds"], "seasons_cached": merged["state"], "seasons_empty": merged["state"].where("n = 0")}
    return dims.unionByName(table_counts(rest))
