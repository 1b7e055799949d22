"""Which of several rows of a key wins, and repairs after a merge.

Every rule takes an explicit order; none depends on the order in which rows arrive. NULL keys
are equal to each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null
from ..session import FEW, stored


def first_wins(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """M-02: the first row of each key."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")


def first_wins_of_few(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """M-02 where few rows share a key. Only a short hash of each row's key is exchanged, to find
    those that occur again; rows whose hash does, by chance or by their key, are dealt by the key
    itself, all others are the first as they are. ``df`` is worked out three times. If many
    rows share a key, all are dealt. Dealt before they are sorted, as sorting a task's rows would
    drop almost none."""
    code = F.shiftrightunsigned(F.xxhash64(*key), 24)  # 40 bits, a byte of which each costs when they are exchanged
    again = df.select(code.alias("__code")).repartition("__code").groupBy("__code").agg(F.count("*").alias("__n")).where("__n > 1").select("__code")
    again = stored(again, "again")
    if again.count() > FEW:
        return first_wins(df.repartition(*key), key, order)
    rows, again = df.withColumn("__code", code), F.broadcast(again)
    alone, several = (rows.join(again, "__code", how).drop("__code") for how in ("left_anti", "left_semi"))
    return alone.unionByName(first_wins(several.repartition(*key), key, order))


def keep_last(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """M-06: the last row of each key."""
    return first_wins(df, key, [F.desc(c) for c in order])


def append_idempotent(stored: DataFrame, new: DataFrame, key: list[str], order: list) -> DataFrame:
    """M-07: stored and new rows, new ones winning; appending the same rows again changes nothing."""
    both = stored.withColumn("__batch", F.lit(0)).unionByName(new.withColumn("__batch", F.lit(1)), allowMissingColumns=True)
    return keep_last(both, key, ["__batch", *order]).drop("__batch")


def merge_events(shards: DataFrame, key: str = "id", rank: str = "shard_rank") -> DataFrame:
    """M-03: one row per event. Base columns come from the first row. Rows fill in a score,
    its sets and the finished status only up to the first row that has a home score."""
    mine = Window.partitionBy(key)
    upto = F.col(rank) <= F.coalesce(F.col("__scored"), F.col(rank))
    late = upto & (F.col(rank) > F.col("__first"))
    rows = shards.withColumns({"__scored": F.min(F.when(F.col("score_home").isNotNull(), F.col(rank))).over(mine), "__first": F.min(rank).over(mine)})
    when = lambda ok: F.when(ok, F.col(rank))
    base = [c for c in shards.columns if c not in (key, rank, "score_home", "score_away", "sets_detail", "status")]
    first_status = F.min_by("status", rank)
    return rows.groupBy(key).agg(
        *(F.min_by(c, rank).alias(c) for c in base),
        F.min_by("score_home", when(F.col("score_home").isNotNull())).alias("score_home"),
        F.max_by("score_away", when(F.col("score_away").isNotNull() & upto)).alias("score_away"),
        F.max_by("sets_detail", when(F.col("sets_detail").isNotNull() & upto)).alias("sets_detail"),
        F.when(F.max(late & (F.col("status") == "finished")), "finished").otherwise(first_status).alias("status"),
    )


def upsert_events(rows: DataFrame, key: str = "id", seq: str = "seq") -> DataFrame:
    """M-04: base columns from the first row; score, sets and status together from the first
    row that has a score, if any; the first season that isn't blank."""
    together = ["score_home", "score_away", "sets_detail", "status"]
    values = F.struct(*together)
    scored = F.min_by(values, F.when(F.col("score_home").isNotNull(), F.col(seq)))
    base = [c for c in rows.columns if c not in (key, seq, "season", *together)]
    out = rows.groupBy(key).agg(
        *(F.min_by(c, seq).alias(c) for c in base),
        F.coalesce(scored, F.min_by(values, seq)).alias("__v"),
        F.min_by("season", F.when(blank_to_null(F.col("season")).isNotNull(), F.col(seq))).alias("season"),
    )
    return out.select(key, *base, "season", *(F.col(f"__v.{c}").alias(c) for c in together))


def merge_season_state(rows: DataFrame, rank: str = "shard_rank") -> DataFrame:
    """M-05: the largest count, and the completion time that the last shard has, even none."""
    return rows.groupBy("league", "season").agg(F.max("n").alias("n"), F.max_by("completed_at", rank).alias("completed_at"))


def fill_zero_scores(events: DataFrame) -> DataFrame:
    """M-08: a finished event with one score missing had 0 there; `repaired` names the side."""
    done, home, away = F.col("status") == "finished", F.col("score_home"), F.col("score_away")
    side = F.when(done & home.isNull() & away.isNotNull(), "home").when(done & home.isNotNull() & away.isNull(), "away")
    return events.withColumn("repaired", side).withColumns({"score_home": F.when(F.col("repaired") == "home", 0).otherwise(home), "score_away": F.when(F.col("repaired") == "away", 0).otherwise(away)})


def infer_season(events: DataFrame, dt: Column) -> DataFrame:
    """M-09: a blank season is the year of the event."""
    return events.withColumn("season", F.coalesce(blank_to_null(F.col("season")), F.date_format(dt, "yyyy")))


def drop_false_empty(state: DataFrame, events: DataFrame) -> DataFrame:
    """J-08: without states that say empty (0) for a season that has events."""
    seen = events.select("league", "season").distinct().withColumn("__seen", F.lit(True))
    return state.join(seen, ["league", "season"], "left").where("n <> 0 or __seen is null").drop("__seen")


def overlay_recovered(stored: DataFrame, runs: DataFrame, keep_found: bool = False) -> DataFrame:
    """M-10: per event the newest result, even a missing one; keep_found prefers found ones."""
    seq = F.when(F.col("score_home").isNotNull(), F.col("run_seq")) if keep_found else F.col("run_seq")
    both = stored.withColumn("run_seq", F.lit(-1)).unionByName(runs)
    value = F.struct("score_home", "score_away")
    newest = F.coalesce(F.max_by(value, seq), F.max_by(value, "run_seq")).alias("__v")
    return both.groupBy("id").agg(newest).select("id", "__v.score_home", "__v.score_away")


def grant_amnesty(state: DataFrame, gaps: DataFrame, cutoff: str, include_root: bool = False) -> DataFrame:
    """M-11: without marks n <= 0 older than ``cutoff`` for seasons in the gaps (league, year),
    written Y or Y-1-Y, and with include_root without old broken marks of whole leagues."""
    year = F.col("year")
    forms = gaps.select("league", F.explode(F.array(year.cast("string"), F.concat_ws("-", (year - 1).cast("string"), year.cast("string")))).alias("season")).distinct().withColumn("__gap", F.lit(True))
    old = F.coalesce(F.col("completed_at") < F.lit(cutoff).cast("timestamp"), F.lit(True))
    root = F.lit(include_root) & (F.col("season") == "") & (F.col("n") < 0)
    gone = old & ((F.col("__gap").isNotNull() & (F.col("n") <= 0)) | root)
    return state.join(forms, ["league", "season"], "left").where(~gone).drop("__gap")
