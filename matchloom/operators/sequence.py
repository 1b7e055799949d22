"""Rules over rows in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def carried(value: Column, key: list[str], order: list) -> Column:
    """W-01: the latest value at or before the row that isn't NULL."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def early_stop(log: DataFrame, as_of_year: int, cutoff: int, anchors: list[int], run: int = 3) -> DataFrame:
    """W-02: where a league is declared dead, and the marks of its seasons from there on.

    ``log`` has league, y and outcome (ok, empty or broken), seasons being read from the
    latest back. An ok season ends a run. The league stops at the first final season with
    which the run of final seasons without data reaches a multiple of ``run``, after
    ``cutoff``, if that season is broken or no anchor season has data. The final seasons
    before it get -1 if it was broken, else 0. All anchors must be at or before the cutoff.

    Returns league, y, outcome, stop_y and mark (NULL before the stop).
    """
    if max(anchors) > cutoff:
        raise ValueError("anchors must not be after the cutoff")
    back = Window.partitionBy("league").orderBy(F.desc("y"))
    upto = back.rowsBetween(Window.unboundedPreceding, 0)
    mine = Window.partitionBy("league")
    final, ok = F.col("y") < as_of_year, F.col("outcome") == "ok"
    rows = log.withColumn("__island", F.sum(ok.cast("int")).over(upto))
    in_island = Window.partitionBy("league", "__island").orderBy(F.desc("y")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__run", F.sum((final & ~ok).cast("int")).over(in_island)).withColumn("__anchored", F.max(F.col("y").isin(anchors) & ok).over(mine))
    stops = final & ~ok & (F.col("__run") % run == 0) & (F.col("y") > cutoff) & ((F.col("outcome") == "broken") | ~F.col("__anchored"))
    rows = rows.withColumn("stop_y", F.max(F.when(stops, F.col("y"))).over(mine))
    rows = rows.withColumn("__broken", F.max((F.col("y") == F.col("stop_y")) & (F.col("outcome") == "broken")).over(mine))
    mark = F.when(final & (F.col("y") < F.col("stop_y")), F.when(F.col("__broken"), -1).otherwise(0))
    return rows.select("league", "y", "outcome", "stop_y", mark.alias("mark"))


def season_marks(log: DataFrame, as_of_year: int) -> DataFrame:
    """W-02, season by season: the mark of a listing without matches (league, y, outcome, and
    n_events, the events that are stored): -1 if it was broken, whatever the season, 0 if it
    was empty and the season is final, NULL if it has stored events or the outcome says
    nothing for sure."""
    mark = F.when(F.col("n_events") > 0, None).when(F.col("outcome") == "http404", -1).when((F.col("outcome") == "empty200") & (F.col("y") < as_of_year), 0)
    return log.withColumn("mark", mark.cast("int"))


def ranged(df: DataFrame, order: list) -> DataFrame:
    """``df`` with __part: rows of a part are in order behind those of the parts before it, and
    no part has to hold more than its share. Written, as another run would cut other parts."""
    return stored(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranged")


def ranked(df: DataFrame, order: list, name: str, within: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with its place from 1 in an order of all rows, without a task that has them all.
    With ``within``, the first columns of the order, places start anew for each of their values,
    which have to be few (a fixed list, say) and not NULL."""
    rows = ranged(df, order)
    sizes = rows.groupBy("__part", *within).agg(F.count("*").alias("__n"))  # as many rows as parts and values together
    before = sizes.withColumn("__before", F.sum("__n").over(Window.partitionBy(*within).orderBy("__part")) - F.col("__n")).drop("__n")
    place = F.row_number().over(Window.partitionBy("__part", *within).orderBy(*order))
    return rows.join(F.broadcast(before), ["__part", *within]).withColumn(name, (F.col("__before") + place).cast("long")).drop("__part", "__before")


def success_curve(log: DataFrame, order: list[str], every: int = 500, parts: int = 64) -> DataFrame:
    """W-03: per shard, the running share of ok outcomes at each ``every``-th row. Counted
    within parts of the order, to which the sums of the parts before are added. Parts are
    stretches of the first column of ``order`` (a number or a time) with about as many rows
    each; rows of one value of it lie in one part."""
    first = F.col(order[0]).cast("double")
    bounds = log.agg(F.approx_percentile(first, [k / parts for k in range(1, parts)], 10_000).alias("b")).first()["b"] or []
    part = F.size(F.filter(F.lit(sorted(set(bounds))) if bounds else F.array().cast("array<double>"), lambda b: b <= first))
    rows = log.select("shard", *order, part.alias("__part"), (F.col("outcome") == "ok").cast("long").alias("__ok"))
    sums = rows.groupBy("shard", "__part").agg(F.count("*").alias("__n"), F.sum("__ok").alias("__k"))
    upto = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("shard", "__part", *(F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"{c}0") for c in ("__n", "__k")))
    mine = Window.partitionBy("shard", "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"__n1": F.count("*").over(mine), "__k1": F.sum("__ok").over(mine)}).join(before, ["shard", "__part"])
    rows = rows.select("shard", (F.col("__n0") + F.col("__n1")).alias("n"), (F.col("__k0") + F.col("__k1")).alias("ok"))
    return rows.where(F.col("n") % every == 0).select("shard", "n", "ok", (F.col("ok") / F.col("n")).alias("rate"))
