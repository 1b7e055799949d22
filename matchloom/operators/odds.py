"""Prices per market."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import MARKET_KEYS, MARKETS


def valid(odds: DataFrame, column: str = "odds_closing") -> DataFrame:
    """F-04: odds above 1."""
    return odds.where(F.col(column) > 1.0)


def means(odds: DataFrame, key: list[str], column: str = "odds_closing") -> DataFrame:
    """A-03: mean of the valid odds, to four places, and their number. The sum is of decimals,
    so it doesn't depend on the order of the rows."""
    exact = F.col(column).cast("decimal(18,6)")
    return valid(odds, column).groupBy(*key).agg(F.round(F.sum(exact).cast("double") / F.count("*"), 4).alias("mean_odd"), F.count("*").alias("n_bookmakers"))


def market_keys(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MARKET_KEYS, "market string, line string, outcome string, market_key string")


def with_market_key(odds: DataFrame) -> DataFrame:
    """A-04: odds with the key of their market, line (a plus sign is dropped) and outcome;
    others are dropped."""
    keys = F.broadcast(market_keys(odds.sparkSession))  # of fixed size
    line = F.regexp_replace(F.coalesce("submarket", F.lit("")), r"^\+", "")
    return odds.withColumn("line", line).join(keys, ["market", "line", "outcome"])


def wide_means(means: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per event, a column for each market key."""
    return means.groupBy(key).pivot("market_key", [k for *_, k in MARKET_KEYS]).agg(F.first("mean_odd"))


def market_catalog(spark: SparkSession) -> DataFrame:
    """P-27: market, label, slug, has_lines, pos."""
    rows = [(*m, k) for k, m in enumerate(MARKETS)]
    return spark.createDataFrame(rows, "market string, label string, slug string, has_lines boolean, pos int")


def clickable_labels(markets: DataFrame) -> DataFrame:
    """P-27: per event the distinct tab labels of its markets, in the catalog's order."""
    cat = F.broadcast(market_catalog(markets.sparkSession))
    ordered = F.array_sort(F.collect_set(F.struct("pos", "label")))
    return markets.join(cat, "market").groupBy("event_id").agg(F.array_distinct(F.transform(ordered, lambda x: x["label"])).alias("labels"))
