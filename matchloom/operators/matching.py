"""Matching entities across sources.

Pairs come from a similarity join, not from all pairs of a block. A name is a multiset of
characters (each with a number: the first e, the second e); names that are similar by
``least`` have a share of these in common, so they share one of the few rarest ones of each,
and that many of all. Rarest characters of both names with the block are the join's key: pairs
that share none are never made, and a block that many rows have falls apart by its names.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from ..functions.scalars import normalize_name
from ..session import stored
from .merge import first_wins

PAIRS = 4096  # pairs whose blocks are looked for at once


def _codes(names: list[str], filler: int) -> np.ndarray:
    """Characters of the names as numbers, a row for each, filled up with ``filler``."""
    out = np.full((len(names), max(map(len, names), default=0)), filler, np.int32)
    for k, name in enumerate(names):
        out[k, : len(name)] = np.frombuffer(name.encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def matched_characters(ours: list[str], theirs: list[str]) -> np.ndarray:
    """Per pair the characters in matching blocks: the longest block that both have, of equal
    ones the first in ours and then in theirs, and again on both of its sides.

    All stretches that are still open are worked on together, for each place of ours at once."""
    a, b = _codes(ours, -1), _codes(theirs, -2)
    matched = np.zeros(len(ours), np.int64)
    pair = np.flatnonzero([bool(x and y) for x, y in zip(ours, theirs, strict=True)])
    low_a, low_b = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
    high_a, high_b = np.array([len(ours[k]) for k in pair], np.int64), np.array([len(theirs[k]) for k in pair], np.int64)
    place = np.arange(b.shape[1])
    while len(pair):
        inside = (place >= low_b[:, None]) & (place < high_b[:, None])
        text = b[pair]
        run = np.zeros((len(pair), len(place) + 1), np.int32)  # blocks that end here, by place of theirs
        best, end_a, end_b = np.zeros((3, len(pair)), np.int64)
        for i in range(int(low_a.min()), int(high_a.max())):
            open_ = (i >= low_a) & (i < high_a)
            same = (text == a[pair, i][:, None]) & inside & open_[:, None]
            run[:, 1:] = np.where(same, run[:, :-1] + 1, 0)
            longest = run.max(axis=1)
            better = longest > best
            best[better], end_a[better], end_b[better] = longest[better], i + 1, run[better].argmax(axis=1)
        np.add.at(matched, pair, best)
        hit = best > 0
        start_a, start_b = end_a - best, end_b - best
        sides = [(low_a, start_a, low_b, start_b), (end_a, high_a, end_b, high_b)]
        left = [hit & (la < ha) & (lb < hb) for la, ha, lb, hb in sides]
        low_a, high_a, low_b, high_b, pair = (np.concatenate([x[keep] for x, keep in zip(both, left, strict=True)]) for both in (*zip(*sides, strict=True), (pair, pair)))
    return matched


@pandas_udf(DoubleType())
def sequence_ratio(target: pd.Series, listing: pd.Series) -> pd.Series:
    """K-01: Ratcliff-Obershelp similarity, twice the matched characters as a share of both
    names'; not symmetric, so the target comes first. Two empty names are equal."""
    out = pd.Series(np.nan, index=target.index, dtype="float64")
    there = (target.notna() & listing.notna()).to_numpy()
    ours, theirs = target[there].tolist(), listing[there].tolist()
    ratios = np.empty(len(ours))
    for at in range(0, len(ours), PAIRS):
        x, y = ours[at : at + PAIRS], theirs[at : at + PAIRS]
        size = np.array([len(p) + len(q) for p, q in zip(x, y, strict=True)])
        ratios[at : at + PAIRS] = np.where(size > 0, 2.0 * matched_characters(x, y) / np.maximum(size, 1), 1.0)
    out[there] = ratios
    return out.where(out.notna(), None)


def edit_similarity(a: Column, b: Column) -> Column:
    """1 less the edit distance as a share of the longer name."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1 - F.levenshtein(a, b) / longest).otherwise(F.lit(1.0))


def plain(name: Column) -> Column:
    """A name without case and superfluous white space; a missing one is empty."""
    return F.lower(normalize_name(F.coalesce(name, F.lit(""))))


def _characters(name: Column) -> Column:
    """The characters of a name, each with its number among the equal ones."""
    chars = F.array_sort(F.split(name, ""))
    numbered = F.transform(chars, lambda c, k: F.concat(c, (k - F.array_position(chars, c) + 1).cast("string")))
    return F.when(name != "", numbered).otherwise(F.array().cast("array<string>"))


def _rarest(names: DataFrame, least: float) -> DataFrame:
    """(name, keys, sets) of different names: all characters, the rarest first, and those that
    one at least of which each similar name shares. An empty name has a key of its own."""
    tokens = names.select("name", F.explode(_characters(F.col("name"))).alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("n"))
    rare = tokens.join(often, "token").groupBy("name").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("t"))
    rare = rare.select("name", F.transform("t", lambda t: F.concat(F.lpad(t["n"].cast("string"), 12, "0"), t["token"])).alias("sets"))
    # A similar name has as many characters as this one at least times least / (2 - least), and
    # shares as many of this one's.
    shared = F.ceil(F.round(F.size("sets") * least / (2 - least), 9))
    keys = F.slice("sets", F.lit(1), (F.size("sets") - shared + 1).cast("int"))
    out = names.join(rare, "name", "left").withColumn("sets", F.coalesce("sets", F.array().cast("array<string>")))
    return out.select("name", F.when(F.size("sets") > 0, keys).otherwise(F.array(F.lit(""))).alias("keys"), "sets")


def candidate_pairs(targets: DataFrame, listings: DataFrame, least: float, names: dict[str, str]) -> DataFrame:
    """Pairs of rows of one block (targets' and listings' columns), ``names`` being columns of
    plain names of the one and the other, that may be similar in each by ``least``.

    Loses no pair for a similarity that is at most twice the characters that two names have in
    common as a share of both names' characters, as the two here are. A pair is made once: by the
    first key that both have, of each name."""
    every = reduce(DataFrame.union, (df.select(F.col(c).alias("name")) for pair in names.items() for df, c in zip((targets, listings), pair, strict=True))).distinct()
    index = stored(_rarest(every, least), "names")

    def keyed(df: DataFrame, side: str, columns: list[str]) -> DataFrame:
        for k, c in enumerate(columns):
            own = index.select(F.col("name").alias(c), F.col("keys").alias(f"__{side}keys{k}"), F.col("sets").alias(f"__{side}sets{k}"))
            df = df.join(own, c).withColumn(f"__key{k}", F.explode(f"__{side}keys{k}"))
        return df

    keys = [f"__key{k}" for k in range(len(names))]
    pairs = keyed(targets, "a", list(names)).join(keyed(listings, "b", list(names.values())), ["block", *keys])
    for k in range(len(names)):
        a, b = F.col(f"__asets{k}"), F.col(f"__bsets{k}")
        pairs = pairs.where(F.col(f"__key{k}") == F.array_min(F.array_intersect(f"__akeys{k}", f"__bkeys{k}")))
        enough = 2 * F.size(F.array_intersect(a, b)) >= F.round(least * (F.size(a) + F.size(b)), 9)
        pairs = pairs.where((2 * F.least(F.size(a), F.size(b)) >= F.round(least * (F.size(a) + F.size(b)), 9)) & enough)
    return pairs.drop(*keys, *(f"__{side}{what}{k}" for side in "ab" for what in ("keys", "sets") for k in range(len(names))))


def best_matches(targets: DataFrame, listings: DataFrame, similarity, least: float = 0.85, names: tuple[str, ...] = ("name",)) -> DataFrame:
    """J-09, W-05: per target (block, names) the listing of its block whose names are each
    similar by at least ``least`` and most similar in sum (``score``); ties go to the first by
    pos. White space and case don't count. Only pairs of ``candidate_pairs`` are compared.

    The listing's names are ``listing``, or ``listing_home`` and so on if there are several."""
    other = {n: "listing" if len(names) == 1 else f"listing_{n}" for n in names}
    ours = targets.withColumns({f"__{n}": plain(F.col(n)) for n in names})
    theirs = listings.select("block", "pos", *(F.col(n).alias(o) for n, o in other.items())).withColumns({f"__{o}": plain(F.col(o)) for o in other.values()})
    pairs = candidate_pairs(ours, theirs, least, {f"__{n}": f"__{o}" for n, o in other.items()})
    for n, o in other.items():
        pairs = pairs.withColumn(f"__score_{n}", similarity(F.col(f"__{n}"), F.col(f"__{o}"))).where(F.col(f"__score_{n}") >= least)
    scored = pairs.withColumn("score", reduce(add, (F.col(f"__score_{n}") for n in names)))
    best = first_wins(scored, ["block", *names], [F.desc("score"), "pos"])
    return best.drop(*(f"__{x}" for x in (*names, *other.values())), *(f"__score_{n}" for n in names))


def unmatched(targets: DataFrame, matches: DataFrame, names: tuple[str, ...] = ("name",)) -> DataFrame:
    """J-11: targets without a match."""
    return targets.join(matches.select("block", *names), ["block", *names], "left_anti")


def coverage(targets: DataFrame, matches: DataFrame, names: tuple[str, ...] = ("name",)) -> DataFrame:
    """A-08: number of targets, matched, unmatched, and per cent matched."""
    flagged = targets.join(matches.select("block", *names, F.lit(1).alias("hit")), ["block", *names], "left")
    sums = flagged.agg(F.count("*").alias("targets"), F.count("hit").alias("matched"))
    return sums.select("targets", "matched", (F.col("targets") - F.col("matched")).alias("unmatched"), F.round(100.0 * F.col("matched") / F.col("targets"), 2).alias("pct"))


def name_ratios(targets: DataFrame, listings: DataFrame, least: float = 0.85) -> DataFrame:
    """K-01 on pairs (block, name, listing) of different names: those whose ratio is ``least`` or
    more. White space and case don't count."""
    ours = targets.select("block", "name").distinct().withColumn("__name", plain(F.col("name")))
    theirs = listings.select("block", "listing").distinct().withColumn("__listing", plain(F.col("listing")))
    pairs = candidate_pairs(ours, theirs, least, {"__name": "__listing"})
    out = pairs.withColumn("ratio", sequence_ratio(F.col("__name"), F.col("__listing"))).where(F.col("ratio") >= least)
    return out.select("block", "name", "listing", "ratio")


def recover_scores(phantoms: DataFrame, listings: DataFrame) -> DataFrame:
    """J-10: a result for each phantom (id, league, season, source_url): the score that the
    last listing with its URL's fragment shows in its league and season, NULL where there is
    none or it isn't a number. A missing league or season is equal to a missing one; an empty
    fragment finds nothing."""
    known = listings.where(F.coalesce("hash", F.lit("")) != "")
    last = known.groupBy(F.col("league").alias("__l"), F.col("season").alias("__y"), F.col("hash").alias("__h")).agg(F.max_by(F.struct("home", "away"), "pos").alias("__s"))
    rows = phantoms.withColumn("__f", F.regexp_extract("source_url", "(?s)^[^#]*#(.*)$", 1))
    on = F.col("league").eqNullSafe(F.col("__l")) & F.col("season").eqNullSafe(F.col("__y")) & (F.col("__f") == F.col("__h"))
    rows = rows.join(last, on, "left")
    home, away = F.col("__s.home").try_cast("int"), F.col("__s.away").try_cast("int")
    both = home.isNotNull() & away.isNotNull()
    return rows.select("id", F.when(both, home).alias("score_home"), F.when(both, away).alias("score_away"))
