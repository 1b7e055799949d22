"""Audit of how filters interact: what each removes, in every order they may be applied in.

Each row's failures are bits. Filters of one text alone are column expressions; whether a text
is a copy is a left-semi self-join: on its hash, its exact text, and an id smaller than the
row's. Of each text only the least id is on the smaller side, worked out map-side first, so a
text that a third of all rows have meets one row. Ids that the join leaves are put together
with the other failures, and only counts of combinations of bits (32 for a part) go on: every
order and step is summed from them.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import free
from .store import written

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10  # words; per cent of words; per cent of characters
SYMBOLS = "[#$%&*|]"
_SPACE = r"[\x20\x09-\x0D]+"
COPY = 1 << FILTERS.index("E")


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")

    def bits(x: Column) -> Column:
        n, distinct = F.size(x["words"]), F.size(F.array_distinct(x["words"]))
        capitals = F.char_length(x["text"]) - F.char_length(F.regexp_replace(x["text"], "[A-Z]+", ""))
        failed = [n < MIN_WORDS, 100 * distinct < MIN_DISTINCT * n, 100 * capitals > MAX_CAPITALS * F.char_length(x["text"]), x["text"].rlike(SYMBOLS)]
        out = F.lit(0)
        for k, f in enumerate(failed):
            out = out.bitwiseOR(F.when(f, 1 << k).otherwise(0))
        return out

    # Through an array, so that the words are cut out once.
    return F.transform(F.array(F.struct(words.alias("words"), text.alias("text"))), bits)[0]


def copies(rows: DataFrame) -> DataFrame:
    """The rows (id, hash, text, ...) whose text a row with a smaller id has, without the text."""
    # Written, so that the join below has rows of hot texts alone on its larger side, which can be split.
    firsts = rows.where("id is not null").groupBy("hash", "text").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    firsts = written(firsts.drop("last"), "firsts")
    d, s = rows.where("id is not null").alias("d"), firsts.alias("s")
    on = (F.col("d.hash") == F.col("s.hash")) & (F.col("d.text") == F.col("s.text")) & (F.col("s.first") < F.col("d.id"))
    # One plan at every size: both sides grow with the texts.
    return d.join(s.hint("merge"), on, "left_semi").select(*(f"d.{c}" for c in rows.columns if c != "text"))


def combinations(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", good_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """(part, failed, n, n_good, n_toxic): rows of a part by the bits of the filters they fail."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text")).withColumn("hash", F.xxhash64("text"))
    alone = rows.select("id", "hash", "part", failures(F.col("text")).alias("failed"), F.lit(1).cast("long").alias("n"))
    twice = copies(rows).select("id", "hash", "part", F.lit(COPY).alias("failed"), F.lit(0).cast("long").alias("n"))
    by_id = alone.unionByName(twice).groupBy("id", "hash", "part").agg(F.bit_or("failed").alias("failed"), F.sum("n").alias("n"))
    has = lambda c: F.coalesce(F.max((F.col(f"`{c}`") == 1).cast("int")), F.lit(0))
    known = labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").cast("long").alias("id")).agg(has(good_col).alias("good"), has(toxic_col).alias("toxic"))
    of = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0))).cast("long").alias(f"n_{c}")
    return by_id.join(known, "id", "left").groupBy("part", "failed").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


def _steps() -> Column:
    """Every step of every order: the order, the step, its filter's bit, and those before it."""
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    every = [("".join(p), k + 1, bit[p[k]], sum(bit[f] for f in p[:k])) for p in permutations(FILTERS) for k in range(len(p))]
    return F.from_json(F.lit("[" + ",".join(f'{{"filter_order":"{o}","step":{s},"own":{b},"before":{e}}}' for o, s, b, e in every) + "]"), "array<struct<filter_order string, step int, own int, before int>>")


def audited(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley.

    A null text counts as empty, a null part as the empty one. Rows without an id are judged by
    their text alone (they are no copies, and no label is theirs). Rows of one id are rows of
    their own, and not each other's copies; a document is good or toxic if any of its labels
    says so. An empty table has no part and no row. Further columns aren't read.
    """
    counts = combinations(docs, labels, **columns)
    own, before = F.col("own"), F.col("before")
    fails, earlier = F.col("failed").bitwiseAND(own) != 0, F.col("failed").bitwiseAND(before) != 0
    total = lambda c, cond: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).cast("long")
    steps = counts.select("*", F.inline(_steps())).groupBy("part", "filter_order", "step", "own").agg(
        total("n", ~fails & ~earlier).alias("kept"), total("n", fails & ~earlier).alias("removed"), total("n", fails & earlier).alias("redundant"),
        total("n", F.col("failed") == own).alias("unique_fails"), total("n_good", fails & ~earlier).alias("good_lost"), total("n_toxic", fails & ~earlier).alias("toxic_lost"),
    )
    name = free(steps, "own_sum")
    shares = steps.groupBy("part", "own").agg(F.sum("removed").alias(name))
    return steps.join(shares, ["part", "own"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", F.col(name).alias("shapley"))
