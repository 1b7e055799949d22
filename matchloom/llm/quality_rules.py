"""Quality rules whose thresholds limit false rejection.

Labelled documents are the holdout. For each stratum and each score, cutoffs are tested from
the most lenient to the strictest: the hypothesis that a cutoff rejects more than ``ALPHA``
over the number of scores of the stratum's good documents is tested by the exact binomial
tail, and the sequence stops where it can't be refused. Within a sequence that order keeps
the error in check; over strata and scores the level is divided by their number. So with
probability 1 - ``DELTA`` the rules together reject at most ``ALPHA`` of the good documents
in every stratum. Of the cutoffs that pass, the one with the most gain is taken: bad
documents caught, less ``COST`` times the good ones lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bits import bit_filter, passes
from .columns import all_named, free, mapped, named, others, place
from .store import discard, written
from .words import shingle_hashes, word_hashes
from .workers import tidy

ALPHA, DELTA, COST = 0.05, 0.05, 10
SCORES = ("symbols", "repeats", "dup_lines", "upper", "length")
STEPS, EVEN = 50, 2000  # steps of 1 / STEPS up to EVEN / STEPS, beyond that of 1 in EVEN / 2 parts of each doubling
BROADCAST_STRATA = 10_000

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper")
_SPACES, _SYMBOLS, _UPPER = b" \t\n\x0b\x0c\r", b"#*$%&|<>", bytes(range(65, 91))


def steps_of(score: np.ndarray) -> np.ndarray:
    """The number of a score's step. Steps are even for scores that occur, and grow with the
    score beyond, so that any score has one and there are some thousands at most."""
    x = np.floor(score * STEPS).astype(np.int64)
    doubled = np.maximum(np.frexp(x // EVEN)[1] - 1, 0)
    return np.where(x <= EVEN, x, EVEN + doubled * (EVEN // 2) + ((x >> doubled) - EVEN) // 2).astype(np.int32)


def counts_of(texts: list[bytes | None]) -> np.ndarray:
    """A row of ``_COUNTS`` for each text; a null text has none of anything."""
    out = np.zeros((len(texts), len(_COUNTS)), np.int64)
    raw = [t or b"" for t in texts]
    for k, words in word_hashes(raw):
        t, n = raw[k], len(words)
        points = len(t) - int(np.count_nonzero((np.frombuffer(t, np.uint8) & 0xC0) == 0x80))
        lines = [x for x in t.split(b"\n") if x.strip()]
        found = np.zeros(n, bool)
        if n >= 3:
            _, which, times = np.unique(shingle_hashes(words, 3), return_inverse=True, return_counts=True)
            again = times[which] > 1
            for shift in range(3):
                found[shift : n - 2 + shift] |= again
        gone = lambda chars, t=t: len(t) - len(t.translate(None, chars))
        out[k] = n, points - gone(_SPACES), gone(_SYMBOLS), len(lines) - len(set(lines)), found.sum(), gone(_UPPER)
    return out


def measured(docs: DataFrame, text_col: str = "text", name: str = "__quality", pick=None) -> DataFrame:
    """``docs`` with a struct of counts, base_failed and the scores in steps; of the rows of
    each batch only those that ``pick`` leaves, if that is given."""
    fields = [*((c, pa.int64()) for c in _COUNTS), ("base_failed", pa.bool_()), *((s, pa.int32()) for s in SCORES)]
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StructType([T.StructField(c, {"bool": T.BooleanType(), "int32": T.IntegerType()}.get(str(t), T.LongType())) for c, t in fields]))])
    at = place(docs.columns, text_col)

    def run(batches):
        for batch in batches:
            batch = pick(batch) if pick else batch
            c = counts_of(batch.column(at).cast(pa.string()).cast(pa.binary()).to_pylist())
            words, chars, symbols, lines, repeats, upper = c.T
            some = np.maximum(words, 1)
            failed = (words < 50) | (100 * repeats > 50 * words)
            scores = [symbols / some, repeats / some, lines / some, upper / np.maximum(chars, 1), chars / some]
            steps = [steps_of(s) for s in scores]
            made = pa.StructArray.from_arrays([*map(pa.array, c.T), pa.array(failed), *map(pa.array, steps)], names=[f for f, _ in fields])
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, name])

    return mapped(docs, tidy(run), schema)


def tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p)."""
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    return min(1.0, math.fsum(math.exp(log(i)) for i in range(k + 1)))


def most_false(n: int, p: float, level: float) -> int:
    """The largest k for which k false rejections of n still refuse the rate p; -1 for none."""
    k = -1
    while k + 1 < n and tail(k + 1, n, p) <= level:
        k += 1
    return k


def cutoffs(holdout: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, cuts map score -> step) from (stratum, good boolean, scores in steps).

    A score above its cut is a rejection. A score without a cut in a stratum rejects
    nothing there: with few good documents nothing can be guaranteed.
    """
    strata = max(1, holdout.select("stratum").distinct().count())
    p, level = alpha / len(SCORES), delta / (strata * len(SCORES))
    long = holdout.select("stratum", "good", F.explode(F.create_map(*[x for s in SCORES for x in (F.lit(s), F.col(s))])).alias("score", "step"))
    bins = long.groupBy("stratum", "score", "step").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))

    def choose(group: pa.Table) -> pa.Table:
        """A group has a row for each step at most."""
        group = group.sort_by([("step", "descending")])
        step, good, bad = (group.column(c).to_numpy() for c in ("step", "good", "bad"))
        good, bad = good.cumsum(), bad.cumsum()
        most = most_false(int(good[-1]), p, level) if good[-1] else -1
        gain = np.where(good <= most, bad - COST * good, 0)
        best = int(gain.argmax())  # the first, so the most lenient of equals
        # All steps down to this one are rejected; the gap below it is split in the middle.
        under = int(step[best + 1]) if best + 1 < len(step) else -1
        cut = (int(step[best]) + under) // 2 if under >= 0 else int(step[best]) - 1
        found = group.slice(0, int(gain[best] > 0))
        return pa.table({"stratum": found.column("stratum"), "score": found.column("score"), "cut": pa.array([cut] * found.num_rows, pa.int32())})

    found = bins.groupBy("stratum", "score").applyInArrow(choose, "stratum string, score string, cut int")
    return found.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("score", "cut"))).alias("cuts"))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", keep_columns: list[str] | None = None, quality_col: str = "__quality", kept_col: str = "__kept") -> DataFrame:
    """``docs`` (or its ``keep_columns``) with the struct ``quality_col`` and boolean ``kept_col``.

    labels has doc_id and quality (1 good, 0 bad, null ignored); a document with several
    labels is good only if all are, and of several texts of one id the one with the least
    scores is the holdout's. A null stratum is a stratum of its own, null and empty texts fail
    the base rule, rows with a null id carry no label; repeated rows are judged alike. Without
    labels the base rule is the whole verdict; an empty table gives no rows. Columns of
    ``docs`` named like the two new ones are replaced by them, any other name may occur.
    """
    stratum = F.coalesce(F.concat(F.lit("="), F.col(stratum_col).cast("string")), F.lit("")).alias("stratum")
    known = written(labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg((F.min("quality") == 1).alias("good")).where("id is not null"), "known")
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(known, "id"))

    def labelled(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(passes(bits.value, batch.column(0).to_numpy())))

    # Texts without a label aren't counted here, but for the few that the filter lets through.
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), stratum, F.col(text_col).cast("string").alias("body")).where("id is not null")
    scores = measured(narrow, "body", pick=labelled).select("id", "stratum", "__quality.base_failed", *(f"__quality.{s}" for s in SCORES))
    # Documents that the base rule rejects anyway say nothing about the cutoffs.
    firsts = scores.where("not base_failed").groupBy("id").agg(F.min(F.struct("stratum", *SCORES)).alias("first")).select("id", "first.*")
    holdout = written(firsts.join(known, "id").drop("id"), "holdout")
    cuts = written(cutoffs(holdout), "cutoffs")
    discard(known, holdout)
    if cuts.count() <= BROADCAST_STRATA:
        cuts = F.broadcast(cuts)
    columns = others(keep_columns or docs.columns, quality_col, kept_col)
    body, group = free([*columns, quality_col, kept_col], "__body"), free([*columns, quality_col, kept_col], "__stratum")
    found = free([*columns, quality_col, kept_col, body, group], "__cuts")
    rows = measured(docs.select(*all_named(columns), named(text_col).cast("string").alias(body), stratum.alias(group)), body, quality_col)
    rows = rows.join(cuts.withColumnsRenamed({"stratum": group, "cuts": found}), group, "left")
    kept = ~F.col(f"`{quality_col}`.base_failed")
    for s in SCORES:
        kept = kept & ~F.coalesce(F.col(f"`{quality_col}`.{s}") > F.element_at(F.col(found), F.lit(s)), F.lit(False))
    return rows.select(*all_named(columns), F.col(quality_col), kept.alias(kept_col))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns."""
    kept = free(docs, "__kept")
    return judged(docs, labels, **options, quality_col=free(docs, "__quality"), kept_col=kept).where(F.col(kept)).select(*all_named(docs.columns))
