"""Line dedup by a log-template tree.

A line's path in the tree is its number of tokens and its first ``DEPTH`` tokens, variable
fields (tokens with a digit) masked. Within a leaf a token has a support, the number of the
leaf's different lines that have it at its place. A line generalises to templates: for each
support that one of its further tokens has, all further tokens of less support become
variable fields, as long as these are half of its further tokens without a digit at most (the
line itself is the first of its templates). A template that is found in ``min_docs`` different
texts or more, or in fewer if it has many words (``BARS``), recurs, and a line with such a
template is boilerplate: it is dropped, except in the document of the smallest id that has the
template, the most general one of those that recur.

So which lines are dropped depends on counts alone: not on an order of lines, nor on how many
a leaf has or how they are dealt. All counts are sums by token or template, added up map-side.
Only leaves of so many texts are looked into; others can't hold such a template.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bits import bit_filter, passes
from .columns import all_named, free, mapped, named, others, place
from .store import discard, written
from .workers import tidy

DEPTH = 3
MIN_DOCS = 20
#: A line of so many words without a digit is no accident in so many texts.
BARS = ((10, 3), (8, 6), (5, 10))
FIELD = b"<*>"

_digit = re.compile(rb"[0-9]").search


def _hash(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def masked(line: bytes) -> bytes:
    """The tokens, one space between them, those with a digit as ``<*>``."""
    tokens = line.split()
    return b" ".join([FIELD if _digit(t) else t for t in tokens] if _digit(line) else tokens)


def leaf_of(line: bytes) -> int:
    tokens = line.split(b" ", DEPTH)
    n = line.count(b" ") + 1
    return _hash(b"%d " % n + b" ".join(tokens[:DEPTH]))


def words_of(line: bytes) -> int:
    tokens = line.split(b" ")
    return len(tokens) - tokens.count(FIELD)


def bar_of(words: Column, min_docs: int) -> Column:
    """The number of texts from which a line of so many words is boilerplate."""
    out = F.lit(min_docs)
    for least, docs in reversed(BARS):
        out = F.when(words >= least, min(docs, min_docs)).otherwise(out)
    return out


def _lines(text: bytes | None) -> list[bytes]:
    """Masked lines, empty where a line has no token."""
    return [masked(x) for x in (text or b"").split(b"\n")]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(named(id_col).cast("long").alias("id"), named(text_col).cast("string").alias("body"))


def line_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, content, leaf, line) of the distinct masked lines of each row, as hashes, and words."""

    def run(batches):
        for batch in batches:
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                lines = {x for x in _lines(text) if x}
                content = _hash(text) if lines else 0
                rows += [(i, content, leaf_of(x), _hash(x), words_of(x)) for x in lines]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["id", "content", "leaf", "line", "words"])

    return _texts(docs, id_col, text_col).mapInArrow(tidy(run), "id long, content long, leaf long, line long, words long")


def leaf_lines(docs: DataFrame, id_col: str, text_col: str, leaves: DataFrame) -> DataFrame:
    """(leaf, line, words, masked) of the different lines of the given leaves."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(leaves, "leaf"))

    def run(batches):
        for batch in batches:
            seen = {x for text in batch.column(1).cast(pa.binary()).to_pylist() for x in _lines(text) if x}
            lines = sorted(seen)
            leaf = np.array([leaf_of(x) for x in lines], np.int64)
            keep = np.flatnonzero(passes(bits.value, leaf))
            lines = [lines[k] for k in keep]
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(leaf[keep]), pa.array([_hash(x) for x in lines], pa.int64()), pa.array([words_of(x) for x in lines], pa.int64()), pa.array(lines, pa.binary())], names=["leaf", "line", "words", "masked"])

    found = _texts(docs, id_col, text_col).mapInArrow(tidy(run), "leaf long, line long, words long, masked binary")
    return found.join(leaves.select("leaf"), "leaf", "left_semi").dropDuplicates(["leaf", "line"])


def generalised(lines: DataFrame) -> DataFrame:
    """(line, template, words): the templates of the different lines (leaf, line, words, masked),
    as hashes, and the words that are left in each."""
    further = F.filter(F.transform(F.slice(F.split("masked", " "), DEPTH + 1, 1 << 30), lambda t, k: F.when(t != FIELD.decode(), F.xxhash64(k, t))), lambda h: h.isNotNull())
    rows = lines.select("leaf", "line", "words", F.col("masked").cast("string").alias("masked")).withColumn("tokens", further)
    name = lambda hashes: F.xxhash64("leaf", F.aggregate(hashes, F.lit(0).cast("long"), lambda s, h: s.bitwiseXOR(h)))
    own = rows.select("line", name("tokens").alias("template"), "words")

    # A token's hash has its place in it. A line of one further token has no field to spare.
    spots = rows.where(F.size("tokens") > 1).select("leaf", "line", "words", F.explode("tokens").alias("token"))
    support = spots.groupBy("leaf", "token").agg(F.count("*").alias("support")).where("support > 1")
    held = spots.join(support.hint("merge"), ["leaf", "token"], "left").withColumn("support", F.coalesce("support", F.lit(1)))
    of_line = held.groupBy("line").agg(F.first("leaf").alias("leaf"), F.first("words").alias("words"), F.collect_list(F.struct("support", "token")).alias("tokens"))
    supports = F.array_distinct(F.transform("tokens", lambda t: t["support"]))

    def template(least: Column) -> Column:
        kept = F.filter("tokens", lambda t: t["support"] >= least)
        return F.struct(name(F.transform(kept, lambda t: t["token"])).alias("template"), (F.size("tokens") - F.size(kept)).alias("fields"))

    each = of_line.select("line", "words", F.size("tokens").alias("n"), F.inline(F.transform(supports, template)))
    return own.unionByName(each.where("fields > 0 and 2 * fields <= n").select("line", "template", (F.col("words") - F.col("fields")).alias("words")))


def templates(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(line, template, docs, first_id) of the masked lines whose template recurs."""
    texts = keys.groupBy("leaf", "content").agg(F.max("words").alias("words"))
    leaves = written(texts.groupBy("leaf").agg(F.count("*").alias("n"), F.max("words").alias("words")).where(F.col("n") >= bar_of(F.col("words"), min_docs)), "leaves")
    lines = written(leaf_lines(docs, id_col, text_col, leaves), "leaf_lines")
    masks = written(generalised(lines), "tree")
    # At most so many texts as its lines have together: templates below the bar go first.
    of_line = keys.select("line", "content").distinct().groupBy("line").agg(F.count("*").alias("docs"))
    likely = masks.join(of_line, "line").groupBy("template").agg(F.sum("docs").alias("docs"), F.max("words").alias("words")).where(F.col("docs") >= bar_of(F.col("words"), min_docs))
    likely = written(masks.join(likely.select("template"), "template", "left_semi"), "likely")
    found = keys.select("id", "content", "line").join(likely, "line")
    spread = found.select("template", "content", "words").distinct().groupBy("template").agg(F.count("*").alias("docs"), F.max("words").alias("words"))
    spread = spread.where(F.col("docs") >= bar_of(F.col("words"), min_docs))
    first = found.groupBy("template").agg(F.min("id").alias("first_id"))
    recurring = spread.join(first, "template")
    most_general = F.min_by(F.struct("template", "docs", "first_id"), F.struct(recurring["words"], "template")).alias("t")
    out = likely.select("line", "template").join(recurring, "template").groupBy("line").agg(most_general).select("line", "t.*")
    out = written(out, "templates")
    discard(leaves, lines, masks, likely)
    return out


def without_templates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs``, all columns, the lines of recurring templates taken out of the text.

    ``counts`` names two more columns: lines with a word, and those dropped; columns of
    ``docs`` of these names are replaced by them, any other name may occur. A null or empty
    text stays as it is. Rows without an id count for recurrence but lose nothing, and
    repeated rows of one id are treated alike. Equal texts count once towards min_docs.
    """
    keys = written(line_keys(docs, id_col, text_col), "line_keys")
    found = templates(docs, keys, id_col, text_col, min_docs)
    key, drop_col = free(docs, "__id"), free(docs, "__drop")
    drops = keys.join(found, "line").where("id <> first_id").groupBy(F.col("id").alias(key)).agg(F.collect_set("line").alias(drop_col))
    drops = written(drops, "drops")
    discard(keys, found)
    names = counts or (free(docs, "__lines"), free(docs, "__dropped"))
    columns = others(docs.columns, *names)
    # One plan at every size: the drops grow with the texts.
    rows = docs.join(drops.hint("merge"), named(id_col).cast("long") == F.col(key), "left").select(*all_named(columns), drop_col)
    at = place(columns, text_col)

    def run(batches):
        for batch in batches:
            texts, n, gone = batch.column(at).cast(pa.string()).cast(pa.binary()).to_pylist(), [], []
            for k, drop in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                lines = (texts[k] or b"").split(b"\n")
                drop = set(drop or ())
                stay = [x for x in lines if not (m := masked(x)) or _hash(m) not in drop] if drop else lines
                n.append(sum(bool(x.strip()) for x in lines))
                gone.append(len(lines) - len(stay))
                if gone[-1]:
                    texts[k] = b"\n".join(stay)
            out = list(batch.columns[:-1])
            out[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*out, pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=[*batch.schema.names[:-1], *names])

    fields = rows.drop(drop_col).withColumn(columns[at], named(text_col).cast("string")).withColumns({c: F.lit(0).cast("long") for c in names}).schema
    out = mapped(rows, tidy(run), fields)
    return out if counts else out.drop(*names)


def keep_filled(docs: DataFrame, **options) -> DataFrame:
    """As ``without_templates``, without the rows whose every line was dropped."""
    lines, dropped = free(docs, "__lines"), free(docs, "__dropped")
    out = without_templates(docs, counts=(lines, dropped), **options)
    return out.where((F.col(dropped) == 0) | (F.col(lines) > F.col(dropped))).select(*all_named(docs.columns))
