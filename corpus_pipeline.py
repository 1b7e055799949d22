"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; all
but the last return the columns of ``documents``. Any column may hold nulls and columns of any
further name are carried along; an empty table gives an empty table. What a stage does with a
null text, a null id, ties and repeated rows is said below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm.decontaminate import clean
from matchloom.llm.log_templates import keep_filled
from matchloom.llm.near_dup import keep_one
from matchloom.llm.quality_rules import keep_good
from matchloom.llm.queries import tokenizer_file
from matchloom.llm.store import new_path, scratch, table, written
from matchloom.llm.trie_bpe import round_trip


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. Null and empty texts are rejected (they have too few
    words); a null language is a stratum of its own; a row with a null id has no label and is
    judged like any other, as are repeated rows."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates; n_chars follows the text. Of the
    documents that share a template the one of the least id keeps the line, repeated rows of
    that id all do, and rows with a null id always do. A document whose every line is dropped
    leaves; one that had no line stays, a null text too (its n_chars is null)."""
    return keep_filled(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least id: five-word
    shingles, similarity 0.8. Null and wordless texts are like nothing and stay, as do rows
    with a null id and repeated rows of the id that stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and wordless texts hold none; of repeated
    rows of an id all leave if one of them holds an item; rows with a null id stay."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's token ids, and the digest of the decoded text, a
    row for each row. A null text counts as empty; a null id stays null."""
    out = round_trip(docs, tokenizer_file())
    return out.select(F.col("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Binomial bounds, templates and BPE can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written before the next; what a stage writes on
    its way is deleted at its end. The result is read from the last stages' tables: a caller who
    writes it within ``scratch`` of ``matchloom.llm.store`` has those deleted at the block's end."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        with scratch(spark):
            docs = written(stage(spark, docs, sf_dir), name, path)
    return STAGES[-1][1](spark, docs, sf_dir)
