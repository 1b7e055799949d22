"""The queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collocations import collocations
from .decontaminate import contained
from .filter_audit import audited
from .histogram_sort import sharded
from .log_templates import without_templates
from .near_dup import linked
from .oracles import ORACLES
from .pii_surrogates import replaced
from .quality_rules import judged
from .repeats import without_repeats
from .simhash import linked as simhash_linked
from .store import new_path, table
from .token_cache import fill, new_cache, token_counts
from .token_files import read_tokens, write_tokens
from .trie_bpe import round_trip


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), key="surrogate-key-1")
    return out.select("doc_id", "n_entities", "text")


def op2_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"), n=4).withColumnRenamed("id", "doc_id")


def op3_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = round_trip(table(spark, sf_dir, "documents"), tokenizer_file())
    return out.select(F.col("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token_files")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return read_tokens(spark, path).withColumnRenamed("id", "doc_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, cache = table(spark, sf_dir, "documents"), new_cache(spark)
    # A first run counts half of the contents, so that the run over all has both hits and misses.
    fill(docs.where(F.sha2(F.coalesce("text", F.lit("")), 256) < "8"), tokenizer_file(), cache)
    return token_counts(docs, tokenizer_file(), cache).withColumnRenamed("id", "doc_id")


def op6_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharded(table(spark, sf_dir, "documents"), shards=8)
    return out.select(F.col("id").alias("doc_id"), "size", F.crc32("body").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep_columns=["doc_id"])
    return out.select("doc_id", *(f"__quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")), F.col("__kept").alias("kept"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumnRenamed("id", "doc_id")


def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_templates(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "n_lines", "n_dropped", "text")


def op11_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_linked(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.col("fp").alias("fingerprint"), "component_id", "kept")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_pii_surrogates, op2_minhash_near_dup, op3_trie_bpe, op4_token_files, op5_token_counts, op6_histogram_shards, op7_quality_rules, op8_decontamination, op9_suffix_repeats, op10_line_templates, op11_simhash_near_dup, op12_filter_audit, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
