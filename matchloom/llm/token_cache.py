"""Token counts through a cache of digests.

The cache is a table (content_sha256, tokenizer_sha256, n_tokens) in the shared folder that
only grows. Rows whose digests it has are looked up; of the others each distinct content is
encoded once and its count appended. Distinct contents are found by digests alone; a text is
moved only if its count is missing and it is the one of its copies that is to be encoded.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bits import bit_filter, passes
from .store import new_path, written
from .trie_bpe import Codec, in_slices
from .workers import tidy

CACHE = "content_sha256 binary, tokenizer_sha256 string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Names the vocabulary: another file, even of the same name, has another digest."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def new_cache(spark: SparkSession) -> str:
    path = new_path(spark, "token_cache")
    spark.createDataFrame([], CACHE).write.parquet(path)
    return path


def _counts(texts: DataFrame, tokenizer: str) -> DataFrame:
    def made(c: Codec, rows: pa.RecordBatch) -> pa.RecordBatch:
        n = [len(x) // 4 for x in c.encode(rows.column(1).to_pylist())]
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(n, pa.int64())], names=["content_sha256", "n_tokens"])

    return texts.select("content_sha256", "body").mapInArrow(lambda batches: in_slices(batches, tokenizer, made), "content_sha256 binary, n_tokens long")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), body.alias("body"), F.unhex(F.sha2(body, 256)).alias("content_sha256"))


def _stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Two runs may have appended the same count."""
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer_sha256") == version)
    return rows.groupBy("content_sha256").agg(F.max("n_tokens").alias("n_tokens"))


def fill(docs: DataFrame, tokenizer: str, cache: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Appends the counts of the texts whose digests the cache doesn't have."""
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    # Of equal texts the row of the least id is encoded; which one it is, is told by 64 bits.
    place = F.xxhash64("content_sha256", "id")
    rows = _rows(docs, id_col, text_col).withColumn("place", place)
    first = rows.groupBy("content_sha256").agg(F.min("id").alias("id"))
    misses = written(first.join(_stored(spark, cache, version), "content_sha256", "left_anti").select("content_sha256", place.alias("place")), "misses")
    if misses.isEmpty():
        return
    bits = spark.sparkContext.broadcast(bit_filter(misses, "place"))

    def some(batches):
        for batch in batches:
            yield batch.filter(pa.array(passes(bits.value, batch.column(0).to_numpy())))

    wanted = rows.select("place", "content_sha256", "body").mapInArrow(tidy(some), "place long, content_sha256 binary, body string")
    # Copies of one id, or without any, have one place: one of them goes on, already map-side.
    wanted = wanted.dropDuplicates(["place", "content_sha256"]).join(misses.hint("shuffle_hash"), ["place", "content_sha256"], "left_semi")
    _counts(wanted, tokenizer).select("content_sha256", F.lit(version).alias("tokenizer_sha256"), "n_tokens").write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty: no bytes, no tokens. Repeated rows stay repeated; a null id
    stays null. Other columns are not read. ``cache`` is the folder of a cache made with
    ``new_cache``; without one a new one is started.
    """
    spark = docs.sparkSession
    cache = cache or new_cache(spark)
    fill(docs, tokenizer, cache, id_col, text_col)
    # Written apart from the join, so that Spark can split the rows of a very common text.
    found = written(_stored(spark, cache, tokenizer_digest(tokenizer)), "counts")
    sized = _rows(docs, id_col, text_col).select("id", F.octet_length("body").cast("long").alias("n_bytes"), "content_sha256")
    out = sized.join(found, "content_sha256")
    return out.select("id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
