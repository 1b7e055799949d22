"""Streaming twins of the batch operators; all run to the end of what is there."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import upsert_events
from ..session import folder


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    path = f"{sf_dir}/events.parquet*"  # a pattern: a stream source takes a single file by no other way
    return spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def run_to_end(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """The stream's output, written as Parquet with exactly-once files, and read again."""
    spark = stream.sparkSession
    out, state = folder(spark, name), folder(spark, f"{name}-state")
    stream.writeStream.format("parquet").outputMode(mode).option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def ingest_once(stream: DataFrame, key: list[str], at: str = "ts", delay: str = "60 days") -> DataFrame:
    """T-01: each key once within the delay, however often it arrives."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(key)


def rate_by_window(stream: DataFrame, ok, at: str = "ts", size: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """T-03: rows and successes per closed window."""
    rows = stream.withWatermark(at, delay).groupBy(F.window(at, size)).agg(F.count("*").alias("n"), F.count_if(ok).alias("ok"))
    return rows.select(F.col("window.start").alias("start"), "n", "ok")


def _latest(spark: SparkSession, path: str, before: int, value: str, schema: str = "number int") -> DataFrame | None:
    """What the batches before a number have said under a path, if any of them ran."""
    try:
        rows = spark.read.schema(schema).parquet(f"{path}/*")
    except AnalysisException:  # no batch has been written
        return None
    return rows.where(F.col("number") < before).agg(F.max(value).alias(value))


def fresh_rows(stream: DataFrame, at: str = "ts", ttl: str = "7 days") -> DataFrame:
    """T-04: the rows of a stream that weren't late when they came. A row is late if its own
    time, not that of a window it falls into, lies further back than the time to live from
    the latest time that the batches before had. Rows of the batch that moves the time on are
    in time, as are rows without a time before any time is known; later ones without are late.

    A batch writes its rows and its latest time under its own number, so one that is run again
    decides and writes the same again."""
    spark, schema = stream.sparkSession, stream.schema
    base, state = folder(spark, "fresh"), folder(spark, "fresh-state")

    def keep(batch: DataFrame, number: int) -> None:
        known = _latest(spark, f"{base}/mark", number, "top", "number int, top timestamp")
        top = known.first()["top"] if known is not None else None  # one value
        rows = batch if top is None else batch.where(F.col(at) >= F.lit(top) - F.expr(f"interval {ttl}"))
        rows.write.mode("overwrite").parquet(f"{base}/rows/{number}")
        batch.agg(F.max(at).alias("top")).select(F.lit(number).alias("number"), F.col("top").cast("timestamp").alias("top")).write.mode("overwrite").parquet(f"{base}/mark/{number}")

    stream.writeStream.foreachBatch(keep).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    known = _latest(spark, f"{base}/mark", 1 << 62, "number")
    return spark.createDataFrame([], schema) if known is None else spark.read.schema(schema).parquet(f"{base}/rows/*")


def in_batches(df: DataFrame, files: int, order: list[str]) -> DataFrame:
    """A stream of the rows, read file by file, in so many files by ranges of ``order``."""
    spark, path = df.sparkSession, folder(df.sparkSession, "files")
    df.repartitionByRange(files, *order).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def arriving(df: DataFrame, batch: Column, batches: int) -> DataFrame:
    """A stream that brings the rows in the order of their batch's number, from 0, a batch at a
    time. Files are read by age, so the batches are written one after the other."""
    spark, path = df.sparkSession, folder(df.sparkSession, "arriving")
    rows = df.withColumn("__batch", batch)
    for k in range(batches):
        rows.where(F.col("__batch") == k).drop("__batch").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


FAN = 8  # runs of one level that are merged into one of the next


def runs_after(batches: int) -> list[tuple[int, int]]:
    """(level, first batch) of the runs that hold what so many batches have brought: the
    batches' number in digits of base FAN."""
    out, at, level = [], 0, 0
    while FAN ** (level + 1) <= batches:
        level += 1
    for k in range(level, -1, -1):
        while at + FAN**k <= batches:
            out.append((k, at))
            at += FAN**k
    return out


def upsert_stream(stream: DataFrame, key: str = "id", seq: str = "seq", base: str | None = None) -> DataFrame:
    """T-02: the table that M-04 gives, kept up by micro-batches.

    The table is a log of changes: a batch writes its own rows, thinned to those that can
    matter, as a run of level 0, and every ``FAN`` runs of a level are merged into one of the
    next. So what a batch writes is in proportion to the batch, and a row is written again
    once a level at most, whatever the table has grown to. Reading merges the runs that there
    are, a few for each level.

    A run is written under the number of its batch, and which runs count follows from the
    number of the last batch alone: a batch that is run again after a failure writes the same
    again, and a stream taken up again under the same ``base`` finds what is there. Runs that
    were merged are no longer read. A stream without rows gives an empty table."""
    spark, schema = stream.sparkSession, stream.schema
    base, state = base or folder(spark, "upsert"), folder(spark, "upsert-state") if base is None else f"{base}/state"
    at = lambda level, first: f"{base}/level={level}/{first}"

    def thinned(rows: DataFrame) -> DataFrame:
        # Rows of one event fold again to the same event, so all that a table needs to keep
        # of each is its first row, its first scored row and its first row with a season.
        firsts = [F.min_by(F.struct(*schema.names), F.when(ok, F.col(seq))) for ok in (F.lit(True), F.col("score_home").isNotNull(), F.col("season") != "")]
        kept = rows.groupBy(F.col(key).alias("__key")).agg(F.array_distinct(F.array_compact(F.array(*firsts))).alias("__r"))
        return kept.select(F.explode("__r").alias("r")).select("r.*")

    def read(runs: list[tuple[int, int]]) -> DataFrame:
        return spark.read.schema(schema).parquet(*(at(*r) for r in runs))

    def merge(batch: DataFrame, number: int) -> None:
        thinned(batch).write.mode("overwrite").parquet(at(0, number))
        level, done = 1, number + 1
        while done % FAN**level == 0:
            first = done - FAN**level
            thinned(read([(level - 1, first + k * FAN ** (level - 1)) for k in range(FAN)])).write.mode("overwrite").parquet(at(level, first))
            level += 1
        spark.range(1, numPartitions=1).select(F.lit(number).alias("number")).write.mode("overwrite").parquet(f"{base}/done/{number}")

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    last = _latest(spark, f"{base}/done", 1 << 62, "number")
    rows = spark.createDataFrame([], schema) if last is None else read(runs_after(last.first()["number"] + 1))
    return upsert_events(rows, key, seq)
