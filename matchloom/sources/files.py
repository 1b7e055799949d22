"""Reading shard outputs, CSV and JSON, and writing reports and the star schema."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import together


def with_shard_rank(df: DataFrame, path: Column, is_seed: Column) -> DataFrame:
    """S-01: shard_rank from 0: shards in the order of their paths, seeds after them. The
    rank is made on the list of paths, which is as short as the list of files."""
    rows = df.withColumns({"__path": path, "__seed": is_seed})
    from pyspark.sql import Window

    ranks = rows.select("__path", "__seed").distinct().withColumn("shard_rank", F.row_number().over(Window.orderBy("__seed", "__path")) - 1)
    return rows.join(F.broadcast(ranks), ["__path", "__seed"]).drop("__path", "__seed")


def read_shards(spark: SparkSession, folder: str, pattern: str = r"/shard-[^/]*$") -> DataFrame:
    """S-01: all Parquet files of a folder with their shard_rank, columns merged; files whose
    name doesn't fit the pattern are seeds."""
    df = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(folder)
    path = F.regexp_replace(F.col("_metadata.file_path"), r"/part-[^/]*$", "")
    rows = df.select("*", path.alias("__file"))
    return with_shard_rank(rows, F.col("__file"), ~F.col("__file").rlike(pattern)).drop("__file")


def union_drift(frames: list[DataFrame], defaults: dict | None = None) -> DataFrame:
    """S-02: all rows; columns that a frame lacks are NULL, or the default given for them."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def read_tolerant_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """S-03: (good rows, report) of CSV with a header: rows that don't fit the schema are
    counted, not read; unreadable files are passed over. n_values counts what could be read."""
    wide = T.StructType([*schema.fields, T.StructField("__corrupt", T.StringType())])
    rows = spark.read.schema(wide).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__corrupt").option("ignoreCorruptFiles", True).csv(path)
    values = sum((F.col(c).isNotNull().cast("long") for c in schema.names), F.lit(0).cast("long"))
    report = rows.groupBy(F.col("__corrupt").isNull().alias("good")).agg(F.count("*").alias("n"), F.sum(values).alias("n_values"))
    return rows.where("__corrupt is null").drop("__corrupt"), report


def usable_files(spark: SparkSession, folder: str, columns: list[str], pattern: str = "*.csv") -> DataFrame:
    """S-03: (file, reason) of each file of a folder: reason is NULL if it can be used, else
    ``empty`` (nothing but white space), ``corrupt`` (bytes that are no text, anywhere in it) or
    ``schema`` (its header lacks a column).

    Files are read whole, line by line and in splits, by many tasks a file: what is known of a
    file is folded from its splits, so it may be of any size; a line has to fit into a task. A
    line break is never part of a character, so no character is cut. Files of no bytes at all
    are passed over by Spark itself."""
    lines = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").text(folder)
    text, nul = F.col("value"), F.lit("\0")
    place = F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))
    rows = lines.select(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file"), place.alias("place"), text, F.is_valid_utf8(text).alias("valid"))
    rows = rows.withColumn("filled", F.when(F.col("valid"), F.trim(F.regexp_replace(text, r"\s+", "")) != "").otherwise(True))
    said = rows.groupBy("file").agg(
        F.bool_and(F.col("valid") & ~F.contains(F.when(F.col("valid"), text).otherwise(nul), nul)).alias("valid"),
        F.bool_or("filled").alias("filled"), F.min_by(F.when(F.col("valid"), text), "place").alias("header"),
    )
    header = F.trim(F.regexp_replace("header", "[\ufeff\r]", ""))
    lacks = F.size(F.array_except(F.lit(columns), F.transform(F.split(header, ","), lambda c: F.trim(F.trim(c), F.lit('"'))))) > 0
    reason = F.when(~F.col("valid"), "corrupt").when(~F.col("filled"), "empty").when(lacks, "schema")
    return said.select("file", reason.alias("reason"))


def read_usable_csv(spark: SparkSession, folder: str, schema: T.StructType, written: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S-03: (good rows, report of rows, report of skipped files) of a folder of CSV files.
    ``written`` says of ``file`` what is counted as one, a table's folder where many tasks write it."""
    files = usable_files(spark, folder, schema.names)
    good = [r["file"] for r in files.where("reason is null").select("file").collect()]  # a list of files, as a scan needs it
    skipped = files.where("reason is not null").groupBy("reason").agg((F.count("*") if written is None else F.count_distinct(written)).alias("n"))
    rows, report = read_tolerant_csv(spark, good, schema) if good else (spark.createDataFrame([], schema), spark.createDataFrame([], "good boolean, n long, n_values long"))
    return rows, report, skipped


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S-04."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """S-04."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_league_cache(spark: SparkSession, path: str, as_of_epoch: float, ttl_s: float) -> DataFrame:
    """S-05: the leagues of a JSON file {timestamp, leagues}, none if it is older than ttl_s."""
    doc = spark.read.schema("timestamp double, leagues array<string>").option("multiLine", True).json(path)
    return doc.where(F.lit(as_of_epoch) - F.col("timestamp") <= ttl_s).select(F.explode("leagues").alias("league"))


def write_league_cache(leagues: DataFrame, path: str, epoch: float) -> bool:
    """S-05: replaces the cache unless there is nothing to write; says whether it did."""
    if leagues.isEmpty():
        return False
    leagues.agg(F.lit(epoch).alias("timestamp"), F.sort_array(F.collect_set("league")).alias("leagues")).coalesce(1).write.mode("overwrite").json(path)
    return True


def write_report(df: DataFrame, path: str) -> None:
    """S-06: aggregate rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_star(tables: dict[str, DataFrame], path: str, partition: str | None = "season") -> None:
    """S-09: each table as Parquet, events partitioned by a column. Of events only the partitions
    that there are rows for are replaced. The tables are written side by side."""

    def write(name: str, df: DataFrame) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        (writer.partitionBy(partition) if partition and name == "events" else writer).parquet(f"{path}/{name}")

    if tables:
        together(next(iter(tables.values())).sparkSession, [partial(write, name, df) for name, df in tables.items()])


def read_star(spark: SparkSession, names: list[str], path: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


def events_and_odds(events: DataFrame, odds: DataFrame) -> DataFrame:
    """S-10: every event with its number of odds rows, 0 included."""
    n = odds.groupBy(F.col("event_id").alias("id")).agg(F.count("*").alias("n_odds"))
    return events.select("id").join(n, "id", "left").withColumn("n_odds", F.coalesce("n_odds", F.lit(0)))
