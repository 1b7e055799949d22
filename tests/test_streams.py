"""Streams over several batches: late rows, and what an upsert writes."""

import datetime
import random
from pathlib import Path

from pyspark.sql import functions as F

from matchloom.operators.merge import upsert_events
from matchloom.streaming import jobs

DAY = datetime.timedelta(days=1)
START = datetime.datetime(2026, 1, 1, 12)


def arriving(spark, rows, schema="batch int, key string, day int"):
    df = spark.createDataFrame(rows, schema).withColumn("ts", F.lit(START) + F.make_dt_interval("day"))
    return jobs.arriving(df, F.col("batch"), 1 + max(r[0] for r in rows))


def test_a_row_is_late_by_its_own_time(spark):
    rows = [(0, "a", 0), (0, "b", -30), (1, "in time", -7), (1, "late", -8), (1, "moves on", 20), (2, "late now", 12), (2, "in time now", 13), (3, "late", -7), (3, "new", 40), (3, "old in its own batch", 13)]
    got = jobs.fresh_rows(arriving(spark, rows)).collect()
    assert sorted((r["batch"], r["key"]) for r in got) == sorted((b, k) for b, k, _ in rows if "late" not in k)
    nothing = spark.createDataFrame([], "batch int, key string, ts timestamp")
    assert jobs.fresh_rows(jobs.arriving(nothing, F.col("batch"), 2)).count() == 0


def test_windows_drop_what_comes_too_late(spark):
    # A batch's windows are closed by the times of the batches before it.
    rows = [(0, "x", 0), (1, "x", 3), (2, "x", 6), (3, "x", 9), (4, "late", 0), (4, "in time", 9), (5, "x", 30)]
    got = jobs.run_to_end(jobs.rate_by_window(arriving(spark, rows), F.col("key") == "x"), "rate").collect()
    days = {(r["start"] - START.replace(hour=0)) // DAY: (r["n"], r["ok"]) for r in got}
    assert days[0] == (1, 1) and days[9] == (2, 1) and 30 not in days


def test_a_key_is_taken_once_across_batches_and_again_after_the_delay(spark):
    rows = [(0, "a", 0), (1, "a", 3), (2, "b", 4), (2, "a", 5), (3, "b", 40), (4, "c", 80), (5, "a", 81)]
    got = jobs.run_to_end(jobs.ingest_once(arriving(spark, rows), ["key"], delay="10 days"), "once").collect()
    # At b's second time the batches before had only come to day 5, so its first was still known.
    assert sorted((r["key"], r["day"]) for r in got) == [("a", 0), ("a", 81), ("b", 4), ("c", 80)]


EVENT = "batch int, id long, seq int, home string, season string, score_home int, score_away int, sets_detail string, status string"


def test_upserts_write_in_proportion_to_the_batch(spark, tmp_path):
    rng = random.Random(5)
    maybe = lambda v: v if rng.random() < 0.4 else None
    rows = [(b, rng.randrange(400) if b else k, 100 * k + b, f"h{b}", maybe(str(b)), maybe(b), maybe(k % 5), maybe("6-4"), "scheduled") for b in range(10) for k in range(2000 if b == 0 else 20)]
    df = spark.createDataFrame(rows, EVENT)
    base = str(tmp_path / "table")
    stream = jobs.arriving(df, F.col("batch"), 10).drop("batch")
    got = sorted(map(tuple, jobs.upsert_stream(stream, base=base).collect()), key=str)
    assert got == sorted(map(tuple, upsert_events(df.drop("batch")).collect()), key=str)
    written = {p.name: spark.read.parquet(str(p)).count() for p in Path(base, "level=0").iterdir()}
    assert set(written) == {str(k) for k in range(10)} and all(n <= 20 for name, n in written.items() if name != "0")
    assert sorted(p.name for p in Path(base, "level=1").iterdir()) == ["0"]
    assert jobs.runs_after(10) == [(1, 0), (0, 8), (0, 9)] and jobs.runs_after(0) == [] and jobs.runs_after(64) == [(2, 0)]


def test_a_stream_taken_up_again_goes_on(spark, tmp_path):
    rows = [(b, b % 3, b, f"h{b}", str(b), b if b > 4 else None, 1, "", "finished") for b in range(12)]
    df = spark.createDataFrame(rows, EVENT).drop("batch")
    base, source = str(tmp_path / "table"), str(tmp_path / "source")
    stream = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    for some in (df.where("seq < 5"), df.where("seq >= 5"), df.where("seq > 100")):
        some.repartition(3).write.mode("append").parquet(source)
        got = jobs.upsert_stream(stream(), base=base).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, upsert_events(df).collect()))
