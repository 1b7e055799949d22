import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.operators import dims, extract, planning
from matchloom.plans.views import view
from matchloom.session import together
from matchloom.sources import files


def test_read_shards_ranks_by_path_and_merges_columns(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id int, home string").write.parquet(f"{tmp_path}/shard-10")
    spark.createDataFrame([(2, "b", "x")], "id int, home string, extra string").write.parquet(f"{tmp_path}/shard-2")
    spark.createDataFrame([(3, "c")], "id int, home string").write.parquet(f"{tmp_path}/seed")
    rows = files.read_shards(spark, str(tmp_path)).collect()
    assert sorted((r["shard_rank"], r["id"], r["extra"]) for r in rows) == [(0, 1, None), (1, 2, "x"), (2, 3, None)]


def test_league_cache_keeps_good_and_expires(spark, tmp_path):
    path = str(tmp_path / "cache")
    assert files.write_league_cache(spark.createDataFrame([("b",), ("a",)], "league string"), path, 100.0)
    assert not files.write_league_cache(spark.createDataFrame([], "league string"), path, 200.0)
    assert {r[0] for r in files.read_league_cache(spark, path, 150.0, 60.0).collect()} == {"a", "b"}
    assert files.read_league_cache(spark, path, 500.0, 60.0).count() == 0


def test_encode_keeps_known_ids(spark):
    first = dims.encode(spark.createDataFrame([("b",), ("d",), (None,)], "name string"))
    second = dims.encode(spark.createDataFrame([("a",), ("d",), ("b",), ("c",)], "name string"), first)
    assert {(r["id"], r["name"]) for r in second.collect()} == {(1, "b"), (2, "d"), (3, "a"), (4, "c")}
    assert {tuple(r) for r in dims.encode(spark.createDataFrame([("d",)], "name string"), second).collect()} == {tuple(r) for r in second.collect()}


def test_not_done_matches_null_keys(spark):
    work = spark.createDataFrame([(1, None), (2, "a")], "k int, n string")
    assert [r["k"] for r in planning.not_done(work, work.where("k = 1"), ["k", "n"]).collect()] == [2]


def test_failed_extractor_costs_only_its_market(spark):
    rows = spark.createDataFrame([(1, "1x2", "bk", [2.0, None, 3.0]), (1, "btts", None, [1.5])], "event_id int, market string, bookmaker string, cells array<double>")
    failed = []
    out = extract.extract_markets(rows, {"bad": lambda df: df.select("nothing"), **extract.EXTRACTORS}, failed).collect()
    assert failed == ["bad"]
    assert [(r["outcome"], r["odds_closing"]) for r in out] == [("home", 2.0), ("draw", None), ("away", 3.0)]


def test_filters_and_columns_reach_the_scan(spark):
    plan = view(spark, "/root/testdata/sf0.001", "v_real_odds").where("home_team = 5").select("home_team", F.col("real_odd"))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_suppkey,5)" in plan and "l_comment" not in plan and "l_tax" not in plan


def test_skipped_files_are_counted(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a.csv").write_text("id,odd\n1,2.5\n2,x\n")
    (tmp_path / "b.csv").write_text(" \n\n")
    (tmp_path / "c.csv").write_bytes(b"id,odd\n\xff\xfe\x00\x01")
    (tmp_path / "d.csv").write_text("id,price\n1,2\n")
    (tmp_path / "e.csv").write_text('"odd","id"\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("odd", T.DoubleType())])
    files_ = {r["file"].rsplit("/", 1)[1]: r["reason"] for r in files.usable_files(spark, str(tmp_path), schema.names).collect()}
    assert files_ == {"a.csv": None, "b.csv": "empty", "c.csv": "corrupt", "d.csv": "schema", "e.csv": None}
    rows, report, skipped = files.read_usable_csv(spark, str(tmp_path), schema)
    assert [tuple(r) for r in rows.collect()] == [(1, 2.5)]
    assert sorted((r["good"], r["n"]) for r in report.collect()) == [(False, 1), (True, 1)]
    assert sorted(map(tuple, skipped.collect())) == [("corrupt", 1), ("empty", 1), ("schema", 1)]


def test_files_are_validated_whole(spark, tmp_path):
    wide = "id,odd\n" + "".join(f"{k},{k}.5\n" for k in range(9000))
    place = 65_536  # a character across what was once looked at
    text = (wide.encode() * 2)[: place - 1] + "é,1\n".encode()
    (tmp_path / "border.csv").write_bytes(text)
    (tmp_path / "late.csv").write_bytes(wide.encode() + b"1,2\n3,\xff\n4,5\n")
    (tmp_path / "late nul.csv").write_bytes(wide.encode() + b"1,\0\n")
    (tmp_path / "cut.csv").write_bytes(wide.encode() + "9,é".encode()[:-1])
    (tmp_path / "mark.csv").write_bytes("﻿id,odd\r\n1,2\r\n".encode())
    (tmp_path / "blank.csv").write_bytes(b"\r\n \t\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # each file in several splits
    try:
        found = {r["file"].rsplit("/", 1)[1]: r["reason"] for r in files.usable_files(spark, str(tmp_path), ["id", "odd"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {"border.csv": None, "late.csv": "corrupt", "late nul.csv": "corrupt", "cut.csv": "corrupt", "mark.csv": None, "blank.csv": "empty"}


def test_files_with_odd_names_are_read(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a b%20c+d.csv").write_text("id\n1\n2\n")
    (tmp_path / "bad.csv").write_bytes(b"id\n\xff\n")
    rows, _, skipped = files.read_usable_csv(spark, str(tmp_path), T.StructType([T.StructField("id", T.LongType())]))
    assert sorted(r["id"] for r in rows.collect()) == [1, 2] and [tuple(r) for r in skipped.collect()] == [("corrupt", 1)]


def test_only_seasons_with_rows_are_replaced(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2000", "a"), (2, "2001", "b")], "id int, season string, home string")
    files.write_star({"events": rows}, str(tmp_path))
    files.write_star({"events": rows.where("season = '2001'").withColumn("home", F.lit("c"))}, str(tmp_path))
    assert sorted((r["id"], r["home"]) for r in spark.read.parquet(f"{tmp_path}/events").collect()) == [(1, "a"), (2, "c")]


def test_one_dictionary_for_all_dimensions(spark):
    rows = spark.createDataFrame([("b", "x", 7), ("a", "b", None), (None, "a", 7)], "home string, away string, n int")
    got = sorted(tuple(r) for r in dims.dictionary(rows, {"teams": ["home", "away"], "numbers": ["n"]}).collect())
    assert got == [("numbers", 1, "7"), ("teams", 1, "a"), ("teams", 2, "b"), ("teams", 3, "x")]
    owned = sorted(tuple(r) for r in dims.dictionary(rows, {"teams": ["home", "away"], "numbers": ["n"]}, {"teams": "n"}).collect())
    assert owned == [("numbers", 1, "7", None), ("teams", 1, "a", 7), ("teams", 2, "b", 7), ("teams", 3, "x", 7)]


def test_jobs_side_by_side_raise_the_first_failure(spark):
    def fails():
        raise ValueError("no")

    assert together(spark, [lambda: spark.range(3).count(), lambda: 2]) == [3, 2]
    assert together(spark, []) == []
    with pytest.raises(ValueError, match="no"):
        together(spark, [lambda: 1, fails])


def test_a_table_of_many_files_counts_once(spark, tmp_path):
    for flag, column in (("a", "odd"), ("b", "other"), ("c", "other")):
        files.write_csv(spark.range(40).select("id", F.col("id").alias(column)).repartition(4), str(tmp_path / flag))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("odd", T.LongType())])
    rows, _, skipped = files.read_usable_csv(spark, f"{tmp_path}/*", schema, F.regexp_replace("file", "/[^/]*$", ""))
    assert len(rows.collect()) == 40 and [tuple(r) for r in skipped.collect()] == [("schema", 2)]
    assert len(list(tmp_path.glob("b/*.csv"))) == 4


def test_ranks_go_to_the_rows(spark):
    df = spark.range(9).select("id", F.concat(F.lit("a/shard-"), (F.col("id") % 2).cast("string")).alias("p"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = files.with_shard_rank(df, F.col("p"), F.col("id") % 4 == 3)
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = {r["id"]: r["shard_rank"] for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows == {k: 2 if k % 4 == 3 else k % 2 for k in range(9)}
