"""Rules against plain folds, row by row, of what they say."""

import random

import pytest
from pyspark.sql import functions as F

from matchloom.operators import audit, dims, matching, merge, planning, sequence, shards
from matchloom.streaming import jobs


def test_season_state_takes_the_last_time_as_it_is(spark):
    rng = random.Random(1)
    rows = [(f"l{k}", rng.choice(["2001", "", None]), r, rng.randrange(-1, 9), rng.choice([None, f"2001-01-0{r + 1}"])) for k in range(50) for r in range(4)]
    want = {}
    for league, season, _, n, at in sorted(rows, key=lambda r: r[2]):
        before = want.get((league, season))
        want[league, season] = (n if before is None else max(before[0], n), at)
    got = merge.merge_season_state(spark.createDataFrame(rows, "league string, season string, shard_rank int, n int, completed_at string").repartition(5)).collect()
    assert {(r["league"], r["season"]): (r["n"], r["completed_at"]) for r in got} == want


def test_recovered_scores_of_events_without_season_or_fragment(spark):
    events = [(1, "l", None, "http://a/#x1"), (2, "l", "2001", "http://a/#x1"), (3, "l", "2001", "http://a/"), (4, "l", "2001", "http://a/#"), (5, "l", None, "http://a/#b#c"), (6, "l", None, None), (7, None, None, "u#x1")]
    listings = [("l", None, "x1", "1", "2", 1), ("l", None, "x1", "3", "4", 2), ("l", "2001", "", "9", "9", 3), ("l", "2001", None, "9", "9", 4), ("l", None, "b#c", "5", "", 5), ("l", "2001", "x1", "6", "x", 6), (None, None, "x1", "7", "8", 7)]
    want = {}
    for i, league, season, url in events:
        by_hash = {h: (a, b) for lg, s, h, a, b, _ in sorted(listings, key=lambda r: r[5]) if (lg, s) == (league, season) and h}
        found = by_hash.get(url.split("#", 1)[1] if url and "#" in url else "")
        try:
            want[i] = (int(found[0]), int(found[1])) if found else (None, None)
        except ValueError:
            want[i] = (None, None)
    got = matching.recover_scores(spark.createDataFrame(events, "id int, league string, season string, source_url string"), spark.createDataFrame(listings, "league string, season string, hash string, home string, away string, pos int"))
    assert {r["id"]: (r["score_home"], r["score_away"]) for r in got.collect()} == want


def test_missing_is_what_has_no_score(spark):
    report = spark.createDataFrame([("a", "1", 10, 8, 0), ("b", "1", 10, 7, 10), ("c", "1", 5, 5, 1)], "league string, season string, total long, scored long, with_odds long")
    assert [tuple(r) for r in audit.completeness_rollup(report).collect()] == [(3, 5, 80.0)]
    assert [r["league"] for r in audit.top_incomplete(report, 2).collect()] == ["b", "a"]


@pytest.mark.parametrize("n", [0, 1, 500])
def test_ranks_and_running_sums_without_one_task(spark, n):
    rng = random.Random(2)
    rows = [(k % 3, rng.randrange(10**9), k, rng.choice(["ok", "empty200"])) for k in range(n)]
    log = spark.createDataFrame(rows, "shard int, ts long, event_id int, outcome string").repartition(6)
    got = {r["event_id"]: r["n"] for r in sequence.ranked(log, ["ts", "event_id"], "n").collect()}
    assert got == {r[2]: k + 1 for k, r in enumerate(sorted(rows, key=lambda r: r[1:3]))}
    got = {r["event_id"]: r["n"] for r in sequence.ranked(log, ["shard", "ts", "event_id"], "n", ("shard",)).collect()}
    assert got == {r[2]: k + 1 for shard in range(3) for k, r in enumerate(sorted((r for r in rows if r[0] == shard), key=lambda r: r[1:3]))}
    want = []
    for shard in range(3):
        ok = 0
        for k, r in enumerate(sorted((r for r in rows if r[0] == shard), key=lambda r: r[1:3]), 1):
            ok += r[3] == "ok"
            want += [(shard, k, ok, ok / k)] if k % 7 == 0 else []
    assert sorted(map(tuple, sequence.success_curve(log, ["ts", "event_id"], 7).collect())) == want


def test_dictionary_keeps_known_ids(spark):
    known = spark.createDataFrame([(7, "m"), (3, "b")], "id long, name string")
    got = dims.encode(spark.createDataFrame([("z",), ("m",), ("a",), (None,), ("a",)], "name string"), known).collect()
    assert {r["name"]: r["id"] for r in got} == {"m": 7, "b": 3, "a": 8, "z": 9}


def test_season_marks(spark):
    rows = [("l", 2026, "http404", 0), ("l", 2026, "empty200", 0), ("l", 2020, "empty200", 0), ("l", 2020, "http404", 3), ("l", 2020, "uncertain", 0), ("l", 2020, "http404", 0)]
    got = sequence.season_marks(spark.createDataFrame(rows, "league string, y int, outcome string, n_events long"), 2026)
    assert [r["mark"] for r in got.collect()] == [-1, None, 0, None, None, -1]


def test_plan_heads(spark):
    leagues = spark.createDataFrame([("usa/atp-us-open",), ("x/y",), ("china/atp-xangai",)], "league string")
    assert [r[0] for r in planning.head_of_tiers(leagues).collect()] == ["china/atp-xangai", "usa/atp-us-open"]
    assert [r[0] for r in planning.only_stored(leagues, leagues.limit(1), leagues.where("league = 'x/y'")).collect()] == ["china/atp-xangai"]
    assert [tuple(r) for r in planning.first_groups(leagues, ["league"], 1).collect()] == [("china/atp-xangai",)]


EVENT = "id long, seq long, home string, season string, score_home int, score_away int, sets_detail string, status string"


def test_upsert_stream_merges_batches(spark):
    rng = random.Random(3)
    maybe = lambda v: v if rng.random() < 0.4 else None
    rows = [(rng.randrange(40), k, f"h{k}", rng.choice([None, "", str(k)]), maybe(k), maybe(k), maybe("s"), "finished") for k in range(400)]
    df = spark.createDataFrame(rows, EVENT)
    got = jobs.upsert_stream(jobs.in_batches(df, 5, ["seq"])).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, merge.upsert_events(df).collect())) and len(got) == 40


def test_upsert_stream_without_rows(spark):
    assert jobs.upsert_stream(jobs.in_batches(spark.createDataFrame([], EVENT), 2, ["seq"])).count() == 0


def test_orphans_in_one_pass(spark):
    odds = spark.createDataFrame([(1,), (1,), (2,), (None,), (5,)], "event_id int")
    events = spark.createDataFrame([(2,), (3,), (3,), (None,), (5,)], "id int")
    found = audit.orphans(odds, events)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [("odds", 1), ("event", 3), ("odds", None), ("event", None)]))
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_odds_of_shards_are_not_sorted_before_they_are_dealt(spark):
    names = [(s, d, s * 10 + k, f"{d}{k}") for s in (0, 1) for d in ("leagues", "teams", "markets", "submkts", "outcomes", "bookmakers") for k in (1, 2)]
    names = spark.createDataFrame(names, "shard_rank int, dim string, id int, name string")
    events = spark.range(2).selectExpr("cast(id as int) as shard_rank", "7 as id", "cast(id * 10 + 1 as int) as league_id", "cast(id * 10 + 1 as int) as home_id", "cast(id * 10 + 2 as int) as away_id", "'2001' as season", "timestamp '2001-01-02' as dt", "1 as score_home", "2 as score_away", "cast(null as string) as sets_detail", "'finished' as status")
    odds = spark.range(6).selectExpr("cast(id % 2 as int) as shard_rank", "cast(id div 100 + 7 as int) as event_id", "cast(id % 2 * 10 + 1 as int) as market_id", "cast(id % 2 * 10 + 1 as int) as submarket_id", "cast(id % 2 * 10 + 1 as int) as outcome_id", "cast(id % 2 * 10 + 1 + id div 4 as int) as bookmaker_id", "id as odds_closing")
    state = spark.createDataFrame([(0, "leagues1", "2001", 3, None)], "shard_rank int, league string, season string, n int, completed_at string")
    got = shards.merge_shards(names, events, odds, state, ["odds_closing"])["odds"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("WindowGroupLimit") < plan.index("Exchange hashpartitioning(event_id")
    assert sorted(r["odds_closing"] for r in got.collect()) == [0, 4] and got.select("bookmaker_id").distinct().count() == 2


def test_the_first_of_few(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(900)]), rng.choice([None, "a", "b"]), k) for k in range(2_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "x int, y string, k int").repartition(5)
    want = sorted(map(repr, merge.first_wins(df, ["x", "y"], ["k"]).collect()))
    few = merge.first_wins_of_few(df, ["x", "y"], ["k"])
    assert sorted(map(repr, few.collect())) == want and len(want) < 1_990
    monkeypatch.setattr(merge, "FEW", 3)
    assert sorted(map(repr, merge.first_wins_of_few(df, ["x", "y"], ["k"]).collect())) == want
    alone = spark.range(300).selectExpr("id", "id as k")
    assert merge.first_wins_of_few(alone, ["id"], ["k"]).count() == 300


def test_odds_that_share_no_key_are_not_exchanged(spark):
    names = spark.createDataFrame([(s, d, s * 10, d) for s in (0, 1) for d in ("markets", "submkts", "outcomes", "bookmakers")], "shard_rank int, dim string, id int, name string")
    odds = spark.range(3_000).selectExpr("cast(id % 2 as int) as shard_rank", "greatest(id, 3) as event_id", *(f"cast(id % 2 * 10 as int) as {c}_id" for c in ("market", "submarket", "outcome", "bookmaker")), "id as odds_closing")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too long for it
    try:
        got = shards.merge_shards(names, None, odds, None, ["odds_closing"], ("odds",))
        assert set(got) == {"dims", "odds"}
        rows = got["odds"].collect()
        plan = got["odds"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r["odds_closing"] for r in rows) == [0, *range(4, 3_000)]
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(event_id") > 0


def test_long_dimensions_are_remapped_behind_the_fold(spark, monkeypatch):
    rng = random.Random(8)
    maybe = lambda v: v if rng.random() < 0.6 else None
    names = [(s, d, s * 100 + k, f"{d}{k}") for s in range(3) for d, n in (("leagues", 2), ("teams", 30)) for k in range(n) if d == "leagues" or (k + s) % 13]
    some = lambda s, n: None if rng.random() < 0.03 else s * 100 + rng.randrange(n)
    events = [(s, k, some(s, 2), some(s, 30), some(s, 30), maybe("2001"), maybe(k % 4), maybe(k % 3), maybe(f"s{s}"), "finished") for k in range(400) for s in range(3) if rng.random() < 0.7]
    events = spark.createDataFrame(events, "shard_rank int, id int, league_id int, home_id int, away_id int, season string, score_home int, score_away int, sets_detail string, status string").selectExpr("*", "timestamp '2001-01-02' as dt")
    names = spark.createDataFrame(names, "shard_rank int, dim string, id int, name string")
    state = spark.createDataFrame([(0, "leagues1", "2001", 0, None), (1, "leagues0", "1999", 0, None)], "shard_rank int, league string, season string, n int, completed_at string")

    def merged():
        got = shards.merge_shards(names, events, None, state, [], ("events", "state"))
        return sorted(map(repr, got["events"].select(sorted(got["events"].columns)).collect())), sorted(map(repr, got["state"].collect()))

    mapping = dims.merged_names(names)[1]
    want = merge.infer_season(merge.merge_events(dims.remapped(events, mapping, shards.EVENT_IDS, set())), F.col("dt"))
    want = merge.fill_zero_scores(want).drop("repaired")
    short = merged()
    assert short[0] == sorted(map(repr, want.select(sorted(want.columns)).collect())) and 300 < len(short[0]) < 400
    assert [r for r in short[1] if "1999" in r] and not [r for r in short[1] if "2001" in r]
    for few in (60, 7, 1):  # the teams are long, the lost ids few; they are many; all is long
        monkeypatch.setattr(dims, "FEW", few)
        assert dims.short_dims(mapping) == ({"leagues"} if few > 6 else set())
        assert merged() == short


def test_rows_with_names_stay_where_they_are(spark):
    mapping = spark.createDataFrame([(0, "teams", k, k) for k in range(1, 50)], "shard_rank int, dim string, old int, new int")
    rows = spark.range(60).selectExpr("0 as shard_rank", "cast(id as int) as home_id", "if(id = 20, null, 3) as away_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too long for it
    try:
        got = dims.with_names(rows, mapping, {"home_id": "teams", "away_id": "teams"})
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["home_id"] for r in got.collect()) == [k for k in range(1, 50) if k != 20]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in plan


def test_an_id_with_two_names_has_the_first(spark):
    names = spark.createDataFrame([(0, "teams", 5, "b"), (0, "teams", 5, "a"), (1, "teams", 5, "b")], "shard_rank int, dim string, id int, name string")
    merged, mapping = dims.merged_names(names)
    ids = {r["name"]: r["id"] for r in merged.collect()}
    assert {(r["shard_rank"], r["old"], r["new"]) for r in mapping.collect()} == {(0, 5, ids["a"]), (1, 5, ids["b"])}
