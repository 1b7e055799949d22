"""The closed forms against plain sequential folds on random histories."""

import random

from matchloom.operators import merge, sequence


def histories(n, seed):
    rng = random.Random(seed)
    maybe = lambda v: v if rng.random() < 0.5 else None
    return [(k, r, f"base{r}", maybe(str(1990 + r)), maybe(rng.randrange(4)), maybe(rng.randrange(4)), maybe(f"s{r}"), rng.choice(["scheduled", "finished"])) for k in range(n) for r in range(rng.randrange(1, 6))]


SCHEMA = "id long, {} int, home string, season string, score_home int, score_away int, sets_detail string, status string"


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {k: sorted(v, key=lambda r: r[1]) for k, v in out.items()}


def test_merge_events(spark):
    rows = histories(2000, 1)
    want = {}
    for k, history in by_id(rows).items():
        _, _, home, season, sh, sa, sets, status = history[0]
        for _, _, _, _, h, a, s, st in history[1:]:
            if sh is None:  # only while there is no score does a later row fill in
                sh, sa, sets = h, a if a is not None else sa, s if s is not None else sets
                status = "finished" if st == "finished" else status
        want[k] = (home, season, sh, sa, sets, status)
    random.Random(2).shuffle(rows)
    got = merge.merge_events(spark.createDataFrame(rows, SCHEMA.format("shard_rank")).repartition(7)).collect()
    assert {r["id"]: (r["home"], r["season"], r["score_home"], r["score_away"], r["sets_detail"], r["status"]) for r in got} == want


def test_upsert_events(spark):
    rows = histories(2000, 3)
    want = {}
    for k, history in by_id(rows).items():
        _, _, home, season, *value = history[0]
        for _, _, _, s, *later in history[1:]:
            if value[0] is None and later[0] is not None:
                value = later
            season = season or s
        want[k] = (home, season, *value)
    got = merge.upsert_events(spark.createDataFrame(rows, SCHEMA.format("seq")).repartition(5)).collect()
    assert {r["id"]: (r["home"], r["season"], r["score_home"], r["score_away"], r["sets_detail"], r["status"]) for r in got} == want


def test_early_stop(spark):
    rng = random.Random(4)
    log, want = [], {}
    for k in range(1500):
        seasons = {y: rng.choice(["ok", "empty", "empty", "broken"]) for y in range(2010, 2027) if rng.random() < 0.85}
        log += [(f"l{k}", y, o) for y, o in seasons.items()]
        anchored = any(o == "ok" and 2012 <= y <= 2020 for y, o in seasons.items())
        run, stop = 0, None
        for y in sorted(seasons, reverse=True):
            o = seasons[y]
            if stop:
                want[f"l{k}", y] = (stop[0], (-1 if stop[1] == "broken" else 0) if y < 2026 else None)
                continue
            if o == "ok":
                run = 0
            elif y < 2026:
                run += 1
                if run == 3:
                    if y > 2021 and (o == "broken" or not anchored):
                        stop = (y, o)
                    else:
                        run = 0
        for y in seasons:
            want.setdefault((f"l{k}", y), (stop[0] if stop else None, None))
    got = sequence.early_stop(spark.createDataFrame(log, "league string, y int, outcome string"), 2026, 2021, list(range(2012, 2021))).collect()
    assert {(r["league"], r["y"]): (r["stop_y"], r["mark"]) for r in got} == want


def test_reruns_change_nothing(spark):
    rows = spark.createDataFrame(histories(200, 5), SCHEMA.format("seq"))
    first = merge.first_wins(rows, ["id"], ["seq"])
    assert {tuple(r) for r in merge.first_wins(first, ["id"], ["seq"]).collect()} == {tuple(r) for r in first.collect()}
    once = merge.append_idempotent(rows, rows, ["id"], ["seq"])
    again = merge.append_idempotent(once, rows, ["id"], ["seq"])
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in again.collect()}
    fixed = merge.fill_zero_scores(merge.merge_events(rows.withColumnRenamed("seq", "shard_rank")))
    assert {tuple(r)[:-1] for r in merge.fill_zero_scores(fixed.drop("repaired")).collect()} == {tuple(r)[:-1] for r in fixed.collect()}
