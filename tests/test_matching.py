import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from matchloom.operators import matching
from matchloom.operators.matching import best_matches, edit_similarity, sequence_ratio


def test_both_names_decide_and_the_best_sum_wins(spark):
    targets = spark.createDataFrame([("d1", "Flamengo", "Palmeiras"), ("d1", "Flamengo", "Santos"), ("d1", "Vasco da Gama", "Botafogo"), ("d2", "Flamengo", "Palmeiras")], "block string, home string, away string")
    listings = spark.createDataFrame(
        [("d1", 1, "Flamengo", "Santos"), ("d1", 2, "Flamengo", "Palmeira"), ("d1", 3, "Flamengos", "PALMEIRAS"), ("d1", 4, " Vasco  da\tGama ", "botafogo"), ("d1", 5, "Vasco da Gama", "Botafogo"), ("d2", 6, "Flamengo", "Gremio")],
        "block string, pos int, home string, away string",
    )
    for similarity in (sequence_ratio, edit_similarity):
        got = {(r["block"], r["home"], r["away"]): r for r in best_matches(targets, listings, similarity, names=("home", "away")).collect()}
        assert {k: r["pos"] for k, r in got.items()} == {("d1", "Flamengo", "Palmeiras"): 2, ("d1", "Flamengo", "Santos"): 1, ("d1", "Vasco da Gama", "Botafogo"): 4}
        assert got["d1", "Vasco da Gama", "Botafogo"]["score"] == 2 and got["d1", "Vasco da Gama", "Botafogo"]["listing_home"] == " Vasco  da\tGama "


def texts(seed, n):
    rng = random.Random(seed)
    words = ["almond", "antique", "blush", "bisque", "São", "rose", "Real", "FC", "  ", "x"]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(5))) for _ in range(n)]


def test_matched_characters_are_those_of_the_longest_blocks():
    ours, theirs = texts(1, 3000), texts(2, 3000)
    for k in range(0, 3000, 3):
        theirs[k] = ours[k][: k % 7] + ours[k][k % 5 :]
    want = [sum(m.size for m in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()) for x, y in zip(ours, theirs)]
    assert matching.matched_characters(ours, theirs).tolist() == want
    assert matching.matched_characters([], []).tolist() == [] and matching.matched_characters(["", "a"], ["b", ""]).tolist() == [0, 0]


def test_no_similar_pair_is_lost_and_few_are_compared(spark):
    ours, theirs = [("b1" if k % 3 else "b2", *x) for k, x in enumerate(zip(texts(3, 250), texts(4, 250)))], []
    rng = random.Random(5)
    for k, (block, home, away) in enumerate(ours):
        if k % 2:
            at = rng.randrange(len(home) + 1)
            theirs.append((block, k, home[:at] + home[at + 1 :], away.upper()))
        theirs.append(("b1", 1000 + k, texts(6 + k, 1)[0], away))
    targets = spark.createDataFrame(ours, "block string, home string, away string").distinct()
    listings = spark.createDataFrame(theirs, "block string, pos int, home string, away string")
    norm = lambda x: " ".join(x.lower().split())
    ratio = lambda x, y: SequenceMatcher(None, x, y).ratio()
    best = {}
    for block, home, away in {tuple(r) for r in targets.collect()}:
        near = [(-ratio(norm(home), norm(h)) - ratio(norm(away), norm(w)), pos) for b, pos, h, w in theirs if b == block and min(ratio(norm(home), norm(h)), ratio(norm(away), norm(w))) >= 0.85]
        if near:
            best[block, home, away] = min(near)[1]
    got = matching.best_matches(targets, listings, matching.sequence_ratio, names=("home", "away"))
    assert {(r["block"], r["home"], r["away"]): r["pos"] for r in got.collect()} == best and len(best) > 100

    names = targets.select("block", F.col("home").alias("name"))
    others = listings.select("block", F.col("home").alias("listing"))
    every = {(b, x, y) for b, x in {tuple(r) for r in names.collect()} for c, y in {tuple(r) for r in others.collect()} if b == c}
    want = {(b, x, y) for b, x, y in every if ratio(norm(x), norm(y)) >= 0.85}
    assert {(r["block"], r["name"], r["listing"]) for r in matching.name_ratios(names, others).collect()} == want
    assert matching.candidate_pairs(targets, listings.select("block", F.col("home").alias("h"), F.col("away").alias("w")), 0.85, {"home": "h", "away": "w"}).count() < sum(b == c for b, *_ in ours for c, *_ in theirs) / 10


def test_spellings_that_differ_in_blanks_are_equal(spark):
    names, others = spark.createDataFrame([("b", "Vasco da Gama"), ("b", None)], "block string, name string"), spark.createDataFrame([("b", " vasco  da\tGAMA"), ("b", ""), ("c", "Vasco da Gama")], "block string, listing string")
    assert sorted(tuple(r)[1:] for r in matching.name_ratios(names, others).collect() if r["name"]) == [("Vasco da Gama", " vasco  da\tGAMA", 1.0)]
    assert [r["ratio"] for r in matching.name_ratios(names, others).where("name is null").collect()] == [1.0]
