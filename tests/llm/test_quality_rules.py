import random
import re
from math import comb

import numpy as np

from matchloom.llm.quality_rules import counts_of, cutoffs, judged, keep_good, most_false, steps_of, tail


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    hit = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), sum("A" <= c <= "Z" for c in text)


def test_counts_match_brute_force():
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a ", "b ", "ab", "é", "\n", "#", " ", "x\n", "\t", "日", "\xa0", "Z"]) for _ in range(rng.randrange(200))) for _ in range(200)]
    texts += ["", "a", "\n\n", "a b c a b c", "x" * 100]
    got = counts_of([None, *(t.encode() for t in texts)])
    assert [tuple(r) for r in got.tolist()] == [brute(t) for t in [None, *texts]]


def test_steps_have_no_end():
    scores = np.array([0, 0.019, 0.02, 39.99, 40, 40.02, 79.99, 80, 1e3, 1e6, 1e9, 4e9])
    got = steps_of(scores).tolist()
    assert got[:5] == [0, 0, 1, 1999, 2000] and got == sorted(got) and len(set(got)) == len(got) - 2 and got[-1] < 40_000
    rising = steps_of(np.arange(0, 2_000_000, 7) / 50)
    assert (np.diff(rising) >= 0).all() and len(np.unique(rising)) < 15_000


def test_binomial_bounds():
    for n, p in ((10, 0.3), (60, 0.02)):
        for k in range(n):
            assert abs(tail(k, n, p) - sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))) < 1e-9
    assert most_false(1000, 0.004, 0.01) == max(k for k in range(-1, 20) if k < 0 or tail(k, 1000, 0.004) <= 0.01)
    assert most_false(5, 0.004, 0.01) == -1


def documents(spark, n):
    rng = random.Random(4)
    rows = []
    for k in range(n):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "of", "the"]) + str(rng.randrange(1000)) for _ in range(80)]
        bad = k % 10 == 0
        rows.append((k, " ".join(w + "***" if bad else w for w in words), "en" if k % 2 or k % 4 == 0 else None, 0 if bad else 1, 7))
    rows += [(n, None, "en", 1, 7), (n + 1, "", None, None, 7), (None, "a " * 90, "xx", None, 7), (n + 2, "few words", "en", 1, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int, __cuts int")
    return docs.selectExpr("*", *(f"{k} as {c}" for k, c in enumerate(("__stratum", "__body", "__kept", "__quality", "stratum", "cuts", "id", "body"))))


def test_rules_reject_junk_and_keep_good(spark):
    docs = documents(spark, 6000)
    labels = docs.select("doc_id", "quality").where("doc_id % 2 = 0")
    got = {r["doc_id"]: (r["quality"], r["__kept"], r["lang"]) for r in judged(docs, labels).collect() if r["doc_id"] is not None}
    assert all(kept == (quality == 1) for k, (quality, kept, _) in got.items() if k < 6000)
    assert not any(got[k][1] for k in (6000, 6001, 6002))
    good = keep_good(docs, labels)
    assert good.columns == docs.columns
    assert {(r["doc_id"], r["__cuts"], r["__kept"], r["__quality"]) for r in good.collect()} == {(k, 7, 2, 3) for k in range(6000) if k % 10}


def test_no_evidence_no_cut(spark):
    holdout = spark.createDataFrame([("a", True, 1, 1, 1, 1, 1), ("a", False, 9, 9, 9, 9, 9)], "stratum string, good boolean, symbols int, repeats int, dup_lines int, upper int, length int")
    assert cutoffs(holdout).count() == 0
    assert judged(documents(spark, 0), holdout.selectExpr("1L as doc_id", "1 as quality").limit(0)).count() == 4
